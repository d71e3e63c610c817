"""Payment events derived from a table of generic events, for tests and benchmarks.

Input columns: ``event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING,
value DOUBLE``. Every fiftieth event carries one chosen fault, every twentieth is
delivered twice. Everything is computed from the row itself, so the output grows
with the input and never needs a shuffle.
"""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.contract import EVENT_COLUMNS, PROVIDER
from centstream.functions.clock import iso_utc
from centstream.functions.signature import sign
from centstream.operators.publish import KEEP_NULLS

EVENT_TYPE_OF = {
    "purchase": "payment_intent.succeeded",
    "error": "payment_intent.payment_failed",
    "view": "payment_intent.processing",
    "click": "payment_intent.canceled",
    "signup": "customer.created",
}
STATUS_OF = {
    "purchase": "succeeded",
    "error": "requires_payment_method",
    "view": "processing",
}
CURRENCY_CYCLE = ["gbp", "EUR", "usd", "jpy", "kwd", "GBP"]
TRUNCATED = '{"event_id": "trunc'
TOPIC = "payment_events"


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = F.create_map(*(F.lit(part) for part in chain.from_iterable(table.items())))
    return F.try_element_at(pairs, key)


def payment_events(events: DataFrame) -> DataFrame:
    """One contract event per input row, plus ``n``, ``fault`` and ``ts``."""
    n, kind = F.col("event_id"), F.col("event_type")
    fault = n % 50
    ts = F.col("ts").cast("timestamp")
    text = n.cast("string")
    user = F.col("user_id").cast("string")
    cents = F.round(F.col("value") * 100).cast("bigint")
    cycle = F.array(*(F.lit(code) for code in CURRENCY_CYCLE))

    def unless(faults: dict[int, object], otherwise: Column) -> Column:
        picked = otherwise
        for number, value in faults.items():
            picked = F.when(fault == number, F.lit(value)).otherwise(picked)
        return picked

    return events.select(
        n.alias("n"),
        fault.alias("fault"),
        ts.alias("ts"),
        unless({0: "  "}, F.concat(F.lit("evt_"), text)).alias("event_id"),
        unless({6: None}, _lookup(EVENT_TYPE_OF, kind)).alias("event_type"),
        unless({1: None}, F.concat(F.lit("pi_"), user, F.lit("_"), text)).alias("payment_id"),
        unless({2: None, 3: -1, 13: 9_000_000_000_000_000_000}, cents).alias("amount_minor"),
        unless(
            {4: "us", 5: None, 13: "jpy", 15: "GBP "},
            F.element_at(cycle, (n % len(CURRENCY_CYCLE) + 1).cast("int")),
        ).alias("currency"),
        unless({7: ""}, F.coalesce(_lookup(STATUS_OF, kind), F.lit("canceled"))).alias(
            "payment_status"
        ),
        F.when(n % 9 != 0, F.concat(F.lit("item "), text)).alias("description"),
        F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("cus_"), user)).alias("customer_id"),
        unless({14: None}, n % 2 == 0).alias("livemode"),
        unless({8: None, 9: -1, 17: 300_000_000_000}, F.unix_seconds(ts)).alias("provider_created_at"),
        unless({10: None, 11: "not-a-time"}, iso_utc(ts)).alias("received_at"),
        F.lit(PROVIDER).alias("source"),
    )


def bus_records(events: DataFrame, deliveries: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Bus records of all events.

    Delivery 0 is the first of every event; delivery 1 is the repeat, one minute
    later, of every twentieth.
    """
    wanted = F.array(*(F.lit(d) for d in deliveries))
    repeated = F.col("n") % 20 == 16
    delivered = payment_events(events).select(
        "*", F.explode(F.when(repeated, wanted).otherwise(F.array_remove(wanted, 1))).alias("nth")
    )
    again = F.col("nth") == 1
    delivered = delivered.withColumn(
        "description", F.when(again, F.lit("redelivery")).otherwise(F.col("description"))
    )
    value = F.when(F.col("fault") == 12, F.lit(TRUNCATED)).otherwise(
        F.to_json(F.struct(*EVENT_COLUMNS), KEEP_NULLS)
    )
    return delivered.select(
        F.col("n").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("n") % 3).cast("int").alias("partition"),
        (F.floor(F.col("n") / 3) * 2 + F.col("nth")).cast("bigint").alias("offset"),
        (F.col("ts") + F.make_dt_interval(mins=F.col("nth"))).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def provider_body(events: DataFrame) -> DataFrame:
    """The provider's nested JSON document of every event: ``n``, ``ts``, ``body``."""
    variant = F.col("n") % 25
    plain_customer = F.col("customer_id")
    customer_object = F.struct(plain_customer.alias("id"), F.lit("customer").alias("object"))

    def document(payment: Column | None) -> Column:
        payment = F.lit(None).cast("string") if payment is None else payment
        return F.to_json(
            F.struct(
                F.col("event_id").alias("id"),
                F.lit("event").alias("object"),
                F.col("event_type").alias("type"),
                F.col("provider_created_at").alias("created"),
                "livemode",
                F.struct(payment.alias("object")).alias("data"),
                F.lit(1).alias("pending_webhooks"),
            ),
            KEEP_NULLS,
        )

    def payment(customer: Column, with_currency: bool = True) -> Column:
        fields = [
            F.col("payment_id").alias("id"),
            F.lit("payment_intent").alias("object"),
            F.col("amount_minor").alias("amount"),
            F.col("payment_status").alias("status"),
            "description",
            customer.alias("customer"),
        ]
        if with_currency:
            fields.insert(3, F.col("currency"))
        return F.struct(*fields)

    body = (
        F.when(variant == 2, F.concat(F.lit("{broken "), F.col("n").cast("string")))
        .when(variant == 4, document(payment(customer_object)))
        .when(variant == 5, document(None))
        .when(variant == 6, document(payment(plain_customer, with_currency=False)))
        .otherwise(document(payment(plain_customer)))
    )
    return payment_events(events).select("n", "ts", body.alias("body"))


def webhook_deliveries(events: DataFrame, keys: DataFrame) -> DataFrame:
    """Signed bronze deliveries, one per event.

    By ``n % 25``: 0 has no header, 1 a wrong signature, 2 a signed body that is
    not JSON, 3 two signatures of which the second is right, 4 the customer as an
    object, 5 no payment, 6 no currency.
    """
    variant = F.col("n") % 25
    stamp = F.unix_seconds("ts")
    right = sign(stamp, F.col("body"), keys)
    wrong = F.concat(F.lit("t="), stamp.cast("string"), F.lit(",v1="), F.repeat(F.lit("0"), 64))
    second = F.concat(F.lit(","), F.substring_index(right, ",", -1))
    header = (
        F.when(variant == 0, F.lit(None))
        .when(variant == 1, wrong)
        .when(variant == 3, F.concat(wrong, second))
        .otherwise(right)
    )
    return provider_body(events).select(
        "body", header.alias("sig_header"), F.col("ts").alias("arrived_at")
    )
