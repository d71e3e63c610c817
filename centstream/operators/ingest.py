"""Raw webhook deliveries to publishable events: verify, route, flatten, check."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.contract import EVENT_COLUMNS, PAYMENT_EVENT_TYPES, PROVIDER
from centstream.functions.barrier import once
from centstream.functions.clock import iso_utc, parse_iso
from centstream.functions.signature import (
    hmac_sha256,
    keys_value,
    signatures,
    signed_at,
    signed_message,
)
from centstream.operators.validate import rejection_reason

# Outcome of one delivery, in the order the checks are made.
MISSING_SIGNATURE = "missing_signature"
INVALID_SIGNATURE = "invalid_signature"
INVALID_JSON = "invalid_json"
IGNORED = "ignored"
CONTRACT_VIOLATION = "contract_violation"
PUBLISHED = "published"
OUTCOMES = (
    MISSING_SIGNATURE,
    INVALID_SIGNATURE,
    INVALID_JSON,
    IGNORED,
    CONTRACT_VIOLATION,
    PUBLISHED,
)

# The part of the provider's document that is read. Fields that are typed later
# stay VARIANT, so that a value of a wrong type is not taken for an absent one.
EVENT_SHAPE = (
    "STRUCT<id STRING, type STRING, created VARIANT, livemode VARIANT, data STRUCT<object STRUCT<"
    "id STRING, amount VARIANT, currency STRING, status STRING, description STRING, "
    "customer VARIANT>>>"
)

# What a publishable event must satisfy, in the form of the validation rules.
CONTRACT_RULES: tuple[tuple[str, str], ...] = (
    ("event_id is required", "event_id IS NULL"),
    ("event_type is required", "event_type IS NULL"),
    ("payment_id is required", "payment_id IS NULL"),
    ("amount_minor must be an integer", "amount_minor IS NULL"),
    ("amount_minor must be at least 0", "amount_minor < 0"),
    ("currency must have length 3", "currency IS NULL OR length(currency) <> 3"),
    ("payment_status is required", "payment_status IS NULL"),
    ("livemode must be a boolean", "livemode IS NULL"),
    ("provider_created_at must be an integer", "provider_created_at IS NULL"),
    ("provider_created_at must be at least 0", "provider_created_at < 0"),
    ("received_at must be a timestamp", "received_at_ts IS NULL"),
    ("unexpected fields", "size(extra_fields) > 0"),
)


def verify_signatures(
    bronze: DataFrame, keys: DataFrame, tolerance_seconds: int | None = None
) -> DataFrame:
    """Add ``signature_status``: missing, invalid or ``ok``.

    A delivery is good when one of its ``v1`` entries matches one of the live
    keys. With a tolerance, one signed longer than that before its arrival is
    invalid too.
    """
    header = F.col("sig_header")
    stamp = signed_at(header)
    message = signed_message(stamp, F.col("body"))
    given = signatures(header)
    matches = F.exists(
        "_keys",
        lambda key: F.array_contains(given, hmac_sha256(message, key["ipad"], key["opad"])),
    )
    good = (stamp != "") & F.coalesce(matches, F.lit(False))
    if tolerance_seconds is not None:
        age = F.unix_seconds("arrived_at") - stamp.try_cast("bigint")
        good = good & F.coalesce(age <= tolerance_seconds, F.lit(False))
    status = (
        F.when(header.isNull() | (header == ""), MISSING_SIGNATURE)
        .when(good, "ok")
        .otherwise(INVALID_SIGNATURE)
    )
    keyed = bronze.select("*", keys_value(keys).alias("_keys"))
    return keyed.select("*", once(status.alias("signature_status"))).drop("_keys")


def route_deliveries(verified: DataFrame) -> DataFrame:
    """Parse the body once and decide what to do with it: ``route`` and ``event``.

    Only bodies with a good signature are parsed. An unsupported type is
    acknowledged and ignored, not refused.
    """
    body = F.when(F.col("signature_status") == "ok", F.col("body"))
    parsed = verified.select("*", once(F.try_parse_json(body).alias("doc")))
    event = F.try_variant_get("doc", "$", EVENT_SHAPE)
    read = parsed.select("*", once(event.alias("event")))
    route = (
        F.when(F.col("signature_status") != "ok", F.col("signature_status"))
        .when(F.col("doc").isNull(), INVALID_JSON)
        .when(F.col("event.type").isin(*PAYMENT_EVENT_TYPES), "publish")
        .otherwise(IGNORED)
    )
    return read.select("*", route.alias("route")).drop("doc")


def _or_default(value: Column, as_type: str, default: object) -> Column:
    """Typed value; the default when absent or null; null when of a wrong type."""
    absent = value.isNull() | F.is_variant_null(value)
    return F.when(absent, F.lit(default).cast(as_type)).otherwise(value.try_cast(as_type))


def flatten_event() -> list[Column]:
    """The flat event columns taken from the nested ``event``."""
    top, payment = F.col("event"), F.col("event.data.object")
    customer = payment["customer"]
    return [
        top["id"].alias("event_id"),
        top["type"].alias("event_type"),
        payment["id"].alias("payment_id"),
        _or_default(payment["amount"], "bigint", 0).alias("amount_minor"),
        F.lower(F.coalesce(payment["currency"], F.lit(""))).alias("currency"),
        F.coalesce(payment["status"], F.lit("unknown")).alias("payment_status"),
        payment["description"].alias("description"),
        # An expanded customer is an object holding the id.
        F.coalesce(
            F.try_variant_get(customer, "$.id", "string"), customer.try_cast("string")
        ).alias("customer_id"),
        _or_default(top["livemode"], "boolean", False).alias("livemode"),
        _or_default(top["created"], "bigint", 0).alias("provider_created_at"),
        iso_utc(F.col("arrived_at")).alias("received_at"),
        F.lit(PROVIDER).alias("source"),
    ]


def map_events(routed: DataFrame) -> DataFrame:
    """Flat events of the deliveries routed to publication."""
    return routed.where(F.col("route") == "publish").select(*flatten_event())


def contract_check(
    events: DataFrame, extra_fields: Column | None = None, received_at: Column | None = None
) -> DataFrame:
    """Add ``contract_violation``: every broken contract rule, empty when none is.

    ``extra_fields`` is an array of field names outside the contract, for events
    read from JSON; see ``unexpected_fields``. ``received_at`` is the instant
    behind the text of that name, where it is at hand already.
    """
    extra = F.array().cast("array<string>") if extra_fields is None else extra_fields
    instant = parse_iso(F.col("received_at")) if received_at is None else received_at
    prepared = events.withColumns({"received_at_ts": instant, "extra_fields": extra})
    violation = rejection_reason(CONTRACT_RULES).alias("contract_violation")
    return prepared.select("*", once(violation)).drop("received_at_ts", "extra_fields")


def unexpected_fields(value: Column) -> Column:
    """Names of the top-level JSON fields that the contract does not know."""
    known = F.array(*(F.lit(name) for name in EVENT_COLUMNS))
    return F.array_except(F.json_object_keys(value), known)


def ingest(bronze: DataFrame, keys: DataFrame, tolerance_seconds: int | None = None) -> DataFrame:
    """Every delivery with its event columns and final ``ingest_status``.

    One narrow stage: no shuffle, no join.
    """
    routed = route_deliveries(verify_signatures(bronze, keys, tolerance_seconds))
    flat = routed.select("body", "sig_header", "arrived_at", "route", once(*flatten_event()))
    outcome = (
        F.when(F.col("route") != "publish", F.col("route"))
        .when(F.col("contract_violation") != "", CONTRACT_VIOLATION)
        .otherwise(PUBLISHED)
    )
    checked = contract_check(flat, received_at=F.col("arrived_at"))
    return checked.select("*", outcome.alias("ingest_status")).drop("route")


def published_events(ingested: DataFrame) -> DataFrame:
    return ingested.where(F.col("ingest_status") == PUBLISHED).select(*EVENT_COLUMNS)


def ingest_outcomes(ingested: DataFrame) -> DataFrame:
    """Number of deliveries per outcome."""
    return ingested.groupBy("ingest_status").agg(F.count("*").alias("delivery_count"))
