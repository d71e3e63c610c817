import hashlib
import hmac
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from centstream.contract import BRONZE_DDL, EVENT_COLUMNS, PAYMENT_EVENT_TYPES, PROVIDER
from centstream.functions.signature import signing_keys
from centstream.operators import ingest
from centstream.operators.publish import publish_records

SECRET = "whsec_test_secret"
LONG_SECRET = "s" * 200
STAMP = 1_700_000_000
ARRIVED = datetime(2023, 11, 14, 22, 13, 30, 250)

PAYMENT = dict(
    id="pi_night_train", object="payment_intent", amount=41_250, currency="SEK",
    status="succeeded", description=None, customer="cus_lund", receipt_email=None,
)
EVENT = dict(
    id="evt_sleeper_7", object="event", created=STAMP - 5, livemode=True,
    type="payment_intent.succeeded", data={"object": PAYMENT},
)


def digest(body, secret=SECRET, stamp=STAMP):
    return hmac.new(secret.encode(), f"{stamp}.{body}".encode(), hashlib.sha256).hexdigest()


def header(body, secret=SECRET, stamp=STAMP):
    return f"t={stamp},v1={digest(body, secret, stamp)}"


def bronze(spark, *deliveries):
    rows = [(body, head, ARRIVED) for body, head in deliveries]
    return spark.createDataFrame(rows, BRONZE_DDL).coalesce(1)


def statuses(spark, *deliveries, secrets=(SECRET,), tolerance=None):
    keys = signing_keys(spark, secrets)
    verified = ingest.verify_signatures(bronze(spark, *deliveries), keys, tolerance)
    return [row.signature_status for row in verified.collect()]


def ingested(spark, *documents):
    bodies = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    deliveries = bronze(spark, *((body, header(body)) for body in bodies))
    return ingest.ingest(deliveries, signing_keys(spark, [SECRET])).collect()


def changed(payment=None, **top):
    event = json.loads(json.dumps(EVENT)) | top
    if payment:
        event["data"]["object"] |= payment
    return event


def without(key, inside=True):
    event = json.loads(json.dumps(EVENT))
    del (event["data"]["object"] if inside else event)[key]
    return event


def test_signature_statuses(spark):
    body = json.dumps(EVENT)
    zeros = "0" * 64
    assert statuses(
        spark,
        (body, header(body)),
        (body, None),
        (body, ""),
        (body, "v1=" + digest(body)),
        (body, f"t={STAMP}"),
        (body, f"t={STAMP},v1={zeros}"),
        (body, f"t={STAMP},v1={zeros},v1={digest(body)}"),
        (body + " ", header(body)),
        (body, header(body, "other")),
        ("é ü", header("é ü")),
    ) == [
        "ok",
        "missing_signature",
        "missing_signature",
        "invalid_signature",
        "invalid_signature",
        "invalid_signature",
        "ok",
        "invalid_signature",
        "invalid_signature",
        "ok",
    ]


def test_keys_longer_than_a_block_and_rotation(spark):
    body = "{}"
    both = (SECRET, LONG_SECRET)
    heads = [(body, header(body)), (body, header(body, LONG_SECRET)), (body, header(body, "x"))]
    assert statuses(spark, *heads, secrets=both) == ["ok", "ok", "invalid_signature"]


def test_tolerance_refuses_old_signatures(spark):
    body = "{}"
    heads = [(body, header(body)), (body, header(body, stamp=STAMP - 300))]
    assert statuses(spark, *heads, tolerance=60) == ["ok", "invalid_signature"]
    assert statuses(spark, *heads) == ["ok", "ok"]


def test_no_secret_is_refused(spark):
    with pytest.raises(ValueError):
        signing_keys(spark, [])


def test_plan_does_not_show_the_key(spark):
    keys = signing_keys(spark, [SECRET])
    verified = ingest.verify_signatures(bronze(spark, ("{}", header("{}"))), keys)
    verified.collect()
    text = verified._jdf.queryExecution().toString()
    ipad = keys.first().ipad
    for shown in (SECRET, ipad.hex(), ipad.hex().upper(), ipad.decode("latin1")[:17]):
        assert shown not in text


def test_every_field_of_an_event_is_mapped(spark):
    (row,) = ingested(spark, EVENT)
    got = {name: row[name] for name in EVENT_COLUMNS}
    assert got == {
        "event_id": EVENT["id"],
        "event_type": EVENT["type"],
        "payment_id": PAYMENT["id"],
        "amount_minor": PAYMENT["amount"],
        "currency": "sek",
        "payment_status": "succeeded",
        "description": None,
        "customer_id": "cus_lund",
        "livemode": True,
        "provider_created_at": STAMP - 5,
        "received_at": "2023-11-14T22:13:30.000250Z",
        "source": PROVIDER,
    }
    assert row.ingest_status == "published"


@pytest.mark.parametrize("kind", PAYMENT_EVENT_TYPES)
def test_every_supported_type_is_published_with_its_own_status(spark, kind):
    (row,) = ingested(spark, changed({"status": f"as {kind}"}, type=kind))
    assert (row.ingest_status, row.event_type, row.payment_status) == ("published", kind, f"as {kind}")


def test_outcomes(spark):
    cases = [
        ("not json", "invalid_json"),
        ("", "invalid_json"),
        ('{"id": "cut', "invalid_json"),
        ("[1]", "ignored"),
        (changed(type="customer.created"), "ignored"),
        (without("type", inside=False), "ignored"),
        (changed({"amount": -1}), "contract_violation"),
        (changed({"amount": "many"}), "contract_violation"),
        (changed({"currency": "gb"}), "contract_violation"),
        (without("currency"), "contract_violation"),
        (without("id"), "contract_violation"),
        (without("id", inside=False), "contract_violation"),
        (changed(created=-1), "contract_violation"),
        (changed(data=None), "contract_violation"),
        (changed(livemode="maybe"), "contract_violation"),
        (changed({"metadata": {"a": "b"}}), "published"),
    ]
    rows = ingested(spark, *(document for document, _ in cases))
    assert [row.ingest_status for row in rows] == [status for _, status in cases]


def test_defaults_of_absent_fields(spark):
    event = without("amount")
    for key in ("livemode", "created"):
        del event[key]
    del event["data"]["object"]["status"]
    (row,) = ingested(spark, event)
    assert (row.amount_minor, row.payment_status) == (0, "unknown")
    assert (row.livemode, row.provider_created_at) == (False, 0)
    assert row.ingest_status == "published"


def test_numbers_given_as_text_are_read(spark):
    (row,) = ingested(spark, changed({"amount": "410", "customer": 5}))
    assert (row.amount_minor, row.customer_id) == (410, "5")


def test_last_of_a_repeated_field_counts(spark):
    body = json.dumps(EVENT).replace('"amount": 41250', '"amount": 1, "amount": 2')
    (row,) = ingested(spark, body)
    assert (row.ingest_status, row.amount_minor) == ("published", 2)


def test_expanded_customer_gives_its_id(spark):
    (row,) = ingested(spark, changed({"customer": {"id": "cus_9", "object": "customer"}}))
    assert row.customer_id == "cus_9"


def test_contract_check_names_every_breach(spark):
    ddl = (
        "event_id STRING, event_type STRING, payment_id STRING, amount_minor BIGINT, "
        "currency STRING, payment_status STRING, livemode BOOLEAN, provider_created_at BIGINT, "
        "received_at STRING, value STRING"
    )
    rows = [
        ("e", "t", "p", 1, "gbp", "s", True, 1, "2024-01-01T00:00:00Z", '{"event_id":"e"}'),
        (None, "t", "p", -1, "gbp ", "s", None, -1, "x", '{"other":1,"event_id":"e"}'),
    ]
    events = spark.createDataFrame(rows, ddl).coalesce(1)
    extra = ingest.unexpected_fields(F.col("value"))
    found = [r.contract_violation for r in ingest.contract_check(events, extra).collect()]
    assert found == [
        "",
        "event_id is required; amount_minor must be at least 0; currency must have length 3; "
        "livemode must be a boolean; provider_created_at must be at least 0; "
        "received_at must be a timestamp; unexpected fields",
    ]


def test_published_value_keeps_nulls_and_field_order(spark):
    keys = signing_keys(spark, [SECRET])
    body = json.dumps(EVENT)
    result = ingest.ingest(bronze(spark, (body, header(body))), keys)
    record = publish_records(ingest.published_events(result)).first()
    assert record.key == EVENT["id"]
    assert list(json.loads(record.value)) == [
        "event_id",
        "event_type",
        "payment_id",
        "amount_minor",
        "currency",
        "payment_status",
        "description",
        "customer_id",
        "livemode",
        "provider_created_at",
        "received_at",
        "source",
    ]
    assert json.loads(record.value)["description"] is None
