"""Rule texts, parsing edges and the traps around clocks and amounts."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from centstream.contract import BUS_DDL
from centstream.operators import route
from centstream.plans.batch import check_records

GOOD = {
    "event_id": "evt_1",
    "event_type": "payment_intent.succeeded",
    "payment_id": "pi_1",
    "amount_minor": 7999,
    "currency": "GBP",
    "payment_status": "succeeded",
    "description": "Wireless headphones",
    "customer_id": None,
    "livemode": False,
    "provider_created_at": 1_700_000_000,
    "received_at": "2023-11-14T22:13:21.123456Z",
    "source": "stripe",
}

UNREADABLE = (
    "missing event_id; missing payment_id; missing amount_minor; "
    "currency must contain three characters; missing event_type; missing payment_status; "
    "missing provider_created_at; missing received_at; missing livemode"
)


def bus_of(spark, values):
    rows = [
        (b"k", None if v is None else v.encode(), "t", 0, i, datetime(2024, 1, 1, 0, 0, i), 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, BUS_DDL)


def checked(spark, *values):
    texts = [json.dumps(GOOD | v) if isinstance(v, dict) else v for v in values]
    return check_records(bus_of(spark, texts), F.lit("2024-02-01").cast("timestamp")).orderBy(
        "kafka_offset"
    )


CASES = [
    ({}, ""),
    ({"event_id": None}, "missing event_id"),
    ({"event_id": "   "}, "missing event_id"),
    ({"event_id": "\t"}, ""),
    ({"payment_id": ""}, "missing payment_id"),
    ({"amount_minor": None}, "missing amount_minor"),
    ({"amount_minor": "12"}, "missing amount_minor"),
    ({"amount_minor": 12.5}, "missing amount_minor"),
    ({"amount_minor": 10**20}, "missing amount_minor"),
    ({"amount_minor": -1}, "amount_minor must be non-negative"),
    ({"amount_minor": 0}, ""),
    ({"currency": None}, "currency must contain three characters"),
    ({"currency": "us"}, "currency must contain three characters"),
    ({"currency": "123"}, ""),
    ({"currency": "jpy "}, ""),
    ({"event_type": None}, "missing event_type"),
    ({"event_type": " "}, "missing event_type; unsupported event_type"),
    ({"event_type": "customer.created"}, "unsupported event_type"),
    ({"payment_status": ""}, "missing payment_status"),
    ({"provider_created_at": None}, "missing provider_created_at"),
    ({"provider_created_at": -1}, "provider_created_at must be non-negative"),
    ({"provider_created_at": 253402300799}, ""),
    ({"provider_created_at": 253402300800}, "invalid provider_created_at"),
    ({"provider_created_at": 2**63 - 1}, "invalid provider_created_at"),
    ({"received_at": None}, "missing received_at"),
    ({"received_at": "not-a-time"}, "invalid received_at"),
    ({"received_at": "12:30"}, "invalid received_at"),
    ({"received_at": "12024-01-01"}, "invalid received_at"),
    ({"received_at": "2024-01-01"}, ""),
    ({"currency": "jpy", "amount_minor": 9 * 10**18}, "amount out of range"),
    ({"livemode": None}, "missing livemode"),
    ({"livemode": "true"}, "missing livemode"),
    (
        {"livemode": None, "received_at": "x", "event_id": ""},
        "missing event_id; invalid received_at; missing livemode",
    ),
    (None, UNREADABLE),
    ("", UNREADABLE),
    ('{"event_id": "trunc', UNREADABLE),
    ("null", UNREADABLE),
    ('"text"', UNREADABLE),
    ("[1]", UNREADABLE),
    ("{}", UNREADABLE),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    return checked(spark, *(value for value, _ in CASES)).collect()


@pytest.mark.parametrize("number", range(len(CASES)))
def test_reason(outcomes, number):
    value, reason = CASES[number]
    assert outcomes[number].rejection_reason == reason, value
    assert outcomes[number].is_valid == (reason == "")


def test_good_record_is_enriched(spark):
    row = checked(spark, {}).first()
    assert row.currency == "gbp"
    assert row.amount_major == Decimal("79.990")
    assert row.is_successful is True
    assert row.event_time == datetime(2023, 11, 14, 22, 13, 20)
    assert row.received_at_ts == datetime(2023, 11, 14, 22, 13, 21, 123456)
    assert row.processed_at == datetime(2024, 2, 1)


def test_padded_currency_is_stored_clean_and_priced(spark):
    row = checked(spark, {"currency": " JPY"}).first()
    assert (row.currency, row.amount_major) == ("jpy", Decimal("7999.000"))


def test_success_comes_from_the_event_type(spark):
    row = checked(spark, {"event_type": "payment_intent.canceled"}).first()
    assert row.is_successful is False


def test_text_fields_take_other_json_as_text_and_unknown_fields_are_dropped(spark):
    row = checked(spark, {"description": 5, "customer_id": {"id": "c"}, "other": 1}).first()
    assert (row.description, row.customer_id) == ("5", '{"id":"c"}')
    assert "other" not in row


def test_every_record_goes_one_way(spark):
    records = checked(spark, *(value for value, _ in CASES))
    passed = route.accepted(records).count()
    assert passed + route.rejected_records(records).count() == len(CASES)


def test_first_arrival_is_kept(spark):
    records = checked(spark, {"description": "first"}, {"description": "second"}, {"event_id": "b"})
    kept = route.valid_records(records).orderBy("event_id").collect()
    assert [(row.event_id, row.description) for row in kept] == [
        ("b", "Wireless headphones"),
        ("evt_1", "first"),
    ]


def test_default_clock_is_now(spark):
    row = check_records(bus_of(spark, [json.dumps(GOOD)])).first()
    assert abs((datetime.now() - row.processed_at).total_seconds()) < 86400
