from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from centstream.functions import currency as money


def column(spark, rows, ddl, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, ddl).select(*columns).collect()]


@pytest.mark.parametrize(
    "code, divisor",
    [("gbp", 100), ("JPY", 1), ("kwd", 1000), ("KWD", 1000), (None, 100), ("zzz", 100)],
)
def test_divisor(spark, code, divisor):
    got = column(spark, [(code,)], "c STRING", money.minor_unit_divisor(F.col("c")))
    assert got == [(divisor,)]


@pytest.mark.parametrize(
    "minor, code, major",
    [
        (7999, "gbp", Decimal("79.990")),
        (7999, "jpy", Decimal("7999.000")),
        (7999, "kwd", Decimal("7.999")),
        # Dividing as DOUBLE would give 100000000000000.000.
        (9999999999999999, "gbp", Decimal("99999999999999.990")),
        (999999999999999, "jpy", Decimal("999999999999999.000")),
        (1000000000000000, "jpy", None),
        (9223372036854775807, "gbp", None),
        (9223372036854775807, "kwd", None),
        (0, "eur", Decimal("0.000")),
        (None, "eur", None),
    ],
)
def test_amount_is_exact(spark, minor, code, major):
    amount = money.amount_major(F.col("m"), F.col("c"))
    assert column(spark, [(minor, code)], "m BIGINT, c STRING", amount) == [(major,)]


PLACES = {"jpy": 0, "gbp": 2, "kwd": 3}


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 2**63 - 1), st.sampled_from(sorted(PLACES))),
        min_size=1,
        max_size=50,
    )
)
def test_amount_equals_decimal_arithmetic(spark, cases):
    amount = money.amount_major(F.col("m"), F.col("c"))
    got = column(spark, cases, "m BIGINT, c STRING", "m", "c", amount)
    for minor, code, major in got:
        exact = Decimal(minor).scaleb(-PLACES[code])
        assert major == (exact if exact < 10**15 else None)


@pytest.mark.parametrize(
    "amount, code, text",
    [
        ("1234567.500", "gbp", "£1,234,567.50"),
        ("12.345", "EUR", "€12.34"),
        ("12.355", "usd", "$12.36"),
        ("0.500", "jpy", "¥0"),
        ("1.500", "jpy", "¥2"),
        ("1.234", "kwd", "KWD 1.234"),
        (None, "gbp", "£0.00"),
        ("5", "chf", "CHF 5.00"),
        ("-5", "gbp", "£-5.00"),
    ],
)
def test_money_text(spark, amount, code, text):
    rows = [(None if amount is None else Decimal(amount), code)]
    shown = money.format_money(F.col("a"), F.col("c"))
    assert column(spark, rows, "a DECIMAL(18,3), c STRING", shown) == [(text,)]


def test_percent_and_count_text(spark):
    shown = (money.format_percent(F.col("p")), money.format_count(F.col("n")))
    assert column(spark, [(12.25, 1234567)], "p DOUBLE, n BIGINT", *shown) == [
        ("12.2%", "1,234,567")
    ]
    assert column(spark, [(0.0, None)], "p DOUBLE, n BIGINT", *shown) == [("0.0%", "0")]


def test_success_rate(spark):
    rate = money.success_rate(F.col("s"), F.col("t"))
    assert column(spark, [(1, 4), (0, 0)], "s BIGINT, t BIGINT", rate) == [(25.0,), (0.0,)]
