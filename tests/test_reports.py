from datetime import datetime
from decimal import Decimal

import pytest

from centstream.operators import reports
from centstream.plans.dashboard import dashboard
from centstream.session import new_folder
from centstream.sources.payments import PaymentsTable

DDL = (
    "event_id STRING, currency STRING, payment_status STRING, event_type STRING, "
    "payment_id STRING, description STRING, amount_major DECIMAL(18,3), is_successful BOOLEAN, "
    "event_time TIMESTAMP"
)


def pay(key, currency="gbp", status="succeeded", amount="1.000", ok=True, at=(10, 0)):
    when = datetime(2024, 1, at[0], at[1])
    return (key, currency, status, "t", f"pi_{key}", None, Decimal(amount), ok, when)


@pytest.fixture(scope="module")
def payments(spark):
    rows = [
        pay("a", amount="10.000", at=(10, 1)),
        pay("b", amount="5.010", at=(10, 1)),
        pay("c", amount="0.000", at=(11, 3)),
        pay("d", status="processing", ok=False, at=(11, 4)),
        pay("e", status="canceled", ok=False, at=(11, 4)),
        pay("f", "eur", amount="7.000", at=(11, 5)),
        pay("g", "jpy", status="canceled", ok=False, amount="900.000", at=(9, 0)),
    ]
    return spark.createDataFrame(rows, DDL)


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def test_summary(payments):
    assert rows_of(reports.summary(payments, "gbp")) == [
        (5, 3, 2, Decimal("15.010"), Decimal("5.003333"))
    ]


def test_summary_without_payments_is_one_row_of_zeros(payments):
    assert rows_of(reports.summary(payments, "chf")) == [
        (0, 0, 0, Decimal("0.000"), Decimal("0.000000"))
    ]


def test_summary_without_successes(payments):
    assert rows_of(reports.summary(payments, "jpy")) == [
        (1, 0, 1, Decimal("0.000"), Decimal("0.000000"))
    ]


def test_currencies_are_never_added_up(payments):
    by_currency = {
        row.currency: row.successful_amount
        for row in reports.summary_by_currency(payments).collect()
    }
    assert by_currency == {
        "gbp": Decimal("15.010"),
        "eur": Decimal("7.000"),
        "jpy": Decimal("0.000"),
    }


def test_headline_from_status_totals(payments):
    for currency in ("gbp", "jpy", "chf"):
        totals = reports.status_totals(reports.of_currency(payments, currency))
        summed = reports.summary_of_totals(totals)
        assert rows_of(summed) == rows_of(reports.summary(payments, currency))


def test_display_text(payments):
    shown = reports.summary_display(reports.summary_by_currency(payments)).orderBy("currency")
    assert rows_of(shown) == [
        ("eur", "1", "1", "0", "100.0%", "€7.00"),
        ("gbp", "5", "3", "2", "60.0%", "£15.01"),
        ("jpy", "1", "0", "1", "0.0%", "¥0"),
    ]


def test_currency_lists(payments):
    assert rows_of(reports.currencies(payments)) == [("eur",), ("gbp",), ("jpy",)]
    assert rows_of(reports.default_currency(payments, "GBP")) == [("gbp",)]
    assert rows_of(reports.default_currency(payments, "chf")) == [("eur",)]
    assert rows_of(reports.default_currency(payments.limit(0), "gbp")) == []


def test_status_breakdown_order(payments):
    assert rows_of(reports.status_breakdown(payments, "gbp")) == [
        ("succeeded", 3),
        ("canceled", 1),
        ("processing", 1),
    ]


def test_hourly_activity_has_a_closed_lower_bound_and_no_empty_hours(payments):
    as_of = datetime(2024, 1, 12, 3)
    assert rows_of(reports.hourly_activity(payments, "gbp", as_of)) == [
        (datetime(2024, 1, 11, 3), 1, Decimal("0.000")),
        (datetime(2024, 1, 11, 4), 2, Decimal("0.000")),
    ]
    assert rows_of(reports.hourly_activity(payments, "gbp")) == []


def test_daily_summary_view(spark, payments):
    reports.register_daily_summary(payments, "daily")
    got = spark.sql("SELECT * FROM daily WHERE currency = 'gbp' ORDER BY payment_day")
    assert rows_of(got) == [
        (datetime(2024, 1, 10), "gbp", 2, 2, Decimal("15.010")),
        (datetime(2024, 1, 11), "gbp", 3, 1, Decimal("0.000")),
    ]


@pytest.mark.parametrize("asked, given", [(-5, 1), (0, 1), (25, 25), (100, 100)])
def test_recent_limit(asked, given):
    assert reports.recent_limit(asked) == given


def test_more_recent_payments_than_the_ceiling_are_refused():
    with pytest.raises(ValueError, match="ceiling"):
        reports.recent_limit(101)
    assert reports.recent_limit(500, ceiling=500) == 500


def test_recent_payments_break_ties_by_id(payments):
    got = reports.recent_payments(payments, "gbp", 3)
    assert got.columns == reports.RECENT_COLUMNS
    assert [row.payment_id for row in got.collect()] == ["pi_d", "pi_e", "pi_c"]


def test_recent_display(payments):
    shown = reports.recent_display(reports.recent_payments(payments, "gbp", 1), "gbp")
    assert "amount_major" not in shown.columns
    assert shown.first().amount == "£1.00"


def test_dashboard_reads_one_version(spark, sf_dir):
    from checks import queries

    table = PaymentsTable(spark, new_folder(spark, "dash"))
    rows = queries.payments_of(spark, sf_dir)
    table.upsert(rows.where("currency <> 'gbp'"))
    empty = dashboard(table, "gbp", queries.AS_OF)
    table.upsert(rows)
    assert empty.summary.first().total_events == 0
    assert empty.status.count() + empty.hourly.count() + empty.recent.count() == 0
    empty.release()
    full = dashboard(table, "gbp", queries.AS_OF)
    assert full.summary.first().total_events == sum(r.event_count for r in full.status.collect())
    assert full.recent.count() == 25
    full.release()
