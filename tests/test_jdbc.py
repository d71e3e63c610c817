"""The merge statement, run on an in-memory table."""

from datetime import datetime, timedelta

import duckdb
import pytest

from centstream.contract import TABLE_COLUMNS
from centstream.operators import reports
from centstream.plans.dashboard import dashboard
from centstream.sources.jdbc import (
    JdbcPayments,
    bounds_statement,
    merge_statement,
    range_options,
    table_statements,
)
from checks import queries

DDL = (
    "event_id TEXT {key}, payment_id TEXT, event_type TEXT, amount_minor BIGINT, "
    "amount_major DECIMAL(18,3), currency TEXT, payment_status TEXT, description TEXT, "
    "customer_id TEXT, livemode BOOLEAN, is_successful BOOLEAN, event_time TIMESTAMP, "
    "received_at TIMESTAMP, processed_at TIMESTAMP, raw_event {raw}"
)
NOW = datetime(2024, 1, 1)


def row(key, note, hours=0, minor=1):
    at = NOW + timedelta(hours=hours)
    return (key, "p", "t", minor, 1, "gbp", "s", note, None, True, True, at, NOW, NOW, "{}")


@pytest.fixture
def db():
    with duckdb.connect() as connection:
        connection.execute(f"CREATE TABLE payments ({DDL.format(key='PRIMARY KEY', raw='JSON')})")
        connection.execute(f"CREATE TABLE staging ({DDL.format(key='', raw='TEXT')})")
        yield connection


def merge(db, *rows, first_wins=None):
    db.execute("DELETE FROM staging")
    db.executemany(f"INSERT INTO staging VALUES ({', '.join('?' * len(TABLE_COLUMNS))})", rows)
    db.execute(merge_statement("payments", "staging", "JSON", first_wins))
    return dict(db.execute("SELECT event_id, description FROM payments").fetchall())


def test_merge_inserts_and_overwrites(db):
    assert merge(db, row("a", "first"), row("b", "first")) == {"a": "first", "b": "first"}
    assert merge(db, row("b", "second"), row("c", "first")) == {
        "a": "first",
        "b": "second",
        "c": "first",
    }


def test_exact_copies_in_staging_are_harmless(db):
    assert merge(db, row("a", "first"), row("a", "first")) == {"a": "first"}


def test_json_type_is_cast():
    assert "CAST(raw_event AS JSONB)" in merge_statement("payments", "staging")


def test_stored_row_stays_until_the_delay_has_passed(db):
    merge(db, row("a", "first"), row("b", "first"), first_wins="1 day")
    later = merge(db, row("a", "second", 23), row("b", "second", 24), first_wins="1 day")
    assert later == {"a": "first", "b": "second"}


def test_table_has_the_key_that_merging_needs_and_its_checks():
    with duckdb.connect() as connection:
        for statement in table_statements("payments", "JSON") * 2:
            connection.execute(statement)
        connection.execute("CREATE TABLE staging AS SELECT * FROM payments")
        assert merge(connection, row("a", "first")) == {"a": "first"}
        assert merge(connection, row("a", "second")) == {"a": "second"}
        with pytest.raises(duckdb.ConstraintException):
            merge(connection, row("b", "first", minor=-1))
        with pytest.raises(duckdb.ConstraintException):
            merge(connection, (*row("b", "first")[:5], None, *row("b", "first")[6:]))


def test_reading_is_dealt_by_ranges_of_event_time(db):
    merge(db, row("a", "first"), row("b", "first", 30))
    first, last = db.execute(bounds_statement("payments")).fetchone()
    assert range_options(first, last, 16) == {
        "partitionColumn": "event_time",
        "lowerBound": "2024-01-01 00:00:00",
        "upperBound": "2024-01-02 06:00:00",
        "numPartitions": "16",
    }
    assert range_options(None, None, 16) == {}


def test_unset_fields_take_the_database_defaults():
    with duckdb.connect() as connection:
        for statement in table_statements("payments", "JSON"):
            connection.execute(statement)
        names = [n for n in TABLE_COLUMNS if n not in ("livemode", "processed_at")]
        values = [v for n, v in zip(TABLE_COLUMNS, row("a", "x"), strict=True) if n in names]
        marks = ", ".join("?" * len(names))
        connection.execute(f"INSERT INTO payments ({', '.join(names)}) VALUES ({marks})", values)
        livemode, at = connection.execute("SELECT livemode, processed_at FROM payments").fetchone()
        assert livemode is False and at is not None


@pytest.fixture
def database(spark, sf_dir, monkeypatch):
    """The payments of the small tables in DuckDB, which runs the statements of ``JdbcPayments``."""
    payments = queries.payments(spark, sf_dir).select(*TABLE_COLUMNS)
    with duckdb.connect() as connection:
        connection.execute("SET TimeZone = 'America/New_York'")
        for statement in table_statements("payments", "JSON"):
            connection.execute(statement)
        arrow = payments.toArrow()  # noqa: F841 - read by name below
        connection.execute(f"INSERT INTO payments SELECT {', '.join(TABLE_COLUMNS)} FROM arrow")
        asked = []

        def run(self, statement):
            asked.append(statement)
            return spark.createDataFrame(connection.execute(statement).to_arrow_table())

        monkeypatch.setattr(JdbcPayments, "_asked", run)
        yield JdbcPayments(spark, "jdbc:none", "user", "word"), asked


def test_reports_are_answered_by_the_database(spark, sf_dir, database):
    table, asked = database
    stored = queries.stored(spark, sf_dir)
    payments = stored.read()
    for make in (
        reports.currencies,
        lambda rows: reports.summary(rows, "gbp"),
        reports.summary_by_currency,
        lambda rows: reports.status_breakdown(rows, "gbp"),
        reports.daily_summary,
    ):
        assert sorted(make(table.totals()).collect()) == sorted(make(payments).collect())
    windows = reports.windows(table.rollup(), 2).collect()
    assert sorted(windows) == sorted(reports.windows(stored.rollup(), 2).collect())
    got = table.hourly("gbp", queries.AS_OF).collect()
    assert got and got == reports.hourly_activity(payments, "gbp", queries.AS_OF).collect()
    for limit in (1, 25):
        got = table.recent("gbp", limit).collect()
        assert got == reports.recent_payments(payments, "gbp", limit).collect()
    assert table.recent("o'brien").collect() == []
    # Every statement groups or stops early.
    assert all("GROUP BY" in text or "LIMIT" in text for text in asked)


def test_dashboard_over_a_database_table(spark, sf_dir, database):
    shown = dashboard(database[0], "gbp", queries.AS_OF)
    same = dashboard(queries.stored(spark, sf_dir), "gbp", queries.AS_OF)
    for name in ("summary", "status", "hourly", "recent"):
        assert getattr(shown, name).collect() == getattr(same, name).collect()
    shown.release()
    same.release()
