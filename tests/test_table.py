"""The payments table: upserts, versions, replays, compaction."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from centstream.contract import TABLE_COLUMNS, VALID_DDL
from centstream.operators import quality, reports
from centstream.operators.reports import day_totals
from centstream.operators.upsert import merge_upsert, one_row_per_key, with_raw_event
from centstream.session import new_folder
from centstream.sources import payments as tables
from centstream.sources.payments import SAME_DAY, PaymentsTable

NOON = datetime(2024, 1, 10, 12)


def row(key, day=10, note="first", currency="gbp", amount="1.000", minute=0):
    when = NOON.replace(day=day) + timedelta(minutes=minute)
    return (
        key, "pi", "payment_intent.succeeded", 100, Decimal(amount), currency, "succeeded", note,
        None, True, True, when, when, NOON, "stripe",
    )


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), VALID_DDL)


def notes(df):
    return {r.event_id: (r.event_time.day, r.description) for r in df.collect()}


@pytest.fixture
def table(spark):
    return PaymentsTable(spark, new_folder(spark, "table"))


def test_new_table_is_empty(table):
    assert table.state().version == 0
    assert table.read().count() == 0
    assert table.read().columns == [*TABLE_COLUMNS, "event_day"]


def test_upsert_inserts_and_overwrites(spark, table):
    table.upsert(batch(spark, row("a"), row("b"), row("c", day=11)))
    table.upsert(batch(spark, row("b", note="second"), row("d", day=12)))
    assert notes(table.read()) == {
        "a": (10, "first"),
        "b": (10, "second"),
        "c": (11, "first"),
        "d": (12, "first"),
    }


def test_upsert_twice_is_upsert_once(spark, table):
    rows = batch(spark, row("a"), row("b", day=11))
    table.upsert(rows)
    once = notes(table.read())
    table.upsert(rows)
    assert notes(table.read()) == once
    assert table.read().count() == 2


def test_upsert_moves_a_key_to_another_day(spark, table):
    table.upsert(batch(spark, row("a"), row("b", day=11)))
    table.upsert(batch(spark, row("a", day=20, note="moved")))
    assert notes(table.read()) == {"a": (20, "moved"), "b": (11, "first")}
    # Its old day is empty now and gone.
    assert list(table.state().days) == ["2024-01-11", "2024-01-20"]


def test_same_day_scope_looks_at_the_days_of_the_batch(spark, table):
    table.upsert(batch(spark, row("a"), row("b")))
    table.upsert(batch(spark, row("a", note="second")), key_scope=SAME_DAY)
    assert notes(table.read()) == {"a": (10, "second"), "b": (10, "first")}


def test_same_day_scope_takes_a_batch_of_new_days(spark, table):
    table.upsert(batch(spark, row("a")))
    table.upsert(batch(spark, row("b", day=20)), key_scope=SAME_DAY)
    assert notes(table.read()) == {"a": (10, "first"), "b": (20, "first")}


def test_unknown_scope_is_refused(spark, table):
    with pytest.raises(ValueError, match="key_scope"):
        table.upsert(batch(spark, row("a")), key_scope="Table")


def test_payment_without_a_key_is_refused(spark, table):
    with pytest.raises(Exception, match="no event_id"):
        table.upsert(batch(spark, row("a"), row(None)))
    assert table.state().days == {}


def test_new_keys_rewrite_nothing(spark, table):
    table.upsert(batch(spark, row("a")))
    before = table.state().pieces()
    table.upsert(batch(spark, row("b")))
    assert set(before) < set(table.state().pieces())


def test_only_days_with_a_stored_key_are_rewritten(spark, table):
    table.upsert(batch(spark, row("a"), row("b", day=11)))
    untouched = [p for p in table.state().pieces() if p.day == "2024-01-11"]
    table.upsert(batch(spark, row("a", note="second")))
    assert set(untouched) < set(table.state().pieces())


def test_only_files_with_a_stored_key_are_rewritten(spark, table):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "8KB")
    try:
        many = [row(f"k{i}", note=f"note {i}", minute=i % 600) for i in range(4000)]
        table.upsert(batch(spark, *many).repartition(8), unique=True)
    finally:
        spark.conf.unset(size)
    files = set(table.read().inputFiles())
    table.upsert(batch(spark, row("k7", note="second")))
    left = set(table.read().inputFiles())
    assert len(files) > 2
    assert len(files - left) == 1
    assert table.read().count() == 4000
    assert notes(table.read().where("event_id = 'k7'")) == {"k7": (10, "second")}
    table.compact(max_loose=0)
    assert table.read().count() == 4000


def rows_read(df):
    """Payments that the scans of a plan gave when it was run."""
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while "Stage" in leaf.nodeName():
            leaf = leaf.plan().collectLeaves().apply(0)
        if "Scan parquet" in leaf.nodeName() and "event_" in leaf.schemaString():
            total += leaf.metrics().apply("numOutputRows").value()
    return total


def many_files(spark, table, files, per_file):
    """A table of so many files of one row group; ids are spread over all of them."""
    rows = spark.range(files * per_file).selectExpr(
        "md5(CAST(id AS STRING)) AS event_id", "'pi' AS payment_id", "'t' AS event_type",
        "1L AS amount_minor", "CAST(1 AS DECIMAL(18,3)) AS amount_major", "'gbp' AS currency",
        "'s' AS payment_status", "'first' AS description", "CAST(NULL AS STRING) AS customer_id",
        "true AS livemode", "true AS is_successful",
        f"timestampadd(DAY, CAST(id % {files} AS INT), TIMESTAMP '2024-01-01') AS event_time",
        "TIMESTAMP '2024-01-01' AS received_at", "TIMESTAMP '2024-01-01' AS processed_at",
        "'stripe' AS source",
    )
    table.upsert(rows, unique=True)


@pytest.mark.parametrize("dictionary", ["true", "false"])
def test_lookup_of_a_thousand_keys_reads_a_tenth_of_the_row_groups(spark, table, dictionary):
    files, per_file = 100, 400
    spark.conf.set("parquet.enable.dictionary", dictionary)  # without one, the Bloom filter decides
    try:
        many_files(spark, table, files, per_file)
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    assert len(table.read().inputFiles()) == files
    old = table.state().pieces()
    known = [f"{i:032x}" for i in range(997)]
    stored = spark.range(1).selectExpr("md5('7') a", "md5('1007') b", "md5('2007') c").first()
    new = table._write_part(batch(spark, *(row(k) for k in [*known, *stored])), with_raw_event)
    seen = {"rows": 1000, "key_bytes": 32_000}
    with table._pushing_keys():
        hits = table._hits(new, seen, old)
        found = hits.collect()
    assert {r.event_day.isoformat() for r in found} == {"2024-01-08"} and len(found) == 3
    assert rows_read(hits) - 1000 <= files * per_file / 10
    assert spark.conf.get(tables.IN_THRESHOLD) == "10"


def test_lookups_by_value_and_by_scan_agree(spark, table, monkeypatch):
    table.upsert(batch(spark, *(row(f"k{i}", day=1 + i % 9) for i in range(90))))
    again = batch(spark, row("k3", note="second"), row("k44", day=20, note="second"), row("new"))
    monkeypatch.setattr(tables, "MAX_LOOKUP_KEYS", 0)
    scanned = PaymentsTable(spark, new_folder(spark, "table"))
    scanned.upsert(table.read().withColumn("source", F.lit("stripe")))
    scanned.upsert(again)
    monkeypatch.undo()
    table.upsert(again)
    assert notes(table.read()) == notes(scanned.read())
    late = batch(spark, row("k3", note="third"), row("k5", day=28, note="third"))
    for each, most in ((table, 2000), (scanned, 0)):
        monkeypatch.setattr(tables, "MAX_LOOKUP_KEYS", most)
        each.upsert(late, first_wins="1 day")
    assert notes(table.read()) == notes(scanned.read())


def test_large_batches_join_without_broadcast(spark, table, monkeypatch):
    monkeypatch.setattr(tables, "MAX_BROADCAST_KEY_BYTES", 0)
    table.upsert(batch(spark, row("a"), row("b")))
    table.upsert(batch(spark, row("a", note="second")))
    assert notes(table.read()) == {"a": (10, "second"), "b": (10, "first")}


def test_batch_with_repeated_key_keeps_the_earliest(spark, table):
    table.upsert(batch(spark, row("a", note="later", minute=5), row("a", note="earlier")))
    assert notes(table.read()) == {"a": (10, "earlier")}


def test_hot_key_is_reduced_to_one_row(spark):
    hot = batch(spark, *(row("hot", minute=i) for i in range(500)))
    kept = one_row_per_key(hot.unionByName(batch(spark, *(row(f"k{i}") for i in range(50)))))
    assert kept.count() == 51


def test_replayed_batch_changes_nothing(spark, table):
    table.upsert(batch(spark, row("a")), "s", 0)
    table.upsert(batch(spark, row("a", note="second")), "s", 1)
    version = table.state().version
    table.upsert(batch(spark, row("a", note="replay")), "s", 1)
    table.upsert(batch(spark, row("a", note="replay")), "s", 0)
    assert table.state().version == version
    assert notes(table.read()) == {"a": (10, "second")}
    # Another stream counts its batches on its own.
    table.upsert(batch(spark, row("a", note="other")), "t", 0)
    assert notes(table.read()) == {"a": (10, "other")}


def test_empty_batch_is_recorded(spark, table):
    table.upsert(batch(spark, row("a")), "s", 0)
    table.upsert(batch(spark), "s", 1)
    assert table.state().streams == {"s": 1}
    assert notes(table.read()) == {"a": (10, "first")}


def test_old_version_stays_readable(spark, table):
    table.upsert(batch(spark, row("a")))
    table.upsert(batch(spark, row("a", note="second")))
    assert notes(table.read(version=1)) == {"a": (10, "first")}
    assert notes(table.read(version=2)) == {"a": (10, "second")}


def test_second_writer_of_a_version_fails(spark, table):
    table.upsert(batch(spark, row("a")))
    stale = table.state().changed()
    table.upsert(batch(spark, row("b")))
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(stale)
    assert table.read().count() == 2


def test_compact_joins_loose_parts_once(spark, table):
    for number in range(3):
        table.upsert(batch(spark, row(f"k{number}"), row(f"m{number}", day=11)))
    before = notes(table.read())
    table.compact(max_loose=2)
    assert [len(parts) for parts in table.state().days.values()] == [1, 1]
    assert notes(table.read()) == before
    version = table.state().version
    assert table.compact(max_loose=2).version == version
    for number in range(3, 6):
        table.upsert(batch(spark, row(f"k{number}")))
    (joined,) = [part for part in table.state().days["2024-01-10"] if part.startswith("joined")]
    table.compact(max_loose=2)
    assert joined in table.state().days["2024-01-10"]


def test_compact_joins_whole_days_in_the_end(spark, table):
    for number in range(6):
        table.upsert(batch(spark, row(f"k{number}")))
        table.compact(max_loose=0, max_joined=3)
    assert len(table.state().days["2024-01-10"]) <= 4
    assert table.read().count() == 6


def test_vacuum_keeps_what_is_needed(spark, table):
    for note in ("first", "second", "third"):
        table.upsert(batch(spark, row("a", note=note), row("b", day=11)))
    assert table.vacuum() == 0
    assert notes(table.read(version=1))["a"] == (10, "first")
    assert table.vacuum(keep_versions=1, keep_hours=0) > 0
    assert notes(table.read()) == {"a": (10, "third"), "b": (11, "first")}
    assert table.vacuum(keep_versions=1, keep_hours=0) == 0
    table.upsert(batch(spark, row("a", note="fourth")))
    assert notes(table.read())["a"] == (10, "fourth")


def test_vacuum_keeps_the_asked_number_of_versions(spark, table):
    for note in ("first", "second", "third"):
        table.upsert(batch(spark, row("a", note=note)))
    table.vacuum(keep_versions=2, keep_hours=0)
    assert notes(table.read(version=2)) == {"a": (10, "second")}
    assert sorted(table._version_ages()) == [2, 3]
    PaymentsTable(spark, new_folder(spark, "empty")).vacuum(keep_hours=0)


def test_a_day_with_most_of_the_rows_is_split_over_files(spark, table):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "8KB")
    try:
        hot = [row(f"k{i}", note=f"note {i}", minute=i % 600) for i in range(4000)]
        rows = batch(spark, *hot, row("b", day=11)).repartition(8)
        table.upsert(rows, unique=True)
    finally:
        spark.conf.unset(size)
    files = table.read(days=["2024-01-10"]).inputFiles()
    assert len(files) > 1
    assert table.read().count() == 4001


def test_days_narrow_the_read(spark, table):
    table.upsert(batch(spark, row("a"), row("b", day=11)))
    assert notes(table.read(days=["2024-01-11", "2030-01-01"])) == {"b": (11, "first")}


def test_recent_reads_only_the_days_it_needs(spark, table):
    rows = [row(f"k{day}-{i}", day=day, minute=i) for day in range(1, 29) for i in range(4)]
    table.upsert(batch(spark, *rows, row("lone", day=1, currency="eur", note="lone")))
    few = table.recent("gbp", 3)
    assert [r.event_time.day for r in few.collect()] == [28, 28, 28]
    assert rows_read(few) == 4
    assert table.recent("gbp", 100).count() == 100
    assert [r.description for r in table.recent("eur", 5).collect()] == ["lone"]
    assert table.recent("chf").count() == 0


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 5), max_size=4),
        min_size=1,
        max_size=4,
    ),
    st.booleans(),
)
def test_any_sequence_of_upserts_is_a_dictionary(spark, batches, tidy):
    table = PaymentsTable(spark, new_folder(spark, "model"))
    model = {}
    for number, days in enumerate(batches):
        table.upsert(batch(spark, *(row(k, day=d, note=str(number)) for k, d in days.items())))
        model |= {key: (day, str(number)) for key, day in days.items()}
        if tidy:
            table.compact(max_loose=1)
            table.vacuum(keep_versions=1, keep_hours=0)
    assert notes(table.read()) == model
    assert table.read().count() == len(model)


def test_merge_equals_the_table(spark, table):
    old = batch(spark, row("a"), row("b"))
    new = batch(spark, row("b", day=12, note="second"), row("c"))
    table.upsert(old)
    table.upsert(new)
    merged = merge_upsert(with_raw_event(old), with_raw_event(new))
    assert sorted(merged.collect()) == sorted(table.read().drop("event_day").collect())


def test_raw_event_is_exact_text(spark):
    raw = json.loads(with_raw_event(batch(spark, row("a", amount="12.340"))).first().raw_event)
    assert len(raw) == 15
    assert raw["amount_major"] == "12.340"
    assert raw["event_time"] == "2024-01-10T12:00:00.000000Z"
    assert raw["customer_id"] is None
    assert raw["source"] == "stripe"


def test_contract_report(spark):
    rows = batch(spark, row("a"), row("a"), row("b", currency="long"), row("c", amount="-1.000"))
    rows = rows.withColumn("payment_id", F.when(F.col("event_id") != "b", F.col("payment_id")))
    found = quality.table_contract(with_raw_event(rows)).collect()
    report = {r.constraint_name: r.violations for r in found}
    assert len(report) == 16
    assert {name: n for name, n in report.items() if n} == {
        "event_id PRIMARY KEY": 1,
        "currency VARCHAR(3)": 1,
        "amount_major >= 0": 1,
        "payment_id NOT NULL": 1,
    }


def _added_up(totals):
    keys = ["event_day", "currency", "payment_status"]
    sums = [F.sum(c).alias(c) for c in ("event_count", "successful_count", "successful_amount")]
    return sorted(tuple(r) for r in totals.groupBy(*keys).agg(*sums).collect())


def test_totals_follow_every_version(spark, table):
    """Inserts, overwrites, moves to another day, emptied days, compaction, old versions."""
    assert table.totals().count() == 0
    steps = [
        [row("a"), row("b", currency="eur"), row("c", day=11)],
        [row("a", amount="2.500"), row("d", day=12)],
        [row("c", day=13, amount="7.000"), row("e", day=11, currency="eur")],
        [row("e", day=14, currency="eur")],
    ]
    for rows in steps:
        table.upsert(batch(spark, *rows))
        assert _added_up(table.totals()) == _added_up(day_totals(table.read()))
    table.compact(max_loose=0)
    assert _added_up(table.totals()) == _added_up(day_totals(table.read()))
    for version in range(1, 6):
        want = _added_up(day_totals(table.read(version)))
        assert _added_up(table.totals(version)) == want
    table.vacuum(keep_versions=1, keep_hours=0)
    assert _added_up(table.totals()) == _added_up(day_totals(table.read()))
    kept = {path.split("/rollup/")[1].split("/")[0] for path in table.totals().inputFiles()}
    assert kept == set(table.state().rollup) == set(table._files.children("rollup"))


def test_totals_of_redelivered_streams(spark, table):
    table.upsert(batch(spark, row("a"), row("b")), "s", 0, first_wins="1 day")
    table.upsert(batch(spark, row("a", note="again"), row("c")), "s", 1, first_wins="1 day")
    assert _added_up(table.totals()) == _added_up(day_totals(table.read()))
    assert sum(r.event_count for r in table.totals().collect()) == 3


def test_windows_follow_overwrites_moves_and_compaction(spark, table):
    steps = [
        [row("a", minute=0), row("b", minute=70), row("c", day=11, currency="eur")],
        [row("a", minute=130, amount="2.000"), row("late", day=1)],
        [row("c", day=12, currency="gbp"), row("b", minute=70, amount="9.000")],
    ]
    for rows in steps:
        table.upsert(batch(spark, *rows))
        for hours in (1, 24):
            got = reports.windows(table.rollup(), hours)
            payments = table.read().withColumn("sign", F.lit(1))
            want = reports.windows(reports.changes_of(payments), hours)
            assert sorted(got.collect()) == sorted(want.collect())
    before = sorted(reports.windows(table.rollup()).collect())
    table.compact(max_loose=0)
    assert len(table.state().rollup) == 1
    assert sorted(reports.windows(table.rollup()).collect()) == before


def test_tables_without_a_rollup_are_added_up_from_payments(spark, table):
    table.upsert(batch(spark, row("a"), row("b", currency="eur")))
    body = json.loads(table._files.read_text("state/0000000001.json"))
    del body["rollup"]
    table._files.delete("state/0000000001.json")
    assert table._files.write_new("state/0000000001.json", json.dumps(body))
    table.upsert(batch(spark, row("a", amount="3.000"), row("c", day=12)))
    assert table.state().rollup is None
    assert _added_up(table.totals()) == _added_up(day_totals(table.read()))


def test_recent_payments_start_no_job_before_they_are_asked_for(spark, table):
    table.upsert(batch(spark, *(row(f"k{i}", day=1 + i % 20, minute=i) for i in range(60))))
    context = spark.sparkContext
    context.setJobGroup("recent", "recent")
    try:
        recent = table.recent("gbp", 5)
        assert not context.statusTracker().getJobIdsForGroup("recent")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    want = reports.recent_payments(table.read(), "gbp", 5)
    assert recent.collect() == want.collect()
    # Two days hold enough; the others' rows are not read.
    assert rows_read(recent) == 6
    assert table.recent("none").collect() == []


def test_pinned_table_stays_as_it_was(spark, table):
    table.upsert(batch(spark, row("a")))
    then = table.pinned()
    table.upsert(batch(spark, row("b")))
    assert (then.read().count(), then.totals().count(), then.recent("gbp").count()) == (1, 1, 1)
    assert table.read().count() == 2
