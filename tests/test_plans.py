"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks import queries
from centstream.operators import ingest, reports, route, upsert
from centstream.session import new_folder
from centstream.sources.payments import PaymentsTable

from .conftest import plan_of, simple_plan_of


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return queries.stored(spark, sf_dir)


@pytest.fixture(scope="module")
def bus_files(spark, sf_dir):
    folder = new_folder(spark, "bus")
    queries.bus(spark, sf_dir).write.parquet(folder)
    return folder


def enriched(spark, folder):
    from centstream.plans.batch import check_records
    from centstream.sources.bus import file_batch

    return check_records(file_batch(spark, folder), queries.clock())


def test_json_is_parsed_once_per_record(spark, bus_files):
    for frame in (
        route.valid_records(enriched(spark, bus_files)),
        route.rejected_records(enriched(spark, bus_files)),
    ):
        assert simple_plan_of(frame).count("from_json(") == 1


def test_webhook_body_is_parsed_once_and_moves_nothing(spark, sf_dir):
    folder = new_folder(spark, "bronze")
    queries.deliveries(spark, sf_dir).write.parquet(folder)
    bronze = spark.read.parquet(folder)
    done = ingest.ingest(bronze, queries.keys(spark)).where("ingest_status = 'published'")
    plan = simple_plan_of(done)
    assert plan.count("parseJson(") == 1
    # The only exchange gathers the few keys.
    assert plan.count("Exchange") == plan.count("Exchange SinglePartition") == 1


def test_validation_moves_nothing(spark, bus_files):
    plan = simple_plan_of(route.rejected_records(enriched(spark, bus_files)))
    assert "Exchange" not in plan


def test_repeats_are_reduced_before_the_shuffle(spark, bus_files):
    plan = simple_plan_of(route.valid_records(enriched(spark, bus_files)))
    assert plan.count("Exchange") == 1
    after, before = plan.split("Exchange")
    assert "Partial" in before and "Final" in after
    # Trace text stays behind.
    assert "raw_value" not in after


def test_second_reduction_by_key_needs_no_shuffle(spark, bus_files):
    rows = route.valid_records(enriched(spark, bus_files))
    assert simple_plan_of(upsert.one_row_per_key(rows)).count("Exchange") == 1


def test_reports_push_filters_and_read_few_columns(table):
    plan = plan_of(reports.summary(table.read(), "gbp"))
    assert "EqualTo(currency,gbp)" in plan
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert sorted(f.split(":")[0] for f in schema.split(",") if ":" in f) == [
        "amount_major",
        "currency",
        "is_successful",
    ]
    assert "partial_count" in plan


def test_hourly_activity_prunes_days(table):
    plan = plan_of(reports.hourly_activity(table.read(), "gbp", queries.AS_OF))
    assert re.search(r"PartitionFilters: \[.*event_day.* >= ", plan)


def test_recent_payments_is_a_top_k(table):
    plan = simple_plan_of(reports.recent_payments(table.read(), "gbp"))
    assert "TakeOrderedAndProject" in plan
    assert "Exchange" not in plan


def test_merge_with_a_small_batch_does_not_move_the_table(spark, sf_dir, table):
    new = PaymentsTable(spark, new_folder(spark, "small"))
    new.upsert(queries.payments_of(spark, sf_dir, queries.REPEAT))
    merged = upsert.merge_upsert(table.read(), new.read())
    plan = simple_plan_of(merged)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "hashpartitioning" not in plan


def test_key_lookup_reads_one_column_and_does_not_move_the_table(table):
    pieces = table.state().pieces()
    hits = table._hits(pieces[:1], {"rows": 1_000_000, "key_bytes": 1000}, pieces)
    assert "BroadcastHashJoin" in simple_plan_of(hits)
    assert "hashpartitioning" not in simple_plan_of(hits)
    columns = re.findall(r"ReadSchema: struct<(.*)>", plan_of(hits))
    assert columns == ["event_id:string", "event_id:string"]


def test_no_python_in_any_batch_plan(spark, sf_dir):
    for name, query in queries.QUERIES.items():
        if not name.startswith(("stream_", "table_upsert")):
            plan = simple_plan_of(query(spark, sf_dir))
            assert "Python" not in plan and "InPandas" not in plan, name
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_rejected_files_prune_by_date(spark):
    from centstream.streaming.job import read_rejected

    folder = new_folder(spark, "rejected")
    spark.range(1).select(
        F.lit("x").alias("raw_value"), F.lit("2024-02-01").cast("date").alias("rejection_date")
    ).write.partitionBy("rejection_date").json(folder)
    plan = plan_of(read_rejected(spark, folder).where("rejection_date = DATE '2024-02-01'"))
    assert re.search(r"PartitionFilters: \[.*rejection_date", plan)


def test_reports_that_add_up_read_no_payment(table):
    totals = table.totals()
    for report in (
        reports.currencies(totals),
        reports.summary(totals, "gbp"),
        reports.summary_by_currency(totals),
        reports.status_breakdown(totals, "gbp"),
        reports.daily_summary(totals),
    ):
        assert report.inputFiles() and all("/rollup/" in path for path in report.inputFiles())


def test_reports_of_totals_are_those_of_payments(table):
    rows, totals = table.read(), table.totals()
    for make in (
        reports.currencies,
        lambda df: reports.default_currency(df, "GBP"),
        lambda df: reports.summary(df, "gbp"),
        lambda df: reports.summary(df, "none"),
        reports.summary_by_currency,
        lambda df: reports.status_breakdown(df, "gbp"),
        reports.daily_summary,
    ):
        want, got = make(rows), make(totals)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(got.collect()) == sorted(want.collect())


def test_table_contract_reads_its_input_once(spark, sf_dir):
    from checks.queries import table_contract

    plan = simple_plan_of(table_contract(spark, sf_dir))
    assert plan.count("FileScan") == 1
    assert plan.count("from_json") == 1
