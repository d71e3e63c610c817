"""Delivery counts of a stream that publishes webhooks."""

import pytest
from pyspark.sql import functions as F

from centstream.contract import BRONZE_DDL
from centstream.operators import ingest
from centstream.session import new_folder
from centstream.streaming.deliveries import delivery_batches, delivery_report, start_deliveries
from checks import queries
from checks.queries import deliveries, keys


def counted(df):
    return {row[0]: row[1] for row in df.select("ingest_status", "delivery_count").collect()}


@pytest.fixture
def bronze(spark, sf_dir):
    folder = new_folder(spark, "bronze")
    deliveries(spark, sf_dir).select("body", "sig_header", "arrived_at").repartition(
        6
    ).write.parquet(folder)
    return folder


def test_outcomes_add_up_to_deliveries_after_a_failure(spark, bronze):
    out, reports, checkpoint = (new_folder(spark, label) for label in ("out", "reports", "cp"))
    failures = ["first"]

    def publish(ready):
        ready.write.mode("append").parquet(out)
        if failures:
            raise RuntimeError(failures.pop())  # sent, but the batch isn't noted

    def go():
        stream = spark.readStream.schema(BRONZE_DDL).option("maxFilesPerTrigger", 2)
        return start_deliveries(
            stream.parquet(bronze), keys(spark), publish, checkpoint, reports, {"availableNow": True}
        )

    with pytest.raises(Exception, match="first"):
        go().awaitTermination()
    assert delivery_batches(spark, reports).count() == 0
    go().awaitTermination()
    go().awaitTermination()  # nothing new
    table = spark.read.schema(BRONZE_DDL).parquet(bronze)
    outcomes = ingest.ingest_outcomes(ingest.ingest(table, keys(spark)))
    assert counted(delivery_report(spark, reports)) == counted(outcomes)
    assert delivery_batches(spark, reports).count() == 3
    total = delivery_report(spark, reports).agg(F.sum("delivery_count")).first()[0]
    assert total == table.count()


def test_no_report_yet(spark):
    assert delivery_report(spark, new_folder(spark, "none")).collect() == []


def test_each_delivery_is_built_for_one_run_only(spark, sf_dir, monkeypatch):
    sent, deliver = [], queries._deliver

    def watched(spark, folder, records):
        sent.append(records)
        deliver(spark, folder, records)

    monkeypatch.setattr(queries, "_deliver", watched)
    queries.stream_deliveries(spark, sf_dir)
    for records in sent:
        plan = records._jdf.queryExecution().optimizedPlan().toString().lower()
        filters = [line for line in plan.splitlines() if "filter" in line]
        assert filters and not any("json" in line for line in filters)
    first, second = (records.count() for records in sent)
    assert first and second and first + second == deliveries(spark, sf_dir).count()
    both = sent[0].unionAll(sent[1])
    assert both.exceptAll(deliveries(spark, sf_dir)).isEmpty()
