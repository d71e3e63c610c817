"""Webhook deliveries as a stream: publish the good ones, keep count of all outcomes.

Outcomes are counted while a batch is being published, in the same pass, and noted under
the batch's number once the bus has taken it. A batch that is sent again after a failure
is noted once, so the counts over a query's life add up to its deliveries.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from centstream.operators.ingest import OUTCOMES, ingest, published_events
from centstream.streaming.counts import CountLog, batch_counts, life_counts

INGEST_QUERY = "webhook-ingest"


def start_deliveries(
    bronze: DataFrame,
    keys: DataFrame,
    publish: Callable[[DataFrame], None],
    checkpoint: str,
    reports: str,
    trigger: Mapping[str, object] | None = None,
    name: str = INGEST_QUERY,
) -> StreamingQuery:
    """Hand each micro-batch's publishable events to ``publish``, which sends them at once.

    ``publish`` may get a batch again after a failure. Its one action counts the
    outcomes too; if it runs several, the first counts.
    """
    log = CountLog(bronze.sparkSession, reports, OUTCOMES)

    def send(batch: DataFrame, batch_id: int) -> None:
        watch = Observation()
        counts = (F.count_if(F.col("ingest_status") == kind).alias(kind) for kind in OUTCOMES)
        publish(published_events(ingest(batch, keys).observe(watch, *counts)))
        log.note(name, batch_id, *(watch.get[kind] for kind in OUTCOMES))

    writer = bronze.writeStream.foreachBatch(send).queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()


def delivery_batches(spark: SparkSession, reports: str) -> DataFrame:
    """One row per query and batch, a column per outcome."""
    return batch_counts(spark, reports, OUTCOMES)


def delivery_report(spark: SparkSession, reports: str) -> DataFrame:
    """Deliveries per query and outcome over all runs; outcomes that never came are left out."""
    found = life_counts(spark, reports, OUTCOMES)
    report = found.unpivot("query", list(OUTCOMES), "ingest_status", "delivery_count")
    return report.where("delivery_count > 0")
