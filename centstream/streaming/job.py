"""The payment stream: valid records into the table, refused ones into dated files.

Both queries read the source on their own and keep their own checkpoint, so a
failing sink does not hold up the other.
"""

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from centstream.operators.ingest import ingest, published_events
from centstream.operators.route import (
    WATERMARK,
    accepted,
    dedup_first,
    payment_columns,
    rejected_records,
)
from centstream.plans.batch import check_records
from centstream.session import build_session
from centstream.settings import JobSettings
from centstream.sources.bus import kafka_stream, publish_stream
from centstream.sources.jdbc import JdbcPayments
from centstream.sources.payments import WHOLE_TABLE, PaymentsTable
from centstream.streaming.counts import BatchCounts, watched
from centstream.streaming.rejects import RejectedFiles, read_rejected

__all__ = ["read_rejected", "start_job", "start_rejected", "start_valid", "start_valid_late_safe"]

LOGGER = logging.getLogger(__name__)

# Query names, under which the table also notes the last batch of each stream.
VALID_QUERY = "valid-payments"
REJECTED_QUERY = "rejected-records"

# Process what is there and stop; the form used by tests and backfills.
DRAIN = {"availableNow": True}


def start_valid(
    bus: DataFrame,
    table: PaymentsTable | JdbcPayments,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    delay: str = WATERMARK,
    processed_at: Column | None = None,
    key_scope: str = WHOLE_TABLE,
    tidy_every: int = 0,
    name: str = VALID_QUERY,
) -> StreamingQuery:
    """Store the first arrival of every key; no record is too late.

    Each micro-batch is reduced by arrival order, whatever its partitions, and then
    decided against the stored keys: a copy less than ``delay`` after the stored
    row is dropped, a later one overwrites. The table is the state. Every
    ``tidy_every`` batches its small parts are joined and unneeded files removed.
    """
    passed = accepted(watched(check_records(bus, processed_at)))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = payment_columns(dedup_first(batch))
        table.upsert(rows, name, batch_id, key_scope, unique=True, first_wins=delay)
        _tidy(table, batch_id, tidy_every)

    return _start(passed.writeStream.foreachBatch(write), name, checkpoint, trigger)


def start_valid_late_safe(
    bus: DataFrame,
    table: PaymentsTable | JdbcPayments,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    processed_at: Column | None = None,
    key_scope: str = WHOLE_TABLE,
    tidy_every: int = 0,
    name: str = VALID_QUERY,
) -> StreamingQuery:
    """Like ``start_valid``, but a copy in a later batch always overwrites the stored row."""
    passed = accepted(watched(check_records(bus, processed_at)))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = payment_columns(dedup_first(batch))
        table.upsert(rows, name, batch_id, key_scope, unique=True)
        _tidy(table, batch_id, tidy_every)

    return _start(passed.writeStream.foreachBatch(write), name, checkpoint, trigger)


def _tidy(table: PaymentsTable, batch_id: int, every: int) -> None:
    if every and batch_id % every == every - 1:
        table.compact()
        table.vacuum()


def start_rejected(
    bus: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    processed_at: Column | None = None,
    tidy_every: int = 0,
    name: str = REJECTED_QUERY,
) -> StreamingQuery:
    """File refused records as JSON, a folder per rejection date and micro-batch.

    Every ``tidy_every`` batches the folders of dates that are over are joined.
    """
    rejected = rejected_records(watched(check_records(bus, processed_at)))
    files = RejectedFiles(bus.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        files.write(batch, batch_id)
        if tidy_every and batch_id % tidy_every == tidy_every - 1:
            files.join_dates(batch_id)

    return _start(rejected.writeStream.foreachBatch(write), name, checkpoint, trigger)


def _start(writer, name: str, checkpoint: str, trigger: Mapping[str, object] | None):
    if trigger:
        writer = writer.trigger(**trigger)
    writer = writer.outputMode("append").queryName(name).option("checkpointLocation", checkpoint)
    return writer.start()


def progress_counts(query: StreamingQuery) -> dict[str, int]:
    """Rows read, rows dropped as late and rows of state, over the last hundred batches.

    ``counts.BatchCounts`` keeps those of all batches.
    """
    counts = {"input_rows": 0, "dropped_as_late": 0, "state_rows": 0}
    for progress in query.recentProgress:
        counts["input_rows"] += progress.numInputRows
        operators = progress.stateOperators
        counts["dropped_as_late"] += sum(op.numRowsDroppedByWatermark for op in operators)
        counts["state_rows"] = sum(op.numRowsTotal for op in operators)
    return counts


def start_ingest(
    bronze: DataFrame, keys: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Verify, flatten and publish raw webhook deliveries as they arrive."""
    return publish_stream(published_events(ingest(bronze, keys)), servers, topic, checkpoint)


def payments_sink(spark: SparkSession, settings: JobSettings) -> PaymentsTable | JdbcPayments:
    """The database where one is set, else the file table."""
    if settings.jdbc_url is None:
        return PaymentsTable(spark, settings.table_path)
    if settings.jdbc_user is None or settings.jdbc_password is None:
        raise ValueError("a JDBC sink needs JDBC_USER and JDBC_PASSWORD")
    return JdbcPayments(spark, settings.jdbc_url, settings.jdbc_user, settings.jdbc_password)


def start_job(
    spark: SparkSession,
    settings: JobSettings,
    bus: DataFrame,
    trigger: Mapping[str, object] | None = None,
) -> list[StreamingQuery]:
    """Start the valid and the refused query on one source."""
    common = {
        "checkpoint": f"{settings.checkpoint_root}/valid",
        "trigger": trigger,
        "key_scope": settings.key_scope,
        "tidy_every": 0 if settings.jdbc_url else settings.tidy_every,
    }
    spark.streams.addListener(BatchCounts(spark, f"{settings.checkpoint_root}/counts"))
    sink = payments_sink(spark, settings)
    if settings.late_safe:
        valid = start_valid_late_safe(bus, sink, **common)
    else:
        valid = start_valid(bus, sink, delay=settings.watermark, **common)
    checkpoint = f"{settings.checkpoint_root}/rejected"
    rejected = start_rejected(
        bus, settings.rejected_path, checkpoint, trigger, tidy_every=settings.tidy_every
    )
    LOGGER.info("started valid=%s rejected=%s", valid.id, rejected.id)
    return [valid, rejected]


def run(settings: JobSettings) -> None:
    """Read from Kafka until one of the queries ends, then stop both."""
    logging.basicConfig(level=settings.log_level)
    spark = build_session("payment-stream", settings.shuffle_partitions)
    bus = kafka_stream(
        spark,
        settings.kafka_servers,
        settings.topic,
        settings.max_offsets_per_trigger,
        settings.min_partitions,
        settings.fail_on_data_loss,
    )
    queries = start_job(spark, settings, bus)
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
        spark.stop()


if __name__ == "__main__":
    run(JobSettings.from_environment())
