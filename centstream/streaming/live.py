"""Live activity per event-time window and currency."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from centstream.operators.route import HOT_KEY_SALTS, WATERMARK, accepted, dedup_within
from centstream.sources.files import Folder

VIEW_DDL = (
    "window_start TIMESTAMP, currency STRING, event_count BIGINT, successful_count BIGINT, "
    "successful_amount DECIMAL(38,3), batch_id BIGINT"
)


def live_activity(
    enriched: DataFrame, width: str, delay: str = WATERMARK, hot_key_salts: int = HOT_KEY_SALTS
) -> DataFrame:
    """Events, successes and successful amount per window of the given width."""
    unique = dedup_within(accepted(enriched), delay, hot_key_salts)
    amount = F.sum(F.when(F.col("is_successful"), F.col("amount_major")))
    return (
        unique.groupBy(F.window("event_time", width), "currency")
        .agg(
            F.count("*").alias("event_count"),
            F.count_if("is_successful").alias("successful_count"),
            F.coalesce(amount, F.lit(0)).cast("decimal(38,3)").alias("successful_amount"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "currency",
            "event_count",
            "successful_count",
            "successful_amount",
        )
    )


def start_live(
    activity: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    fold_every: int = 100,
) -> StreamingQuery:
    """Keep a view of the windows up to date, open ones included.

    Update mode: append mode would hold a window back until the watermark has
    passed its end. Each micro-batch writes the windows that changed, and writes
    the same folder again if it is repeated. Every ``fold_every`` batches the view
    so far is written whole, so that readers need not go through all updates.
    """
    spark = activity.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/updates/batch_id={batch_id}")
        if batch_id % fold_every == fold_every - 1:
            _fold(spark, path, batch_id)

    writer = activity.writeStream.foreachBatch(write).outputMode("update")
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """Latest figures of every window."""
    return _latest(spark, path, _folds(Folder(spark, path))[-1:]).drop("batch_id")


def _folds(files: Folder) -> list[int]:
    """Batches up to which the view was written whole."""
    folds = files.children("folded", "upto=")
    return sorted(int(name) for name in folds if files.exists(f"folded/upto={name}/_SUCCESS"))


def _latest(spark: SparkSession, path: str, fold: list[int]) -> DataFrame:
    updates = spark.read.schema(VIEW_DDL).option("basePath", f"{path}/updates")
    rows = updates.parquet(f"{path}/updates")
    if fold:
        folded = spark.read.schema(VIEW_DDL).parquet(f"{path}/folded/upto={fold[0]}")
        rows = rows.where(F.col("batch_id") > fold[0]).unionByName(folded)
    figures = F.struct("event_count", "successful_count", "successful_amount", "batch_id")
    latest = F.max_by(figures, "batch_id").alias("latest")
    grouped = rows.groupBy("window_start", "currency").agg(latest)
    return grouped.select("window_start", "currency", "latest.*")


def _fold(spark: SparkSession, path: str, batch_id: int) -> None:
    """Write the view whole; remove what only the fold before the last one needs."""
    files = Folder(spark, path)
    folds = _folds(files)
    if batch_id in folds:
        return
    view = _latest(spark, path, folds[-1:])
    view.write.mode("overwrite").parquet(f"{path}/folded/upto={batch_id}")
    if folds:
        for number in files.children("updates", "batch_id="):
            if int(number) <= folds[-1]:
                files.delete(f"updates/batch_id={number}")
        for old in folds[:-1]:
            files.delete(f"folded/upto={old}")
