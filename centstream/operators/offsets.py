"""Offsets that are missing from a topic's records."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of one topic partition that are put in order together.
RANGE = 1 << 20


def offset_gaps(records: DataFrame, width: int = RANGE) -> DataFrame:
    """Runs of missing offsets: ``topic, partition, first_missing, last_missing, missing``.

    A run lies between two records that are there, so nothing is said of offsets
    before the first or behind the last. Repeated records count once; records
    without topic, partition or offset are left out.

    Records are put in order within ranges of ``width`` offsets, so a topic of few
    partitions is spread over many tasks; only the first and last offset of each range
    meet again per partition. Transactions and compaction also leave gaps in a topic.
    """
    place = records.select("topic", "partition", F.col("offset").cast("long").alias("offset"))
    place = place.dropna().withColumn("_range", F.floor(F.col("offset") / width))
    whole = Window.partitionBy("topic", "partition", "_range")
    marked = place.withColumns(
        {
            "_before": F.lag("offset").over(whole.orderBy("offset")),
            "_last": F.max("offset").over(whole),
        }
    )
    heads = marked.where(F.col("_before").isNull())
    by_partition = Window.partitionBy("topic", "partition").orderBy("offset")
    heads = heads.withColumn("_before", F.lag("_last").over(by_partition))
    gap = F.col("offset") - F.col("_before") > 1
    return (
        marked.where(gap)
        .unionByName(heads.where(gap))
        .select(
            "topic",
            "partition",
            (F.col("_before") + 1).alias("first_missing"),
            (F.col("offset") - 1).alias("last_missing"),
            (F.col("offset") - F.col("_before") - 1).alias("missing"),
        )
    )
