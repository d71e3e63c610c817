"""Insert-or-overwrite by ``event_id``."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centstream.contract import TABLE_COLUMNS, VALID_COLUMNS
from centstream.functions.clock import iso_utc
from centstream.operators.publish import KEEP_NULLS

CLOCKS = ("event_time", "received_at", "processed_at")


def with_raw_event(valid: DataFrame) -> DataFrame:
    """Rows of the payments table: the payment and its JSON rendering.

    Decimals become JSON strings and instants ISO text, so that nothing is
    rounded on the way.
    """
    as_text = {"amount_major": F.col("amount_major").cast("string")}
    as_text |= {name: iso_utc(F.col(name)) for name in CLOCKS}
    rendered = F.struct(*(as_text.get(n, F.col(n)).alias(n) for n in VALID_COLUMNS))
    return valid.withColumn("raw_event", F.to_json(rendered, KEEP_NULLS)).select(*TABLE_COLUMNS)


def one_row_per_key(batch: DataFrame) -> DataFrame:
    """Reduce a batch to its earliest received row per ``event_id``.

    A key may only be written once per merge. Rows received at the same instant
    are told apart by a hash of their values. The ``_nth = 1`` form lets Spark
    reduce a hot key in the map tasks.
    """
    earliest = Window.partitionBy("event_id").orderBy("received_at", F.xxhash64(*batch.columns))
    return batch.withColumn("_nth", F.row_number().over(earliest)).where("_nth = 1").drop("_nth")


def merge_upsert(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``target`` with every row of ``batch`` inserted or put in place of its key.

    Keys are unique on both sides, so the join has no skew. Spark broadcasts
    the batch's keys when their known size is small and shuffles otherwise.
    """
    kept = target.join(batch.select("event_id"), "event_id", "left_anti")
    return kept.unionByName(batch)
