"""Split checked records into payments and rejects; drop repeated deliveries."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centstream.contract import ARRIVAL_ORDER, REJECT_COLUMNS, VALID_COLUMNS

WATERMARK = "1 day"

# State partitions over which a stream spreads the copies of one key; 0: none. Spreading
# can let a later copy of the same minute win, so it is off unless asked for.
HOT_KEY_SALTS = 0


def accepted(enriched: DataFrame) -> DataFrame:
    return enriched.where("is_valid")


def dedup_first(records: DataFrame) -> DataFrame:
    """First arrival of every ``event_id``, for a batch.

    Spark keeps one row per key in each map task before it shuffles (a partial
    WindowGroupLimit), so the copies of a hot key never meet in one task.
    """
    arrival = Window.partitionBy("event_id").orderBy(*ARRIVAL_ORDER)
    return (
        records.withColumn("_nth", F.row_number().over(arrival)).where("_nth = 1").drop("_nth")
    )


def dedup_within(
    records: DataFrame, delay: str = WATERMARK, hot_key_salts: int = HOT_KEY_SALTS
) -> DataFrame:
    """First arrival of every ``event_id`` within the watermark, for a stream.

    State for a key is dropped once the watermark has passed it, so it does not
    grow without end; a copy that comes later still is let through and absorbed
    by the upsert.

    A single id may fill a large part of a micro-batch. With ``hot_key_salts``,
    copies that arrive in the same minute are first spread over so many state
    partitions, each of which lets one through, and only those meet in one place.
    This costs a second shuffle, and which copy of a minute wins is then open; use
    it only for feeds whose copies are equal.
    """
    marked = records.withWatermark("event_time", delay)
    if hot_key_salts > 1:
        marked = marked.select(
            "*",
            F.date_trunc("minute", "kafka_timestamp").alias("_minute"),
            F.pmod(F.col("kafka_offset"), F.lit(hot_key_salts)).alias("_salt"),
        )
        marked = marked.dropDuplicatesWithinWatermark(["event_id", "_minute", "_salt"])
        marked = marked.drop("_minute", "_salt")
    return marked.dropDuplicatesWithinWatermark(["event_id"])


def payment_columns(records: DataFrame) -> DataFrame:
    """The columns of a payment, with the parsed arrival time in place of its text."""
    return records.withColumn("received_at", F.col("received_at_ts")).select(*VALID_COLUMNS)


def valid_records(
    enriched: DataFrame, delay: str = WATERMARK, hot_key_salts: int = HOT_KEY_SALTS
) -> DataFrame:
    """Accepted payments, each ``event_id`` once."""
    passed = accepted(enriched)
    if enriched.isStreaming:
        return payment_columns(dedup_within(passed, delay, hot_key_salts))
    return payment_columns(dedup_first(passed))


def rejected_records(enriched: DataFrame) -> DataFrame:
    """Refused records with their reason and where they came from. Not deduplicated."""
    refused = enriched.where(~F.col("is_valid"))
    return refused.withColumn("rejection_date", F.to_date("processed_at")).select(*REJECT_COLUMNS)
