"""Events to keyed bus records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.contract import EVENT_COLUMNS

KEEP_NULLS = {"ignoreNullFields": "false"}


def publish_records(events: DataFrame) -> DataFrame:
    """Key and value text of each event; the key keeps one id on one partition."""
    return events.select(
        F.col("event_id").alias("key"),
        F.to_json(F.struct(*EVENT_COLUMNS), KEEP_NULLS).alias("value"),
    )
