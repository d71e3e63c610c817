"""Checks and counts over whole tables."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# What the payments table promises, besides its primary key.
NOT_NULL = (
    "payment_id",
    "event_type",
    "amount_minor",
    "amount_major",
    "currency",
    "payment_status",
    "livemode",
    "is_successful",
    "event_time",
    "received_at",
    "processed_at",
    "raw_event",
)
NOT_NEGATIVE = ("amount_minor", "amount_major")
PRIMARY_KEY = "event_id PRIMARY KEY"


def _row_constraints() -> dict[str, Column]:
    broken = {f"{name} NOT NULL": F.col(name).isNull() for name in NOT_NULL}
    broken |= {f"{name} >= 0": F.col(name) < 0 for name in NOT_NEGATIVE}
    broken["currency VARCHAR(3)"] = F.length("currency") > 3
    return broken


def table_contract(payments: DataFrame) -> DataFrame:
    """Violations per table constraint: one row each, zero when it holds.

    The payments are read once: the map tasks count copies and broken rules per key,
    and only keys with their counts are shuffled, however many rows a key has.
    A null key and each key that occurs more than once is a violation.
    """
    rules = _row_constraints()
    by_key = payments.groupBy("event_id").agg(
        F.count("*").alias("copies"),
        *(F.count_if(test).alias(name) for name, test in rules.items()),
    )
    repeated = (F.col("copies") > 1) | F.col("event_id").isNull()
    counted = by_key.agg(
        F.count_if(repeated).alias(PRIMARY_KEY),
        *(F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in rules),
    )
    return counted.unpivot([], [PRIMARY_KEY, *rules], "constraint_name", "violations")


def quality_metrics(enriched: DataFrame) -> DataFrame:
    """Row counts of one run: read, accepted, refused, and stored once per key."""
    accepted_id = F.when(F.col("is_valid"), F.col("event_id"))
    return enriched.agg(
        F.count("*").alias("input_rows"),
        F.count_if("is_valid").alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("rejected_rows"),
        F.count_distinct(accepted_id).alias("stored_rows"),
    )


def observed(records: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows and key bytes as they pass, without another pass.

    Read the counts after the action.
    """
    watch = Observation(name)
    key_bytes = F.sum(F.octet_length("event_id")).alias("key_bytes")
    return records.observe(watch, F.count("*").alias("rows"), key_bytes), watch
