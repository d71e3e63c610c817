"""Validation rules and derived payment columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.contract import PAYMENT_EVENT_TYPES, SUCCEEDED
from centstream.functions.clock import event_time, parse_iso
from centstream.functions.currency import amount_major

SEPARATOR = "; "

_TYPES = ", ".join(f"'{name}'" for name in PAYMENT_EVENT_TYPES)

# The reason texts. Each with the SQL condition under which it applies, in report order.
# The conditions read the normalised columns made by ``normalise``. ``trim``
# strips blanks only, so a tab is not an empty value.
RULES: tuple[tuple[str, str], ...] = (
    ("missing event_id", "event_id IS NULL OR trim(event_id) = ''"),
    ("missing payment_id", "payment_id IS NULL OR trim(payment_id) = ''"),
    ("missing amount_minor", "amount_minor IS NULL"),
    ("amount_minor must be non-negative", "amount_minor < 0"),
    ("currency must contain three characters", "currency IS NULL OR length(currency) <> 3"),
    ("missing event_type", "event_type IS NULL OR trim(event_type) = ''"),
    ("unsupported event_type", f"event_type NOT IN ({_TYPES})"),
    ("missing payment_status", "payment_status IS NULL OR trim(payment_status) = ''"),
    ("missing provider_created_at", "provider_created_at IS NULL"),
    ("provider_created_at must be non-negative", "provider_created_at < 0"),
    ("missing received_at", "received_at IS NULL"),
    # A negative epoch has its own reason above, so this one is for the far future.
    ("invalid provider_created_at", "provider_created_at >= 0 AND event_time IS NULL"),
    ("invalid received_at", "received_at IS NOT NULL AND received_at_ts IS NULL"),
    ("amount out of range", "amount_minor IS NOT NULL AND amount_major IS NULL"),
    ("missing livemode", "livemode IS NULL"),
)


def rejection_reason(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Every reason that applies, in rule order; empty when none does."""
    return F.concat_ws(SEPARATOR, *(F.when(F.expr(test), reason) for reason, test in rules))


def passes_all(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """True when no rule applies; never null.

    One CASE that stops at the first broken rule: the filter on it builds no
    reason text.
    """
    branches = " ".join(f"WHEN {test} THEN false" for _, test in rules)
    return F.expr(f"CASE {branches} ELSE true END")


def normalise(parsed: DataFrame) -> DataFrame:
    """Clean currency codes and add the typed clocks and the exact amount."""
    clean = parsed.withColumn("currency", F.lower(F.trim("currency")))
    return clean.withColumns(
        {
            "event_time": event_time(F.col("provider_created_at")),
            "received_at_ts": parse_iso(F.col("received_at")),
            "amount_major": amount_major(F.col("amount_minor"), F.col("currency")),
            "is_successful": F.col("event_type") == SUCCEEDED,
        }
    )


def enrich_and_validate(parsed: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Normalised records with ``processed_at``, ``rejection_reason`` and ``is_valid``.

    ``processed_at`` defaults to the clock of the batch; pass a literal to make
    a run repeatable.
    """
    clock = F.current_timestamp() if processed_at is None else processed_at
    return normalise(parsed).select(
        "*",
        clock.alias("processed_at"),
        rejection_reason().alias("rejection_reason"),
        passes_all().alias("is_valid"),
    )


def reject_reason_counts(enriched: DataFrame) -> DataFrame:
    """Number of records per combined reason; the empty reason is the valid ones."""
    return enriched.groupBy("rejection_reason").agg(F.count("*").alias("record_count"))
