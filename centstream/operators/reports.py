"""Report queries over the payments table.

Each takes the payments DataFrame and returns one. Those that only count and add up take
its day totals as well (``day_totals``), of which there is one row per day, currency and
status instead of one per payment. Amounts of different currencies are never added up.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.functions.currency import (
    format_count,
    format_money,
    format_percent,
    success_rate,
)

#: Rows that the recent-payments report gives at most, unless a ceiling is passed in.
MAX_RECENT = 100
DEFAULT_RECENT = 25
RECENT_COLUMNS = [
    "event_time",
    "event_type",
    "payment_id",
    "payment_status",
    "amount_major",
    "description",
    "is_successful",
]


def of_currency(payments: DataFrame, currency: str) -> DataFrame:
    return payments.where(F.col("currency") == currency)


def _figures(rows: DataFrame) -> tuple[Column, Column, Column]:
    """Events, successes and successful amount of payments or of their totals."""
    if "event_count" in rows.columns:
        sums = (F.sum(name) for name in ("event_count", "successful_count", "successful_amount"))
    else:
        amount = F.when(F.col("is_successful"), F.col("amount_major"))
        sums = (F.count("*"), F.count_if("is_successful"), F.sum(amount))
    events, successes, total = (F.coalesce(each, F.lit(0)) for each in sums)
    return events, successes, total.cast("decimal(38,3)")


def _totals(rows: DataFrame) -> list[Column]:
    events, successes, amount = _figures(rows)
    return [
        events.alias("event_count"),
        successes.alias("successful_count"),
        amount.alias("successful_amount"),
    ]


def _mean(total: Column, count: Column) -> Column:
    """Exact decimal mean; 0 when nothing was counted."""
    mean = F.try_divide(total, count.cast("decimal(20,0)"))
    return F.coalesce(mean, F.lit(0)).cast("decimal(38,6)")


def _headline(rows: DataFrame) -> list[Column]:
    events, successes, amount = _figures(rows)
    return [
        events.alias("total_events"),
        successes.alias("successful_events"),
        (events - successes).alias("unsuccessful_events"),
        amount.alias("successful_amount"),
        _mean(amount, successes).alias("average_successful_amount"),
    ]


def day_totals(payments: DataFrame, *more: str) -> DataFrame:
    """Counts and successful amount per UTC day, currency and status, and per ``more`` columns."""
    known = "event_day" in payments.columns
    day = F.col("event_day") if known else F.to_date("event_time").alias("event_day")
    return payments.groupBy(*more, day, "currency", "payment_status").agg(*_totals(payments))


def changes_of(rows: DataFrame) -> DataFrame:
    """Hourly sums of payments with a ``sign``: 1 for those that came, -1 for those that went."""
    success = F.when(F.col("is_successful"), F.col("sign")).otherwise(0)
    amount = F.when(F.col("is_successful"), F.col("amount_major") * F.col("sign"))
    hour = F.date_trunc("hour", "event_time").alias("hour")
    return rows.groupBy(hour, "currency", "payment_status").agg(
        F.sum("sign").cast("bigint").alias("event_count"),
        F.sum(success).cast("bigint").alias("successful_count"),
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,3)").alias("successful_amount"),
    )


def summed(changes: DataFrame, when: Column) -> DataFrame:
    """Changes added up per ``when``, currency and status."""
    return changes.groupBy(when, "currency", "payment_status").agg(*_totals(changes))


def windows(rollup: DataFrame, hours: int = 1) -> DataFrame:
    """Events, successes and their amount per window of so many whole hours and currency.

    ``rollup`` is that of a table, so the windows agree with the table whatever came late
    or was overwritten.
    """
    start = F.window("hour", f"{hours} hours")["start"].alias("window_start")
    return rollup.groupBy(start, "currency").agg(*_totals(rollup))


def currencies(payments: DataFrame) -> DataFrame:
    """Currencies present, in order."""
    return payments.select("currency").distinct().orderBy("currency")


def default_currency(payments: DataFrame, preferred: str) -> DataFrame:
    """The preferred currency if present, else the first in order."""
    code = preferred.lower()
    ordered = payments.select("currency").distinct().orderBy(F.col("currency") != code, "currency")
    return ordered.limit(1)


def summary(payments: DataFrame, currency: str) -> DataFrame:
    """Headline totals of one currency: one row, also when it has no payments."""
    return of_currency(payments, currency).agg(*_headline(payments))


def summary_by_currency(payments: DataFrame) -> DataFrame:
    """Headline totals of every currency in one pass."""
    return payments.groupBy("currency").agg(*_headline(payments))


def with_success_rate(totals: DataFrame) -> DataFrame:
    """Headline totals with ``success_rate`` in percent."""
    rate = success_rate(F.col("successful_events"), F.col("total_events"))
    return totals.withColumn("success_rate", rate)


def summary_display(totals: DataFrame) -> DataFrame:
    """Headline totals by currency as display text."""
    rated = with_success_rate(totals)
    return rated.select(
        "currency",
        format_count(F.col("total_events")).alias("total_events"),
        format_count(F.col("successful_events")).alias("successful"),
        format_count(F.col("unsuccessful_events")).alias("other_states"),
        format_percent(F.col("success_rate")).alias("success_rate"),
        format_money(F.col("successful_amount"), F.col("currency")).alias("successful_amount"),
    )


def status_breakdown(payments: DataFrame, currency: str) -> DataFrame:
    """Events per payment status, most frequent first."""
    counts = (
        of_currency(payments, currency)
        .groupBy("payment_status")
        .agg(_figures(payments)[0].alias("event_count"))
    )
    return counts.orderBy(F.desc("event_count"), "payment_status")


def status_totals(payments: DataFrame) -> DataFrame:
    """Counts and successful amount per status, from which a headline can be added up."""
    return payments.groupBy("payment_status").agg(*_totals(payments))


def summary_of_totals(totals: DataFrame) -> DataFrame:
    """The headline of one currency from its status totals."""
    return totals.agg(*_headline(totals))


def hourly_activity(payments: DataFrame, currency: str, as_of: datetime | None = None) -> DataFrame:
    """Events and successful amount per hour of the 24 hours before ``as_of``.

    ``as_of`` is a UTC instant, now by default. Where the table has its day
    column the bound is put on it too, so that older days are not read.
    """
    end = F.current_timestamp() if as_of is None else F.lit(as_of)
    start = end - F.expr("INTERVAL 24 HOURS")
    recent = of_currency(payments, currency).where(F.col("event_time") >= start)
    if "event_day" in payments.columns:
        recent = recent.where(F.col("event_day") >= F.to_date(start))
    hour = F.date_trunc("hour", "event_time").alias("hour")
    events, _, amount = _totals(recent)
    return recent.groupBy(hour).agg(events, amount).orderBy("hour")


def daily_summary(payments: DataFrame) -> DataFrame:
    """Events, successes and successful amount per UTC day and currency."""
    summed = "event_time" not in payments.columns
    day = F.col("event_day").cast("timestamp") if summed else F.date_trunc("day", "event_time")
    return payments.groupBy(day.alias("payment_day"), "currency").agg(*_totals(payments))


def register_daily_summary(payments: DataFrame, name: str = "payment_daily_summary") -> None:
    """Make the daily summary available to SQL under ``name``."""
    daily_summary(payments).createOrReplaceTempView(name)


def recent_limit(requested: int, ceiling: int = MAX_RECENT) -> int:
    """Row count of the recent-payments report, at least 1; more than ``ceiling`` is refused."""
    if requested > ceiling:
        raise ValueError(f"{requested} recent payments are asked for; the ceiling is {ceiling}")
    return max(requested, 1)


def recent_payments(
    payments: DataFrame, currency: str, limit: int = DEFAULT_RECENT, ceiling: int = MAX_RECENT
) -> DataFrame:
    """Latest payments of one currency; ties on time go by ``event_id``."""
    newest = of_currency(payments, currency).orderBy(F.desc("event_time"), "event_id")
    return newest.limit(recent_limit(limit, ceiling)).select(*RECENT_COLUMNS)


def recent_display(recent: DataFrame, currency: str) -> DataFrame:
    """Recent payments with the amount as display text."""
    shown = recent.withColumn("amount", format_money(F.col("amount_major"), F.lit(currency)))
    return shown.drop("amount_major")
