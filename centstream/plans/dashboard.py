"""All reports of one currency from one version of the table."""

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.operators.reports import (
    DEFAULT_RECENT,
    of_currency,
    status_totals,
    summary_of_totals,
    with_success_rate,
)
from centstream.sources.jdbc import JdbcPayments
from centstream.sources.payments import PaymentsTable


class Dashboard(NamedTuple):
    summary: DataFrame
    status: DataFrame
    hourly: DataFrame
    recent: DataFrame
    totals: DataFrame

    def release(self) -> None:
        """Drop the kept status totals once the reports have been read."""
        self.totals.unpersist()


def dashboard(
    table: PaymentsTable | JdbcPayments,
    currency: str,
    as_of: datetime | None = None,
    limit: int = DEFAULT_RECENT,
) -> Dashboard:
    """The four reports, agreeing with each other because they read one version.

    The headline and the status counts are added up from the table's day totals;
    the other two reports read recent days only. A database answers each report itself;
    its table has no versions, so there each report sees the moment it is read.
    """
    table = table.pinned()
    totals = status_totals(of_currency(table.totals(), currency)).persist()
    status = totals.select("payment_status", "event_count")
    return Dashboard(
        summary=with_success_rate(summary_of_totals(totals)),
        status=status.orderBy(F.desc("event_count"), "payment_status"),
        hourly=table.hourly(currency, as_of),
        recent=table.recent(currency, limit),
        totals=totals,
    )
