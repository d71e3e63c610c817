"""The payments table in a relational database.

Executors load a staging table in parallel; one statement then moves it into the
payments table, so a batch appears whole or not at all.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from centstream.contract import TABLE_COLUMNS
from centstream.operators.quality import NOT_NEGATIVE, NOT_NULL
from centstream.operators.reports import (
    DEFAULT_RECENT,
    MAX_RECENT,
    RECENT_COLUMNS,
    recent_limit,
)
from centstream.operators.upsert import one_row_per_key, with_raw_event

JSON_COLUMN = "raw_event"

#: Column types of the payments table in the database; the rest are TEXT.
COLUMN_TYPES = {
    "amount_minor": "BIGINT",
    "amount_major": "DECIMAL(18,3)",
    "currency": "VARCHAR(3)",
    "livemode": "BOOLEAN",
    "is_successful": "BOOLEAN",
    "event_time": "TIMESTAMPTZ",
    "received_at": "TIMESTAMPTZ",
    "processed_at": "TIMESTAMPTZ",
}
#: What the database puts where a writer gives nothing.
DEFAULTS = {"livemode": "FALSE", "processed_at": "now()"}
#: Columns that the reports and payment lookups filter by, an index each.
INDEXED = (
    ("event_time",),
    ("currency", "event_time"),
    ("currency", "payment_status"),
    ("payment_id",),
)
ROLLUP_TYPES = "event_count BIGINT, successful_count BIGINT, successful_amount DECIMAL(38,3)"
SUMS = (
    "count(*) AS event_count, "
    "count(CASE WHEN is_successful THEN 1 END) AS successful_count, "
    "coalesce(sum(CASE WHEN is_successful THEN amount_major END), 0) AS successful_amount"
)


def table_statements(table: str = "payments", json_type: str = "JSONB") -> list[str]:
    """DDL of the payments table: the key that merges need, its checks and its indexes."""
    types = COLUMN_TYPES | {JSON_COLUMN: json_type}
    columns = []
    for name in TABLE_COLUMNS:
        rules = " PRIMARY KEY" if name == "event_id" else " NOT NULL" if name in NOT_NULL else ""
        rules += f" CHECK ({name} >= 0)" if name in NOT_NEGATIVE else ""
        rules += f" DEFAULT {DEFAULTS[name]}" if name in DEFAULTS else ""
        columns.append(f"{name} {types.get(name, 'TEXT')}{rules}")
    made = [f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"]
    for names in INDEXED:
        index = f"{table}_by_{'_'.join(names)}"
        made.append(f"CREATE INDEX IF NOT EXISTS {index} ON {table} ({', '.join(names)})")
    return made


def merge_statement(
    table: str, staging: str, json_type: str | None = "JSONB", first_wins: str | None = None
) -> str:
    """``INSERT ... ON CONFLICT`` that overwrites every column but the key.

    With ``first_wins``, an interval, the stored row stays unless the new one's event
    time is that much later.

    DISTINCT, because a staging task that is run again after its commit leaves
    exact copies behind, and a key may be touched only once per statement.
    """
    names = ", ".join(TABLE_COLUMNS)
    values = ", ".join(
        f"CAST({name} AS {json_type})" if name == JSON_COLUMN and json_type else name
        for name in TABLE_COLUMNS
    )
    updates = ", ".join(f"{name} = EXCLUDED.{name}" for name in TABLE_COLUMNS if name != "event_id")
    return (
        f"INSERT INTO {table} ({names}) "
        f"SELECT {values} FROM (SELECT DISTINCT {names} FROM {staging}) AS staged "
        f"ON CONFLICT (event_id) DO UPDATE SET {updates}"
        + (
            f" WHERE EXCLUDED.event_time >= {table}.event_time + INTERVAL '{first_wins}'"
            if first_wins
            else ""
        )
    )


def _text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


def rollup_statement(table: str, unit: str = "hour") -> str:
    """Sums per UTC hour or day, currency and status; the database groups, so few rows leave it."""
    when = f"date_trunc('{unit}', event_time AT TIME ZONE 'UTC')"
    return (
        f"SELECT {when} AS {unit}_start, currency, payment_status, {SUMS} "
        f"FROM {table} GROUP BY {when}, currency, payment_status"
    )


def hourly_statement(table: str, currency: str, as_of: datetime | None = None) -> str:
    """Events and successful amount per hour of the 24 hours before a UTC instant."""
    when = "date_trunc('hour', event_time AT TIME ZONE 'UTC')"
    end = "now()" if as_of is None else f"CAST('{as_of.isoformat(' ')}+00:00' AS TIMESTAMPTZ)"
    return (
        f"SELECT {when} AS hour, {SUMS} FROM {table} WHERE currency = {_text(currency)} "
        f"AND event_time >= {end} - INTERVAL '24 hours' GROUP BY {when}"
    )


def recent_statement(table: str, currency: str, limit: int) -> str:
    """Latest payments of a currency; the index on currency and time ends the search early."""
    return (
        f"SELECT {', '.join(RECENT_COLUMNS)}, event_id FROM {table} "
        f"WHERE currency = {_text(currency)} ORDER BY event_time DESC, event_id LIMIT {limit:d}"
    )


def bounds_statement(table: str) -> str:
    return f"SELECT min(event_time) AS first_at, max(event_time) AS last_at FROM {table}"


def range_options(first: datetime | None, last: datetime | None, tasks: int) -> dict[str, str]:
    """Read options that deal the rows to tasks by ranges of event time; none for no rows."""
    if first is None or last is None:
        return {}
    bounds = {"lowerBound": str(first), "upperBound": str(last), "numPartitions": str(tasks)}
    return {"partitionColumn": "event_time", **bounds}


class JdbcPayments:
    """Takes upserts and gives reports like the file table, so either can serve the job."""

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        user: str,
        password: str,
        table: str = "payments",
        staging: str = "payments_staging",
        connections: int = 16,
        connect_seconds: int = 10,
    ):
        self.spark = spark
        self.table = table
        self.staging = staging
        self.connections = connections
        self.connect_seconds = connect_seconds
        self._login = {"url": url, "user": user, "password": password}

    def read(self, **options: str) -> DataFrame:
        """The table; filters and column choice are pushed to the database.

        It is read over ``connections`` connections by ranges of event time, whose
        first and last come from the index. ``partitionColumn`` and its like replace that.
        """
        if "partitionColumn" not in options:
            ends = self.spark.read.format("jdbc").options(**self._login)
            first, last = ends.option("query", bounds_statement(self.table)).load().first()
            options = range_options(first, last, self.connections) | options
        reader = self.spark.read.format("jdbc").options(**self._login, dbtable=self.table)
        return reader.options(**options).load()

    def pinned(self) -> "JdbcPayments":
        """The table itself; it has no versions."""
        return self

    def _asked(self, statement: str) -> DataFrame:
        """Result of a statement that the database runs."""
        return self.spark.read.format("jdbc").options(**self._login, query=statement).load()

    def _sums(self, rows: DataFrame, *keys: Column) -> DataFrame:
        sums = (name.split() for name in ROLLUP_TYPES.split(", "))  # no space within a type
        return rows.select(*keys, *(F.col(name).cast(kind).alias(name) for name, kind in sums))

    def rollup(self) -> DataFrame:
        """Sums per hour, currency and status, made by the database."""
        rows = self._asked(rollup_statement(self.table))
        hour = F.col("hour_start").cast("timestamp").alias("hour")
        return self._sums(rows, hour, F.col("currency"), F.col("payment_status"))

    def totals(self) -> DataFrame:
        """Day totals, made by the database."""
        rows = self._asked(rollup_statement(self.table, "day"))
        day = F.col("day_start").cast("date").alias("event_day")
        return self._sums(rows, day, F.col("currency"), F.col("payment_status"))

    def hourly(self, currency: str, as_of: datetime | None = None) -> DataFrame:
        """The hourly activity report, grouped by the database."""
        rows = self._asked(hourly_statement(self.table, currency, as_of))
        made = self._sums(rows, F.col("hour").cast("timestamp").alias("hour"))
        return made.drop("successful_count").orderBy("hour")

    def recent(
        self, currency: str, limit: int = DEFAULT_RECENT, ceiling: int = MAX_RECENT
    ) -> DataFrame:
        """Latest payments of a currency, chosen by the database."""
        wanted = recent_limit(limit, ceiling)
        rows = self._asked(recent_statement(self.table, currency, wanted))
        return rows.orderBy(F.desc("event_time"), "event_id").select(*RECENT_COLUMNS)

    def create(self) -> None:
        """Make the payments table and its indexes where they are missing."""
        self._execute(*table_statements(self.table))

    def upsert(
        self,
        batch: DataFrame,
        stream: str = "default",
        batch_id: int | None = None,
        key_scope: str = "table",
        unique: bool = False,
        first_wins: str | None = None,
    ) -> None:
        """Load a batch of valid payments and merge it in one transaction.

        Merging a batch again leaves the same rows, so a replay needs no check.
        """
        rows = with_raw_event(batch if unique else one_row_per_key(batch))
        writer = rows.write.format("jdbc").options(**self._login, dbtable=self.staging)
        # No more tasks than this write at a time, however large the cluster is.
        writer = writer.options(numPartitions=str(self.connections), batchsize="1000")
        writer.option("truncate", "true").mode("overwrite").save()
        self._execute(merge_statement(self.table, self.staging, first_wins=first_wins))

    def _execute(self, *statements: str) -> None:
        """Run statements in one transaction."""
        manager = self.spark.sparkContext._jvm.java.sql.DriverManager
        manager.setLoginTimeout(self.connect_seconds)
        connection = manager.getConnection(*self._login.values())
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().executeUpdate(statement)
            connection.commit()
        finally:
            connection.close()
