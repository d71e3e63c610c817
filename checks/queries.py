"""Every operator as a query over the given tables.

Payment events are derived from the whole ``events`` table. Reports read a
payments table that Spark writes from them once per session and input folder.
"""

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from centstream.contract import BRONZE_DDL, EVENT_COLUMNS, TRACE_COLUMNS
from centstream.functions import currency as money
from centstream.functions.signature import signing_keys
from centstream.operators import ingest, quality, reports, route, upsert, validate
from centstream.operators.offsets import offset_gaps
from centstream.operators.parse import decode_envelope, parse_contract
from centstream.operators.publish import KEEP_NULLS, publish_records
from centstream.plans import batch, fixtures
from centstream.plans.dashboard import dashboard
from centstream.session import new_folder
from centstream.sources.bus import file_stream
from centstream.sources.payments import PaymentsTable
from centstream.streaming import job, live
from centstream.streaming.deliveries import delivery_report, start_deliveries

SECRET = "whsec_fixture_only"
AS_OF = datetime(2024, 1, 30, 12)
FIRST, REPEAT = (0,), (1,)

_tables: dict[tuple[str, str], PaymentsTable] = {}


def clock():
    """Fixed processing clock, so that runs can be compared."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def plain_clocks(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the comparing engine has them."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def bus(spark: SparkSession, sf_dir: str, deliveries=(0, 1)) -> DataFrame:
    return fixtures.bus_records(events(spark, sf_dir), deliveries)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_contract(decode_envelope(bus(spark, sf_dir)))


def checked(spark: SparkSession, sf_dir: str, deliveries=(0, 1)) -> DataFrame:
    return batch.check_records(bus(spark, sf_dir, deliveries), clock())


def payments_of(spark: SparkSession, sf_dir: str, deliveries=(0, 1)) -> DataFrame:
    return batch.payments_of(bus(spark, sf_dir, deliveries), clock())


def table_rows(spark: SparkSession, sf_dir: str, deliveries=(0, 1)) -> DataFrame:
    return upsert.with_raw_event(payments_of(spark, sf_dir, deliveries))


def stored(spark: SparkSession, sf_dir: str) -> PaymentsTable:
    """Payments table of an input folder, written at first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        root = new_folder(spark, "payments")
        _tables[key] = batch.load_table(spark, root, bus(spark, sf_dir), clock())
    return _tables[key]


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir).read()


def keys(spark: SparkSession) -> DataFrame:
    return signing_keys(spark, [SECRET])


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.webhook_deliveries(events(spark, sf_dir), keys(spark))


# Batch operators


def fixture_payments(spark, sf_dir):
    return fixtures.payment_events(events(spark, sf_dir)).select("n", *EVENT_COLUMNS)


def publish(spark, sf_dir):
    return publish_records(fixtures.payment_events(events(spark, sf_dir)))


def envelope_decode(spark, sf_dir):
    return decode_envelope(bus(spark, sf_dir))


def minor_unit_divisor(spark, sf_dir):
    normal = validate.normalise(parsed(spark, sf_dir))
    divisor = money.minor_unit_divisor(F.col("currency")).cast("bigint").alias("divisor")
    return normal.select("kafka_key", "kafka_offset", "currency", divisor)


def _normalised(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        normal = validate.normalise(parsed(spark, sf_dir))
        return normal.select("kafka_key", "kafka_offset", *columns)

    return query


def validate_reasons(spark, sf_dir):
    return checked(spark, sf_dir).select(
        "kafka_key", "kafka_offset", "rejection_reason", "is_valid"
    )


def dedup_first(spark, sf_dir):
    unique = route.dedup_first(route.accepted(checked(spark, sf_dir)))
    return unique.select("event_id", "description", *TRACE_COLUMNS)


def upsert_merge(spark, sf_dir):
    first = table_rows(spark, sf_dir, FIRST)
    return upsert.merge_upsert(first, table_rows(spark, sf_dir, REPEAT))


def table_upsert(spark, sf_dir):
    table = PaymentsTable(spark, new_folder(spark, "upsert"))
    table.upsert(payments_of(spark, sf_dir, FIRST))
    table.upsert(payments_of(spark, sf_dir, REPEAT))
    return table.read()


def table_contract(spark, sf_dir):
    """The contract of unchecked, repeated records, so that some of it is broken."""
    loose = upsert.with_raw_event(route.payment_columns(checked(spark, sf_dir)))
    return quality.table_contract(loose)


# Webhook deliveries


def webhook_signature(spark, sf_dir):
    return ingest.verify_signatures(deliveries(spark, sf_dir), keys(spark))


def _routed(spark, sf_dir):
    return ingest.route_deliveries(webhook_signature(spark, sf_dir))


def webhook_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("body", "arrived_at", "route")


def webhook_map(spark, sf_dir):
    return ingest.map_events(_routed(spark, sf_dir))


def _ingested(spark, sf_dir):
    return ingest.ingest(deliveries(spark, sf_dir), keys(spark))


def webhook_outcomes(spark, sf_dir):
    return ingest.ingest_outcomes(_ingested(spark, sf_dir))


def webhook_publish(spark, sf_dir):
    return publish_records(ingest.published_events(_ingested(spark, sf_dir)))


def stream_ingest(spark, sf_dir):
    """Deliveries arriving as a stream, up to the records that would be published."""
    folder, out = new_folder(spark, "bronze"), new_folder(spark, "published")
    _deliver(spark, folder, deliveries(spark, sf_dir))
    bronze = spark.readStream.schema(BRONZE_DDL).parquet(folder)
    ready = publish_records(ingest.published_events(ingest.ingest(bronze, keys(spark))))
    _drain(_to_files(ready, out, new_folder(spark, "checkpoint")))
    return spark.read.parquet(out)


def stream_deliveries(spark, sf_dir):
    """Outcomes counted batch by batch while deliveries are published, over two runs."""
    folder, out = new_folder(spark, "bronze"), new_folder(spark, "published")
    reports, checkpoint = new_folder(spark, "reports"), new_folder(spark, "checkpoint")
    name = _query_name()
    # Events are dealt before they are signed, so each is built and signed for its own run only.
    nth = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for run in (0, 1):
        dealt = events(spark, sf_dir).where(nth == run)
        _deliver(spark, folder, fixtures.webhook_deliveries(dealt, keys(spark)))
        bronze = spark.readStream.schema(BRONZE_DDL).parquet(folder)

        def publish(ready):
            publish_records(ready).write.mode("append").parquet(out)

        _drain(
            start_deliveries(bronze, keys(spark), publish, checkpoint, reports, job.DRAIN, name)
        )
    return delivery_report(spark, reports).select("ingest_status", "delivery_count")


def contract_check(spark, sf_dir):
    """Every seventh event carries a field that the contract does not know."""
    typed = fixtures.payment_events(events(spark, sf_dir))
    plain = F.to_json(F.struct(*EVENT_COLUMNS), KEEP_NULLS)
    wider = F.to_json(F.struct(*EVENT_COLUMNS, F.lit("web").alias("channel")), KEEP_NULLS)
    value = F.when(F.col("n") % 7 == 3, wider).otherwise(plain)
    extra = ingest.unexpected_fields(value)
    return ingest.contract_check(typed, extra).select("n", "contract_violation")


# Reports


def _report(make: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(payments(spark, sf_dir))


def _from_totals(make: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(stored(spark, sf_dir).totals())


def success_rate(rows: DataFrame) -> DataFrame:
    rated = reports.with_success_rate(reports.summary_by_currency(rows))
    return rated.select("currency", "success_rate")


def format_money(rows: DataFrame) -> DataFrame:
    amount = money.format_money(F.col("amount_major"), F.col("currency")).alias("amount")
    return rows.select("event_id", "currency", amount)


def recent_payments(spark, sf_dir):
    return stored(spark, sf_dir).recent("gbp")


def recent_display(spark, sf_dir):
    return reports.recent_display(recent_payments(spark, sf_dir), "gbp")


def dashboard_bundle(spark, sf_dir):
    """The four dashboard reports stacked into one."""
    shown = dashboard(stored(spark, sf_dir), "gbp", AS_OF)

    def section(name, df, label, count, amount):
        return df.select(
            F.lit(name).alias("section"),
            label.alias("label"),
            count.cast("bigint").alias("event_count"),
            amount.cast("decimal(38,3)").alias("amount"),
        )

    hour = F.date_format("hour", "yyyy-MM-dd HH:mm:ss")
    nothing = F.lit(None)
    parts = [
        section(
            "summary",
            shown.summary,
            F.lit("gbp"),
            F.col("total_events"),
            F.col("successful_amount"),
        ),
        section("status", shown.status, F.col("payment_status"), F.col("event_count"), nothing),
        section("hour", shown.hourly, hour, F.col("event_count"), F.col("successful_amount")),
        section("recent", shown.recent, F.col("payment_id"), nothing, F.col("amount_major")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


# Streams. Records lie in a folder of their own; a second delivery goes to the same
# folder after the first run, and the query goes on from its checkpoint.


def _query_name() -> str:
    """A name of its own, as one may run at a time under each."""
    return f"check-{uuid.uuid4().hex}"


def _drain(query) -> None:
    query.awaitTermination()


def _deliver(spark, folder: str, records: DataFrame) -> None:
    records.write.mode("append").parquet(folder)


def _two_runs(spark, first: DataFrame, then: DataFrame, start) -> None:
    folder = new_folder(spark, "bus")
    checkpoint = new_folder(spark, "checkpoint")
    for records in (first, then):
        _deliver(spark, folder, records)
        _drain(start(file_stream(spark, folder), checkpoint))


def _first_then_repeats(spark, sf_dir, start) -> None:
    _two_runs(spark, bus(spark, sf_dir, FIRST), bus(spark, sf_dir, REPEAT), start)


def _to_files(stream: DataFrame, path: str, checkpoint: str):
    writer = stream.writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**job.DRAIN).start()


def stream_source(spark, sf_dir):
    out = new_folder(spark, "decoded")
    _first_then_repeats(
        spark,
        sf_dir,
        lambda records, checkpoint: _to_files(decode_envelope(records), out, checkpoint),
    )
    return spark.read.parquet(out)


def stream_valid(spark, sf_dir):
    out = new_folder(spark, "valid")
    _first_then_repeats(
        spark,
        sf_dir,
        lambda records, checkpoint: _to_files(
            route.valid_records(batch.check_records(records, clock())), out, checkpoint
        ),
    )
    return spark.read.parquet(out)


def stream_dedup(spark, sf_dir):
    """Both deliveries in one micro-batch, over many partitions; all columns of the winner."""
    folder, name = new_folder(spark, "bus"), _query_name()
    table = PaymentsTable(spark, new_folder(spark, "payments"))
    _deliver(spark, folder, bus(spark, sf_dir).repartition(16))
    records, checkpoint = file_stream(spark, folder), new_folder(spark, "checkpoint")
    _drain(job.start_valid(records, table, checkpoint, job.DRAIN, processed_at=clock(), name=name))
    return table.read()


def _delayed(records: DataFrame, delayed: bool) -> DataFrame:
    late = F.col("key").cast("string").cast("bigint") % 40 == 17
    return records.where(late if delayed else ~late)


def stream_late(spark, sf_dir):
    """One in forty events arrives after all others; per day, what became of them."""
    out = new_folder(spark, "admitted")
    first = bus(spark, sf_dir, FIRST)
    _two_runs(
        spark,
        _delayed(first, False),
        _delayed(first, True),
        lambda records, checkpoint: _to_files(
            route.valid_records(batch.check_records(records, clock())), out, checkpoint
        ),
    )
    admitted = spark.read.parquet(out).select("event_id", F.lit(True).alias("admitted"))
    accepted = route.accepted(checked(spark, sf_dir, FIRST))
    delayed = F.col("kafka_key").cast("bigint") % 40 == 17
    fate = accepted.select("event_id", "event_time", delayed.alias("delayed"))
    fate = fate.join(admitted, "event_id", "left")
    in_time = F.col("admitted").isNotNull()
    return fate.groupBy(F.to_date("event_time").alias("event_day")).agg(
        F.count_if(~F.col("delayed") & in_time).alias("on_time"),
        F.count_if(F.col("delayed") & in_time).alias("late_admitted"),
        F.count_if(~in_time).alias("late_dropped"),
    )


def stream_late_safe(spark, sf_dir):
    """Delayed events and repeats reach the table; a repeat overwrites."""
    name = _query_name()
    table = PaymentsTable(spark, new_folder(spark, "payments"))
    first = bus(spark, sf_dir, FIRST)
    _two_runs(
        spark,
        _delayed(first, False),
        _delayed(first, True).unionByName(bus(spark, sf_dir, REPEAT)),
        lambda records, checkpoint: job.start_valid_late_safe(
            records, table, checkpoint, job.DRAIN, clock(), name=name
        ),
    )
    return table.read()


def stream_upsert(spark, sf_dir):
    name = _query_name()
    table = PaymentsTable(spark, new_folder(spark, "payments"))
    _first_then_repeats(
        spark,
        sf_dir,
        lambda records, checkpoint: job.start_valid(
            records, table, checkpoint, job.DRAIN, processed_at=clock(), name=name
        ),
    )
    return table.read()


def stream_rejected(spark, sf_dir):
    name = _query_name()
    out = new_folder(spark, "rejected")
    _first_then_repeats(
        spark,
        sf_dir,
        lambda records, checkpoint: job.start_rejected(
            records, out, checkpoint, job.DRAIN, clock(), name=name
        ),
    )
    return job.read_rejected(spark, out)


def stream_fanout(spark, sf_dir):
    """Both sinks at work on one source; rows that reached each."""
    folder, rejects = new_folder(spark, "bus"), new_folder(spark, "rejected")
    table = PaymentsTable(spark, new_folder(spark, "payments"))
    _deliver(spark, folder, bus(spark, sf_dir))
    records = file_stream(spark, folder)
    running = [
        job.start_valid(
            records,
            table,
            new_folder(spark, "checkpoint"),
            job.DRAIN,
            processed_at=clock(),
            name=_query_name(),
        ),
        job.start_rejected(
            records,
            rejects,
            new_folder(spark, "checkpoint"),
            job.DRAIN,
            clock(),
            name=_query_name(),
        ),
    ]
    for query in running:
        _drain(query)

    def counted(name, df):
        rows = df.agg(F.count("*").alias("row_count"))
        return rows.select(F.lit(name).alias("sink"), "row_count")

    return counted("payments", table.read()).unionByName(
        counted("rejected", job.read_rejected(spark, rejects))
    )


def _live(width: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        out = new_folder(spark, "live")
        _first_then_repeats(
            spark,
            sf_dir,
            lambda records, checkpoint: live.start_live(
                live.live_activity(batch.check_records(records, clock()), width),
                out,
                checkpoint,
                job.DRAIN,
            ),
        )
        return live.read_live(spark, out)

    return query


def _windows(hours: int) -> Callable[[SparkSession, str], DataFrame]:
    """Windows kept by the upserts of a stream with delayed events and overwriting repeats."""

    def query(spark, sf_dir):
        name = _query_name()
        table = PaymentsTable(spark, new_folder(spark, "payments"))
        first = bus(spark, sf_dir, FIRST)
        _two_runs(
            spark,
            _delayed(first, False),
            _delayed(first, True).unionByName(bus(spark, sf_dir, REPEAT)),
            lambda records, checkpoint: job.start_valid_late_safe(
                records, table, checkpoint, job.DRAIN, clock(), name=name
            ),
        )
        return reports.windows(table.rollup(), hours)

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fixture_payments": fixture_payments,
    "publish_records": publish,
    "envelope_decode": envelope_decode,
    "offset_gaps": lambda s, d: offset_gaps(bus(s, d)),
    "parse_contract": parsed,
    "minor_unit_divisor": minor_unit_divisor,
    "amount_major": _normalised("amount_minor", "currency", "amount_major"),
    "event_time": _normalised("provider_created_at", "event_time"),
    "received_at": _normalised("received_at", "received_at_ts"),
    "validate_reasons": validate_reasons,
    "reject_reason_counts": lambda s, d: validate.reject_reason_counts(checked(s, d)),
    "dedup_first": dedup_first,
    "valid_records": lambda s, d: route.valid_records(checked(s, d)),
    "rejected_records": lambda s, d: route.rejected_records(checked(s, d)),
    "raw_event_json": lambda s, d: table_rows(s, d).select("event_id", "raw_event"),
    "upsert_merge": upsert_merge,
    "table_upsert": table_upsert,
    "table_contract": table_contract,
    "quality_metrics": lambda s, d: quality.quality_metrics(checked(s, d)),
    "webhook_signature": webhook_signature,
    "webhook_route": webhook_route,
    "webhook_map": webhook_map,
    "webhook_outcomes": webhook_outcomes,
    "webhook_publish": webhook_publish,
    "contract_check": contract_check,
    "currencies": _from_totals(reports.currencies),
    "default_currency": _from_totals(lambda rows: reports.default_currency(rows, "GBP")),
    "summary": _from_totals(lambda rows: reports.summary(rows, "gbp")),
    "summary_by_currency": _from_totals(reports.summary_by_currency),
    "success_rate": _from_totals(success_rate),
    "summary_display": _from_totals(
        lambda rows: reports.summary_display(reports.summary_by_currency(rows))
    ),
    "status_breakdown": _from_totals(lambda rows: reports.status_breakdown(rows, "gbp")),
    "hourly_activity": _report(lambda rows: reports.hourly_activity(rows, "gbp", AS_OF)),
    "daily_summary": _from_totals(reports.daily_summary),
    "recent_payments": recent_payments,
    "recent_display": recent_display,
    "format_money": _report(format_money),
    "dashboard_bundle": dashboard_bundle,
    "stream_ingest": stream_ingest,
    "stream_deliveries": stream_deliveries,
    "stream_source": stream_source,
    "stream_valid": stream_valid,
    "stream_dedup": stream_dedup,
    "stream_late": stream_late,
    "stream_late_safe": stream_late_safe,
    "stream_upsert": stream_upsert,
    "stream_rejected": stream_rejected,
    "stream_fanout": stream_fanout,
    "stream_hourly": _live("1 hour"),
    "stream_daily": _live("1 day"),
    "stream_windows_hourly": _windows(1),
    "stream_windows_daily": _windows(24),
}


def prepare(spark: SparkSession) -> None:
    """UTC clocks; and on one machine, no more state partitions than it has cores.

    A partition count that was set, and that of a cluster, is left alone.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    context, count = spark.sparkContext, "spark.sql.shuffle.partitions"
    if context.master.startswith("local") and spark.conf.get(count) == "200":
        spark.conf.set(count, str(context.defaultParallelism))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def comparable(query):
        def run(spark, sf_dir):
            prepare(spark)
            return plain_clocks(query(spark, sf_dir))

        return run

    return {name: comparable(query) for name, query in QUERIES.items()}
