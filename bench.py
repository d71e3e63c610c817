"""Time the headline queries; prints one JSON line.

Inputs are the bus records, webhook deliveries and payments table derived from
``$BENCH_SF_DIR`` and written to files first, outside the timing. Each figure is
the median of ``$BENCH_RUNS`` runs after one that warms up.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame

from centstream.operators import ingest, quality, reports, route, validate
from centstream.operators.publish import publish_records
from centstream.plans import batch
from centstream.plans.dashboard import dashboard
from centstream.session import build_session, new_folder
from centstream.sources.bus import file_batch, file_stream
from centstream.sources.payments import PaymentsTable
from centstream.streaming import job, live
from checks import queries as registered

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def consume(frame: DataFrame) -> None:
    """Run a query to its end without keeping the rows."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    conf = {"spark.master": f"local[{CPUS}]", "spark.ui.enabled": "false"}
    spark = build_session("bench", int(CPUS), conf)
    spark.sparkContext.setLogLevel("ERROR")
    clock = registered.clock()

    def saved(label: str, frame: DataFrame) -> str:
        folder = new_folder(spark, label)
        frame.repartition(int(CPUS)).write.parquet(folder)
        return folder

    first = saved("bus-first", registered.bus(spark, SF_DIR, registered.FIRST))
    repeats = saved("bus-repeats", registered.bus(spark, SF_DIR, registered.REPEAT))
    everything = saved("bus-all", registered.bus(spark, SF_DIR))
    bronze = saved("bronze", registered.deliveries(spark, SF_DIR))
    keys = registered.keys(spark)
    table = batch.load_table(spark, new_folder(spark, "payments"), file_batch(spark, first), clock)
    input_rows = file_batch(spark, everything).count()

    def checked() -> DataFrame:
        return batch.check_records(file_batch(spark, everything), clock)

    def load() -> None:
        root = new_folder(spark, "payments")
        batch.load_table(spark, root, file_batch(spark, first), clock)

    def overwrite() -> None:
        table.upsert(batch.payments_of(file_batch(spark, repeats), clock))

    def stream_valid() -> None:
        target = PaymentsTable(spark, new_folder(spark, "payments"))
        checkpoint = new_folder(spark, "checkpoint")
        records = file_stream(spark, everything)
        job.start_valid(
            records, target, checkpoint, job.DRAIN, processed_at=clock
        ).awaitTermination()

    def stream_rejected() -> None:
        out, checkpoint = new_folder(spark, "rejected"), new_folder(spark, "checkpoint")
        records = file_stream(spark, everything)
        job.start_rejected(records, out, checkpoint, job.DRAIN, clock).awaitTermination()

    def stream_hourly() -> None:
        out, checkpoint = new_folder(spark, "live"), new_folder(spark, "checkpoint")
        enriched = batch.check_records(file_stream(spark, everything), clock)
        activity = live.live_activity(enriched, "1 hour")
        live.start_live(activity, out, checkpoint, job.DRAIN).awaitTermination()

    def published() -> DataFrame:
        done = ingest.ingest(spark.read.parquet(bronze), keys)
        return publish_records(ingest.published_events(done))

    def all_reports() -> None:
        shown = dashboard(table, "gbp", registered.AS_OF)
        for report in (shown.summary, shown.status, shown.hourly, shown.recent):
            consume(report)
        shown.release()

    def report(make) -> object:
        return lambda: consume(make(table.read()))

    def added_up(make) -> object:
        return lambda: consume(make(table.totals()))

    timed = {
        "webhook_publish": lambda: consume(published()),
        "valid_records": lambda: consume(route.valid_records(checked())),
        "rejected_records": lambda: consume(route.rejected_records(checked())),
        "reject_reason_counts": lambda: consume(validate.reject_reason_counts(checked())),
        "quality_metrics": lambda: consume(quality.quality_metrics(checked())),
        "table_load": load,
        "table_overwrite": overwrite,
        "currencies": added_up(reports.currencies),
        "summary": added_up(lambda rows: reports.summary(rows, "gbp")),
        "summary_by_currency": added_up(reports.summary_by_currency),
        "status_breakdown": added_up(lambda rows: reports.status_breakdown(rows, "gbp")),
        "hourly_activity": report(
            lambda rows: reports.hourly_activity(rows, "gbp", registered.AS_OF)
        ),
        "daily_summary": added_up(reports.daily_summary),
        "recent_payments": lambda: consume(table.recent("gbp")),
        "dashboard": all_reports,
        "stream_valid": stream_valid,
        "stream_rejected": stream_rejected,
        "stream_hourly": stream_hourly,
    }
    seconds = {}
    for name, run in timed.items():
        laps = []
        for lap in range(RUNS + 1):
            began = time.perf_counter()
            run()
            if lap:
                laps.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(laps), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    result = {
        "metric": "payment_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
        "bus_records": input_rows,
        "stream_records_per_sec": round(input_rows / seconds["stream_valid"]),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
