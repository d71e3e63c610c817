"""Streams over files: one file per micro-batch, or all that is there."""

import json
import os
from datetime import UTC, datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from centstream.operators import route
from centstream.plans.batch import check_records
from centstream.session import new_folder
from centstream.settings import JobSettings
from centstream.sources.bus import file_batch, file_stream
from centstream.sources.payments import PaymentsTable
from centstream.streaming import job, live

from .test_validation import GOOD

SCHEMA = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
        ("timestampType", pa.int32()),
    ]
)


class Topic:
    """A folder of bus files that arrive in the order they are put."""

    def __init__(self, folder: Path):
        self.folder = folder
        self.files = 0
        self.offset = 0

    def put(self, *events):
        rows = []
        for event in events:
            value = event if isinstance(event, str) else json.dumps(event)
            stamp = datetime(2024, 1, 1, tzinfo=UTC).timestamp() + self.offset
            rows.append(
                {
                    "key": b"k",
                    "value": value.encode(),
                    "topic": "t",
                    "partition": 0,
                    "offset": self.offset,
                    "timestamp": datetime.fromtimestamp(stamp, UTC),
                    "timestampType": 0,
                }
            )
            self.offset += 1
        path = self.folder / f"{self.files:04d}.parquet"
        pq.write_table(pa.Table.from_pylist(rows, schema=SCHEMA), path)
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1


def at(day, hour=0):
    return int(datetime(2024, 1, day, hour, tzinfo=UTC).timestamp())


def event(key, day, hour=0, **more):
    return GOOD | {"event_id": key, "provider_created_at": at(day, hour)} | more


CLOCK = "2024-02-01"


def clock():
    return F.lit(CLOCK).cast("timestamp")


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    return Topic(folder)


@pytest.fixture
def table(spark):
    return PaymentsTable(spark, new_folder(spark, "table"))


def records(spark, topic, per_batch=1):
    return file_stream(spark, str(topic.folder), per_batch)


def drain(query):
    query.awaitTermination()
    return query


def per_batch(spark, stream):
    """Run a stream file by file; the ids that came out of each batch that had any."""
    out = {}

    def keep(batch, batch_id):
        out[batch_id] = sorted(row.event_id for row in batch.select("event_id").collect())

    writer = stream.writeStream.foreachBatch(keep).trigger(availableNow=True)
    query = writer.option("checkpointLocation", new_folder(spark, "cp")).start()
    return out, drain(query)


def lay_out(topic):
    topic.put(event("a", 10), event("a", 10), event("b", 10, 1))
    topic.put(event("c", 15))
    topic.put(event("a", 16), event("old_new", 1), event("d", 16))
    topic.put(event("b", 16, 2))
    topic.put(event("e", 16, 3))


@pytest.mark.parametrize("salts", [0, 8])
def test_duplicates_late_rows_and_state_eviction(spark, topic, salts):
    lay_out(topic)
    enriched = check_records(records(spark, topic), clock())
    valid = route.valid_records(enriched, hot_key_salts=salts)
    out, query = per_batch(spark, valid)
    # b comes back: its state was evicted, which keeps the state bounded.
    batches = [ids for _, ids in sorted(out.items()) if ids]
    assert batches == [["a", "b"], ["c"], ["d"], ["b"], ["e"]]
    counts = job.progress_counts(query)
    assert counts["dropped_as_late"] >= 1
    # c, d, b and e; the earlier a and b are gone. The spreading step also holds
    # these, and the later copy of a that the second step dropped.
    assert counts["state_rows"] == (4 if salts == 0 else 4 + 5)


@pytest.mark.parametrize("salts", [0, 8])
def test_hot_key_in_one_batch_comes_out_once(spark, topic, salts):
    topic.put(*(event("hot", 10) for _ in range(200)), event("b", 10))
    valid = route.valid_records(check_records(records(spark, topic), clock()), hot_key_salts=salts)
    out, _ = per_batch(spark, valid)
    assert sorted(sum(out.values(), [])) == ["b", "hot"]


def test_a_bad_record_does_not_stop_the_stream(spark, topic, table):
    topic.put(event("a", 10), event("bad", 10, received_at="not-a-time"), "{cut")
    topic.put(event("huge", 10, amount_minor=9 * 10**18, currency="jpy"), event("b", 10))
    drain(
        job.start_valid(
            records(spark, topic), table, new_folder(spark, "cp"), job.DRAIN, processed_at=clock()
        )
    )
    assert sorted(r.event_id for r in table.read().collect()) == ["a", "b"]


def test_restart_goes_on_from_the_checkpoint(spark, topic, table):
    checkpoint = new_folder(spark, "cp")

    def go():
        return drain(
            job.start_valid(
                records(spark, topic), table, checkpoint, job.DRAIN, processed_at=clock()
            )
        )

    topic.put(event("a", 10, description="first"))
    go()
    topic.put(event("a", 10, description="again"), event("b", 10))
    counts = job.progress_counts(go())
    stored = {r.event_id: r.description for r in table.read().collect()}
    assert stored == {"a": "first", "b": GOOD["description"]}
    assert counts["input_rows"] == 2
    version = table.state().version
    go()
    assert table.state().version in (version, version + 1)
    assert table.read().count() == 2


def test_lost_commit_is_replayed_without_effect(spark, topic, table):
    """The batch reached the table, but the stream did not get to note that."""
    checkpoint = Path(new_folder(spark, "cp"))

    def go():
        bus = records(spark, topic)
        drain(job.start_valid_late_safe(bus, table, str(checkpoint), job.DRAIN, clock()))

    topic.put(event("a", 10))
    go()
    before = table.state()
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    go()
    assert table.state().days == before.days
    assert table.read().count() == 1


def test_late_safe_stream_keeps_late_rows_and_overwrites(spark, topic, table):
    lay_out(topic)
    topic.put(event("c", 15, description="again"))
    bus = records(spark, topic)
    drain(job.start_valid_late_safe(bus, table, new_folder(spark, "cp"), job.DRAIN, clock()))
    stored = {r.event_id: r for r in table.read().collect()}
    assert sorted(stored) == ["a", "b", "c", "d", "e", "old_new"]
    assert stored["c"].description == "again"
    assert stored["a"].event_time.day == 16


def test_stream_equals_batch_when_nothing_is_late(spark, topic, table):
    topic.put(event("a", 10), event("b", 10, 2), event("a", 10))
    topic.put(event("c", 10, 3), event("b", 10, 2, description="again"))
    bus = records(spark, topic)
    drain(
        job.start_valid(bus, table, new_folder(spark, "cp"), job.DRAIN, processed_at=clock())
    )
    whole = check_records(file_batch(spark, str(topic.folder)), clock())
    expected = route.valid_records(whole).select("event_id", "description").collect()
    got = table.read().select("event_id", "description").collect()
    assert sorted(got) == sorted(expected)


def test_tidying_keeps_the_table_whole(spark, topic, table):
    for number in range(12):
        topic.put(event(f"k{number}", 10))
    bus = records(spark, topic)
    checkpoint = new_folder(spark, "cp")
    drain(job.start_valid(bus, table, checkpoint, job.DRAIN, processed_at=clock(), tidy_every=10))
    assert table.read().count() == 12
    assert len(table.state().pieces()) < 12


def put_copies(topic, backwards):
    """Copies of one key in unlike files, in or against the order of their offsets."""
    folder = topic.folder
    for number in range(4):
        topic.put(*(event("hot", 10, description=f"{number}-{k}") for k in range(3)), event(f"k{number}", 10))
    if backwards:
        for number, path in enumerate(sorted(folder.glob("*.parquet"), reverse=True)):
            os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.mark.parametrize("backwards", [False, True])
def test_first_arrival_wins_whatever_the_partitions(spark, topic, table, backwards):
    put_copies(topic, backwards)
    bus = records(spark, topic, per_batch=100).repartition(7)
    drain(job.start_valid(bus, table, new_folder(spark, "cp"), job.DRAIN, processed_at=clock()))
    whole = route.valid_records(check_records(file_batch(spark, str(topic.folder)), clock()))
    want = sorted(whole.select(*table.read().columns[:10]).collect())
    assert sorted(table.read().select(*table.read().columns[:10]).collect()) == want
    assert {r.event_id: r.description for r in whole.collect()}["hot"] == "0-0"


def test_stored_row_stays_until_the_delay_has_passed(spark, topic, table):
    topic.put(event("a", 10, description="first"), event("b", 10, description="first"))
    topic.put(event("a", 10, 23, description="within"), event("c", 3), event("b", 11, description="later"))
    topic.put(event("b", 11, 5, description="within"), event("a", 10, description="again"))
    bus = records(spark, topic)
    drain(job.start_valid(bus, table, new_folder(spark, "cp"), job.DRAIN, processed_at=clock()))
    assert {r.event_id: r.description for r in table.read().collect()} == {
        "a": "first",
        "b": "later",
        "c": GOOD["description"],
    }


def test_files_of_a_micro_batch_follow_its_data(spark, topic, table):
    days = [event(f"{day}-{k}", day) for day in range(1, 31) for k in range(20)]
    topic.put(*days)
    bus = records(spark, topic).repartition(16)
    drain(job.start_valid(bus, table, new_folder(spark, "cp"), job.DRAIN, processed_at=clock()))
    assert len(table.read().inputFiles()) == 30
    assert table.read().count() == 600


@pytest.mark.parametrize("late_safe", [False, True])
def test_job_runs_both_sinks_from_its_settings(spark, topic, late_safe):
    root = new_folder(spark, "job")
    settings = JobSettings(
        kafka_servers="none",
        topic="none",
        table_path=f"{root}/payments",
        rejected_path=f"{root}/rejected",
        checkpoint_root=f"{root}/checkpoints",
        late_safe=late_safe,
    )
    topic.put(event("a", 20), event("", 20))
    topic.put(event("a", 20))
    topic.put(event("late", 1), event("a", 20))
    for query in job.start_job(spark, settings, records(spark, topic), job.DRAIN):
        drain(query)
    stored = {r.event_id for r in PaymentsTable(spark, settings.table_path).read().collect()}
    assert stored == {"a", "late"}
    assert job.read_rejected(spark, settings.rejected_path).count() == 1


def test_rejects_are_filed_by_date_with_their_trace(spark, topic):
    path = new_folder(spark, "rejected")
    checkpoint = new_folder(spark, "cp")
    topic.put(event("a", 10), "{cut", event("", 10))
    drain(job.start_rejected(records(spark, topic), path, checkpoint, job.DRAIN, clock()))
    topic.put(event("b", 10, livemode=None))
    drain(job.start_rejected(records(spark, topic), path, checkpoint, job.DRAIN, clock()))
    rejected = job.read_rejected(spark, path).orderBy("kafka_offset")
    assert [(r.kafka_offset, r.rejection_reason.split("; ")[-1]) for r in rejected.collect()] == [
        (1, "missing livemode"),
        (2, "missing event_id"),
        (3, "missing livemode"),
    ]
    assert (Path(path) / f"rejection_date={CLOCK}").is_dir()
    assert rejected.first().raw_value == "{cut"


def test_live_view_is_folded_and_stays_right(spark, topic):
    out = new_folder(spark, "live")
    for number in range(7):
        topic.put(event(f"k{number}", 10, number % 2), event(f"m{number}", 10, 5))
    activity = live.live_activity(check_records(records(spark, topic), clock()), "1 hour")
    query = live.start_live(activity, out, new_folder(spark, "cp"), job.DRAIN, fold_every=2)
    drain(query)
    shown = {r.window_start.hour: r.event_count for r in live.read_live(spark, out).collect()}
    assert shown == {0: 4, 1: 3, 5: 7}
    assert len(list(Path(out).glob("updates/batch_id=*"))) < 7
    assert len(list(Path(out).glob("folded/upto=*"))) <= 2


def test_live_view_shows_open_windows(spark, topic):
    out = new_folder(spark, "live")
    topic.put(event("a", 10, 1), event("b", 10, 1, event_type="payment_intent.canceled"))
    topic.put(event("c", 10, 1), event("a", 10, 1), event("d", 10, 2))
    activity = live.live_activity(check_records(records(spark, topic), clock()), "1 hour")
    drain(live.start_live(activity, out, new_folder(spark, "cp"), job.DRAIN))
    shown = live.read_live(spark, out).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.event_count, r.successful_count) for r in shown] == [
        (1, 3, 2),
        (2, 1, 1),
    ]
    assert str(shown[0].successful_amount) == "159.980"
