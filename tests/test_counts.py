"""Counts over the life of a stream, beyond the progress that Spark keeps."""

import time

import pytest
from pyspark.sql import functions as F

from centstream.operators import route
from centstream.plans.batch import check_records
from centstream.session import new_folder
from centstream.sources.bus import file_stream
from centstream.sources.payments import PaymentsTable
from centstream.streaming import counts, job

from .test_streams import Topic, clock, event

BATCHES = 110


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    return Topic(folder)


@pytest.fixture
def listened(spark):
    root = new_folder(spark, "counts")
    listener = counts.BatchCounts(spark, root)
    spark.streams.addListener(listener)
    yield root
    spark.streams.removeListener(listener)


def settled(spark, root, batches):
    """The counts, once the listener has written so many batches."""
    until = time.time() + 60
    while time.time() < until:
        found = counts.life_counts(spark, root).collect()
        if found and found[0].batches >= batches:
            return found
        time.sleep(0.5)
    raise AssertionError(f"no {batches} batches in {root}")


def test_all_batches_of_a_long_stream_count(spark, topic, listened):
    for number in range(BATCHES):
        late = [event(f"late{number}", 1)] if number % 10 == 9 else []
        topic.put(event(f"k{number}", 20), event("bad", 20, amount_minor=-1), *late)
    checkpoint = new_folder(spark, "cp")

    def go():
        stream = counts.watched(check_records(file_stream(spark, str(topic.folder), 1), clock()))
        valid = route.dedup_within(route.accepted(stream)).writeStream.queryName("long")
        valid = valid.foreachBatch(lambda batch, _: batch.write.format("noop").mode("append").save())
        query = valid.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None

    go()
    found = settled(spark, listened, BATCHES)
    rows = counts.batch_counts(spark, listened).collect()
    late = BATCHES // 10
    assert [(r.input_rows, r.late_rows, r.accepted_rows, r.rejected_rows) for r in found] == [
        (2 * BATCHES + late, late, BATCHES + late, BATCHES)
    ]
    assert len({r.batch_id for r in rows}) == len(rows)
    topic.put(event("more", 20))
    go()  # goes on from the checkpoint and goes on counting
    found = settled(spark, listened, len(rows) + 1)
    assert found[0].input_rows == 2 * BATCHES + late + 1


def test_a_batch_that_is_reported_again_adds_nothing(spark, monkeypatch):
    monkeypatch.setattr(counts, "SEGMENT", 4)
    root = new_folder(spark, "counts")
    listener = counts.BatchCounts(spark, root)
    for number in [*range(10), 3, 9, 0]:
        listener.note("q", number, 5, 1, 3, 1)
    listener.note("other", 0, 1, 0, 1, 0)
    found = {r["query"]: r for r in counts.life_counts(spark, root).collect()}
    assert (found["q"].batches, found["q"].input_rows, found["q"].late_rows) == (10, 50, 10)
    assert found["other"].accepted_rows == 1
    assert counts.life_counts(spark, new_folder(spark, "none")).collect() == []


def test_stored_rows_are_counted_with_the_commit(spark, topic):
    table, checkpoint = PaymentsTable(spark, new_folder(spark, "table")), new_folder(spark, "cp")

    def go():
        records = file_stream(spark, str(topic.folder), 1)
        job.start_valid(records, table, checkpoint, job.DRAIN, processed_at=clock()).awaitTermination()

    topic.put(event("a", 10), event("a", 10), event("b", 10))
    topic.put(event("a", 10), event("c", 10))
    go()
    assert table.state().stored == {job.VALID_QUERY: 3} and table.read().count() == 3
    rows = table.read().withColumn("source", F.lit("stripe"))
    table.upsert(rows, job.VALID_QUERY, 1)  # a replayed batch
    assert table.state().stored == {job.VALID_QUERY: 3}
