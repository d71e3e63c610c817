"""Refused records on files: bytes decide on files, repeats overwrite, old dates are joined."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from centstream.contract import REJECT_COLUMNS
from centstream.operators.route import rejected_records
from centstream.session import new_folder
from centstream.streaming.rejects import JOINED, RejectedFiles, read_rejected
from checks.queries import checked


@pytest.fixture
def refused(spark, sf_dir):
    return rejected_records(checked(spark, sf_dir))


def files_of(spark, path, query="0a1b2c3d-0000"):
    checkpoint = Path(new_folder(spark, "cp"))
    checkpoint.mkdir(parents=True)
    (checkpoint / "metadata").write_text(json.dumps({"id": query}))
    return RejectedFiles(spark, path, str(checkpoint))


def dated(rows, date):
    return rows.withColumn("rejection_date", F.lit(date).cast("date"))


def same(spark, path, wanted):
    found = read_rejected(spark, path).select(REJECT_COLUMNS)
    return sorted(map(str, found.collect())) == sorted(map(str, wanted.select(REJECT_COLUMNS).collect()))


def folders(path, date):
    return sorted(p.name for p in Path(path, f"rejection_date={date}").glob("batch=*"))


def test_many_small_tasks_write_one_file_and_a_repeat_the_same_rows(spark, refused):
    path = new_folder(spark, "rejected")
    files = files_of(spark, path)
    for _ in range(2):
        files.write(refused.repartition(40), 0)
        assert same(spark, path, refused)
        assert len(list(Path(path).rglob("part-*.json"))) == 1


def test_large_batches_are_split_by_bytes(spark, refused):
    path, advisory = new_folder(spark, "rejected"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "64k")
    try:
        many = refused.crossJoin(spark.range(200)).drop("id")
        files_of(spark, path).write(many.repartition(16), 0)
    finally:
        spark.conf.unset(advisory)
    assert len(list(Path(path).rglob("part-*.json"))) > 2
    assert read_rejected(spark, path).count() == 200 * refused.count()


def test_dates_that_are_over_are_joined(spark, refused):
    path = new_folder(spark, "rejected")
    files = files_of(spark, path)
    old, new = dated(refused, "2024-02-01"), dated(refused, "2024-02-02")
    wanted = old.unionAll(old).unionAll(old).unionAll(new)
    for number in range(3):
        files.write(old, number)
    files.write(new, 3)
    files.join_dates(2)  # batch 2 may be repeated
    assert folders(path, "2024-02-01") == [
        "batch=0a1b2c3d-000000000002", "batch=0a1b2c3d-000000000002-before",
    ]
    files.write(old, 2)
    assert same(spark, path, wanted)
    files.join_dates(4)
    files.join_dates(5)
    assert folders(path, "2024-02-01") == ["batch=0a1b2c3d-000000000004-before"]
    assert folders(path, "2024-02-02") == ["batch=0a1b2c3d-000000000003"]
    assert same(spark, path, wanted)


@pytest.mark.parametrize("whole", [True, False])
def test_a_join_cut_short_is_mended(spark, refused, whole, monkeypatch):
    path = new_folder(spark, "rejected")
    files = files_of(spark, path)
    old = dated(refused, "2024-02-01")
    for number in range(2):
        files.write(old, number)
    files.write(dated(refused, "2024-02-02"), 2)
    monkeypatch.setattr(files, "_put_in_place", lambda draft: None)
    files.join_dates(3)
    monkeypatch.undo()
    wanted = old.unionAll(old).unionAll(dated(refused, "2024-02-02"))
    assert same(spark, path, wanted)  # drafts are not seen
    (draft,) = Path(path, JOINED).iterdir()
    if whole:
        files._files.delete("rejection_date=2024-02-01/batch=0a1b2c3d-000000000000")
    else:
        (draft / "_SUCCESS").unlink()
    files.join_dates(4)
    assert same(spark, path, wanted)
    assert len(folders(path, "2024-02-01")) == 1


def test_another_checkpoint_keeps_what_is_there(spark, refused):
    path = new_folder(spark, "rejected")
    for query in ("aaaa0000-1", "bbbb0000-1"):
        files_of(spark, path, query).write(refused, 0)
    assert same(spark, path, refused.unionAll(refused))


def test_folder_of_the_older_sink_is_refused(spark):
    path = Path(new_folder(spark, "rejected"))
    (path / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="another kind of sink"):
        files_of(spark, str(path))
