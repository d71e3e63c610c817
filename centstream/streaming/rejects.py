"""Refused records as JSON files: ``rejection_date=<date>/batch=<query>-<number>/``.

A micro-batch writes folders of its own and overwrites them when it is repeated, so its
rows are there once. Files follow the bytes, not the tasks. When a date is over, its
folders are joined into one.
"""

import json
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centstream.contract import REJECT_DDL
from centstream.sources.files import Folder

# The default of the JSON writer would cut instants to milliseconds.
JSON_CLOCK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: Joined dates lie here until they take the place of their batches; readers pass it over.
JOINED = "_joined"


class RejectedFiles:
    """Refused records of one stream below ``path``; ``checkpoint`` is the stream's."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._files, self._checkpoint = Folder(spark, path), Folder(spark, checkpoint)
        if self._files.exists("_spark_metadata"):
            raise ValueError(f"{path} holds the log of another kind of sink; use a new folder")

    def write(self, rejected: DataFrame, batch_id: int) -> None:
        """The rows of a micro-batch, in place of those of an earlier try."""
        rows = rejected.withColumn("batch", F.lit(self._name(batch_id)))
        _json(rows.hint("rebalance", F.col("rejection_date"))).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("rejection_date", "batch").save(self._path)

    def join_dates(self, batch_id: int) -> None:
        """Join each date but the latest. Batches from ``batch_id`` on may yet be repeated.

        The joined files are written whole before the batches' folders go; a join that
        was cut short is finished, or thrown away if it was not written whole, by the
        next. For a moment a date that is over can't be seen.
        """
        for name in self._files.children(JOINED):
            self._put_in_place(name)
        for date in self._files.children("", "rejection_date=")[:-1]:
            names = self._covered(date, batch_id)
            if len(names) > 1:
                rows = _read(self._spark, self._path).where(
                    (F.col("rejection_date") == F.lit(date).cast("date"))
                    & F.col("batch").isin(names)
                )
                draft = f"{date}={self._name(batch_id)}"
                rows = rows.drop("rejection_date", "batch").hint("rebalance")
                _json(rows).mode("overwrite").save(f"{self._path}/{JOINED}/{draft}")
                self._put_in_place(draft)

    def _put_in_place(self, draft: str) -> None:
        date, end = draft.split("=")
        if self._files.exists(f"{JOINED}/{draft}/_SUCCESS"):
            for name in self._covered(date, int(end.split("-")[1])):
                self._files.delete(f"rejection_date={date}/batch={name}")
            self._files.move(f"{JOINED}/{draft}", f"rejection_date={date}/batch={end}-before")
        else:
            self._files.delete(f"{JOINED}/{draft}")

    def _covered(self, date: str, batch_id: int) -> list[str]:
        """Folders of a date that this stream wrote before ``batch_id``.

        The folder joined before a batch sorts behind that batch's own, and so it is only
        covered by later ones.
        """
        own, end = f"{self._query}-", self._name(batch_id)
        names = self._files.children(f"rejection_date={date}", "batch=")
        return [name for name in names if name.startswith(own) and name < end]

    def _name(self, batch_id: int) -> str:
        """A new checkpoint counts batches from nought again, so the query's id is part."""
        return f"{self._query}-{batch_id:012d}"

    @cached_property
    def _query(self) -> str:
        """Start of the query's id, which Spark keeps in the checkpoint from the first start."""
        return json.loads(self._checkpoint.read_text("metadata"))["id"].split("-")[0]


def _json(rows: DataFrame):
    return rows.write.format("json").option("timestampFormat", JSON_CLOCK)


def _read(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(REJECT_DDL).option("timestampFormat", JSON_CLOCK)
    return reader.option("basePath", path).json(path)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Refused records written so far; a filter on the date prunes folders."""
    return _read(spark, path).drop("batch")
