"""Intermediate tables, written to the shared folder so that lost executors cost no rerun."""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.session import new_folder
from centstream.sources.files import Folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once under ``spark.checkpoint.dir`` and read back."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove stored tables that nothing will read again."""
    for table in tables:
        files = table.inputFiles()
        if files:
            Folder(table.sparkSession, files[0].rpartition("/")[0]).delete("")


def packed(names: Iterable[str]) -> Column:
    """Columns of any name as the one column ``kept``, so that none clashes with others."""
    quoted = (name.replace("`", "``") for name in names)
    return F.struct(*(F.col(f"`{name}`") for name in quoted)).alias("kept")


def through(
    docs: DataFrame, change: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``docs`` with its batches passed through ``change``; columns may have any name."""
    names, places = docs.columns, [f"c{i}" for i in range(len(docs.columns))]

    def renamed(batches):
        for batch in change(batches):
            yield batch.rename_columns(names)

    return docs.toDF(*places).mapInArrow(renamed, docs.schema)
