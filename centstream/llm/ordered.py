"""Running sums over rows in a global order, without a task that holds a whole key.

Rows are dealt by range of (key, order) and sorted in their partitions, so a key with very
many rows lies in several neighbouring partitions. Each partition sums on its own; what a
key brings along from the partitions before is worked out from one row per partition and
added afterwards.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.llm.store import stored


def in_order(rows: DataFrame, key: str, order: Iterable[str], dealt: Iterable[str]) -> DataFrame:
    """``rows`` dealt by range of ``dealt``, sorted by ``order``, with the partition as ``part``."""
    spread = rows.repartitionByRange(key, *dealt).sortWithinPartitions(key, *order)
    return spread.withColumn("part", F.spark_partition_id())


def carried(ends: Iterable[tuple], start, join: Callable) -> dict[int, tuple]:
    """What the first key of each partition brings along.

    ``ends`` has (part, first key, last key, state of the last key in the partition), one
    row per partition. The result has part: (key, state) where there is something.
    """
    out, before = {}, None
    for part, first, last, state in sorted(ends):
        if before and before[0] == first:
            out[part] = before
        inside = out[part][1] if part in out and first == last else start
        before = (last, join(inside, state))
    return out


def running_sums(rows: DataFrame, key: str, order: list[str], values: list[str], label: str) -> DataFrame:
    """``rows`` with ``<value>_before``: the sum of earlier rows of the same key.

    ``key`` is a long without nulls; values are longs of at least zero. Equal rows may come
    in any order.
    """
    names = [*rows.columns, "part"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, totals = None, dict.fromkeys(values, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(names.index(key)).to_numpy()
            heads = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            segment = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(keys))))
            made = []
            for value in values:
                own = batch.column(names.index(value)).to_numpy()
                upto = np.cumsum(own) - own
                upto = upto - upto[heads][segment]
                if keys[0] == last:
                    upto[segment == 0] += totals[value]
                totals[value] = int(upto[-1] + own[-1])
                made.append(pa.array(upto))
            last = keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*names, *(f"{v}_before" for v in values)])

    spread = in_order(rows, key, order, order)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spread.schema.fields)
    kinds += "".join(f", {v}_before long" for v in values)
    local = stored(spread.mapInArrow(add, kinds), label)
    ends = local.groupBy("part").agg(
        F.min(key), F.max(F.struct(key, *(F.col(v) + F.col(f"{v}_before") for v in values)))
    )
    found = carried(
        ((part, first, end[0], tuple(end[1:])) for part, first, end in ends.collect()),  # one row per partition
        (0,) * len(values),
        lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True)),
    )
    if not found:
        return local.drop("part")
    brought = rows.sparkSession.createDataFrame(
        [(part, k, *state) for part, (k, state) in found.items()],
        "_part int, _key long" + "".join(f", _{v} long" for v in values),
    )
    same = (F.col("part") == F.col("_part")) & (F.col(key) == F.col("_key"))
    joined = local.join(F.broadcast(brought), same, "left")  # at most one row per partition
    def total(v: str) -> Column:
        return (F.col(f"{v}_before") + F.coalesce(f"_{v}", F.lit(0))).alias(f"{v}_before")

    return joined.select(*rows.columns, *(total(v) for v in values))
