"""Connected components of a graph too large for one machine."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.llm.store import stored

EDGE = "u long, v long"
#: Edges that a task joins up at a time.
RUN = 1 << 20


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition as (node, least node reached within the partition)."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = parent[up]
            node = parent[node]
        return node

    def flush() -> pa.RecordBatch:
        nodes = [n for n in parent if root(n) != n]
        made = [pa.array(nodes, pa.int64()), pa.array(map(root, nodes), pa.int64())]
        parent.clear()
        return pa.RecordBatch.from_arrays(made, ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > RUN:
            yield flush()
    if parent:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the least node reached.

    ``edges`` has long columns ``u`` and ``v``; order, repeats and loops don't matter.
    Each round shrinks what every task holds to stars, then hangs every node's
    neighbours on the least of them (alternately the larger and the smaller ones), until
    nothing moves. Hubs are safe: minima are combined in the map tasks, and joins on a
    hub can be split. Each round is a written table.
    """
    now = edges.filter("u <> v").mapInArrow(stars, EDGE)
    now = stored(now.distinct(), "edges")
    while True:
        # Each node's neighbours on the larger side move to its least neighbour ...
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.w).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "large")
        # ... and those on the smaller side, the node itself too.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("w"), "m")
        small = large.join(least, large.u == least.w).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        small = stored(small.filter("u <> v").distinct(), "small")
        # Done if every node hangs on one root that hangs on nothing.
        chained = small.select(F.col("v").alias("u")).distinct().join(small, "u", "left_semi")
        if chained.isEmpty() and small.groupBy("u").count().filter("count > 1").isEmpty():
            roots = small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
        now = stored(small.mapInArrow(stars, EDGE).distinct(), "edges")
