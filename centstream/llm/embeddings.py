"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors are brought to length 1 and turned by a fixed random rotation, then cut into
blocks of about ``BLOCK`` dimensions. Cosine >= c means squared distance <= 2 - 2c; if
two vectors are that near, then in some block their squared distance is within the
block's share of it, in proportion to its dimensions. Each block is range-joined under
its share: the block's first coordinate is cut into strips, vectors near the upper border
of a strip are also put into the next, and a strip's rows are swept in the order of that
coordinate. What is near enough in the block is verified with the original vectors in
double precision. A linked pair is counted in the one block where its share is least
used, and in the strip of its upper vector, so the union holds it once.

Equal vectors are one class with a count and are never paired with themselves. Strips
with over ``TILE`` rows are dealt into chunks that meet in pairs, so no task holds more
than two chunks. A task returns link counts and a spanning set of edges, not the pairs.

Null, empty and zero vectors and those with null or non-finite components link with
nothing, and neither do vectors of unlike length. Rows without a ``vec_id`` belong to a
component but never name one. Repeated rows count as vectors of their own.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.llm.components import components
from centstream.llm.store import stored

COSINE = 0.95
BLOCK = 16
#: Width of a strip in block radii.
STRIP = 3.0
#: Rows of a strip that are swept at once, and of one step of the sweep.
TILE = 16_000
STEP = 256
#: Pairs that are verified at once.
PART = 1 << 15
SEED = 20240501
#: Slack for rounding in the rotated coordinates; verification is exact.
SLACK = 1e-4

def rotation(size: int) -> np.ndarray:
    """Fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def blocks_of(size: int) -> list[slice]:
    edges = np.linspace(0, size, max(1, size // BLOCK) + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def turned(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors; a row's result does not depend on the other rows."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    return np.einsum("ij,kj->ik", unit, rotation(vectors.shape[1]))


def _shares(size: int, cosine: float) -> np.ndarray:
    return np.array([(b.stop - b.start) / size for b in blocks_of(size)]) * (2 - 2 * cosine)


def classes_of(rows: DataFrame) -> DataFrame:
    """(node, embedding, n, first_id) of each distinct usable vector."""
    sums = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double")))
    # Null and not-a-number make the sum null or not a number.
    usable = (F.size("embedding") > 0) & (sums > 0) & (sums < F.lit(float("inf")))
    grouped = rows.filter(usable & ~F.isnan(sums)).groupBy("node", "embedding")
    return grouped.agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))


def _placed(classes: DataFrame, cosine: float) -> DataFrame:
    """Each class in every block, in its own tile and those whose border it is near."""

    def place(batches):
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2).to_pylist()], np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(own))
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False)
                vectors = flat.astype(float).reshape(-1, size)
                yield from _place(part, vectors, cosine)

    placed = classes.select("node", "n", "embedding").mapInArrow(
        place, "node long, n long, vec binary, size int, block int, tile long, home boolean"
    )
    return stored(placed, "tiles")


def _place(part: pa.RecordBatch, vectors: np.ndarray, cosine: float):
    x, size = turned(vectors), vectors.shape[1]
    shares = _shares(size, cosine) * (1 + SLACK)
    data = pa.array([v.tobytes() for v in vectors], pa.binary())
    for b, (block, share) in enumerate(zip(blocks_of(size), shares, strict=True)):
        radius = float(np.sqrt(share))
        along = x[:, block.start]
        home = np.floor(along / (STRIP * radius)).astype(np.int64)
        upper = np.floor((along + radius) / (STRIP * radius)).astype(np.int64)
        again = np.flatnonzero(upper > home)
        rows = pa.array(np.append(np.arange(len(home)), again))
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0).take(rows), part.column(1).take(rows), data.take(rows),
                pa.array(np.full(n, size, np.int32)), pa.array(np.full(n, b, np.int32)),
                pa.array(np.append(home, upper[again])), pa.array(np.arange(n) < len(home)),
            ],
            ["node", "n", "vec", "size", "block", "tile", "home"],
        )


def _dealt(placed: DataFrame) -> DataFrame:
    """Rows of strips, those of large strips once for each pair of chunks they meet in."""
    strip = ["size", "block", "tile"]
    sizes = placed.groupBy(*strip).agg(F.count("*").alias("rows"))
    sizes = sizes.select(*strip, F.ceil(F.col("rows") / TILE).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("node", "block"), F.col("chunks")).cast("int")
    rows = placed.join(sizes, strip).withColumn("chunk", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select(
        "node", "n", "vec", *strip, "home", "chunk",
        F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
    )


def _swept(table: pa.Table, cosine: float):
    """Pairs (i, j) of row numbers of a strip that are linked and belong to it."""
    size, at_block = table.column("size")[0].as_py(), table.column("block")[0].as_py()
    vectors = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64)
    vectors = vectors.reshape(table.num_rows, size)
    home = table.column("home").to_numpy()
    chunk = table.column("chunk").to_numpy()
    across = table.column("a")[0].as_py() != table.column("b")[0].as_py()

    x = turned(vectors)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    cuts, shares = blocks_of(size), _shares(size, cosine)
    limit = shares[at_block] * (1 + SLACK) + 1e-6
    order = np.argsort(x[:, cuts[at_block].start], kind="stable")
    near = x[order][:, cuts[at_block]]
    along = near[:, 0]
    half = (near * near).sum(axis=1, keepdims=True) / 2
    # left . right = x . y - |x|^2/2 - |y|^2/2, minus half the squared distance
    one = np.ones_like(half)
    left = np.concatenate([near, -half, one], axis=1).astype(np.float32)
    right = np.concatenate([near, one, -half], axis=1).astype(np.float32)
    uppers = np.flatnonzero(home[order])
    for k in range(0, len(uppers), STEP):
        rows = uppers[k : k + STEP]
        low = int(np.searchsorted(along, along[rows[0]] - np.sqrt(limit)))
        close = left[rows] @ right[low : rows[-1] + 1].T >= np.float32(-limit / 2)
        j, i = np.divmod(np.flatnonzero(close.ravel()), close.shape[1])
        i, j = low + i, rows[j]
        i, j = order[i[i < j]], order[j[i < j]]
        if across:
            apart = chunk[i] != chunk[j]
            i, j = i[apart], j[apart]
        for part in range(0, len(i), PART):
            yield _verified(vectors, norms, x, i[part : part + PART], j[part : part + PART],
                            cosine, cuts, shares, at_block)


def _verified(vectors, norms, x, i, j, cosine, cuts, shares, at_block):
    """Pairs whose cosine is high enough and whose least used share is this block's."""
    cos = (vectors[i] * vectors[j]).sum(axis=1) / (norms[i] * norms[j])
    i, j = i[cos >= cosine], j[cos >= cosine]
    used = np.stack([((x[i][:, c] - x[j][:, c]) ** 2).sum(axis=1) for c in cuts], 1) / shares
    first = used.argmin(axis=1) == at_block
    return i[first], j[first]


def _links(dealt: DataFrame, cosine: float) -> DataFrame:
    """(node, n_links, root): linked vectors counted in a tile, and an edge each."""

    def join(table: pa.Table) -> pa.Table:
        node, count = table.column("node").to_numpy(), table.column("n").to_numpy()
        links, up = np.zeros(len(node), np.int64), np.arange(len(node))

        def root(k: int) -> int:
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        for i, j in _swept(table, cosine):
            np.add.at(links, i, count[j])
            np.add.at(links, j, count[i])
            for a, b in zip(i.tolist(), j.tolist(), strict=True):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        linked = np.flatnonzero(links)
        roots = node[[root(k) for k in linked.tolist()]] if len(linked) else node[:0]
        return pa.table({"node": node[linked], "n_links": links[linked], "root": roots})

    return dealt.groupBy("size", "block", "tile", "a", "b").applyInArrow(
        join, "node long, n_links long, root long"
    )


def near_duplicates(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.withColumn("node", F.xxhash64("embedding"))
    classes = stored(classes_of(rows), "vectors")
    found = stored(_links(_dealt(_placed(classes, cosine)), cosine), "links")
    degree = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    roots = stored(roots, "components").withColumnRenamed("node", "of")
    joined = classes.join(roots, classes.node == roots.of, "left")
    joined = joined.select("node", "n", "first_id", F.coalesce("root", "node").alias("root"))
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(least, "root").join(degree, "node", "left")
    own_links = F.coalesce("n_links", F.lit(0)) + F.col("n") - 1
    named = named.select(F.col("node").alias("of"), own_links.alias("links"), "component_id")
    named = stored(named, "named")
    slim = rows.select("vec_id", "node")
    component = F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        slim.join(named, slim.node == named.of, "left")
        .withColumn("component_id", component)
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
