"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: bit b is set if it is set in over half of the 64-bit hashes of a text's
word shingles. Bits that agree with each other over the corpus are grouped into
partitions, and each partition gets a threshold t_i with sum(t_i) = radius - parts + 1:
two fingerprints within ``radius`` must then be within t_i in some partition i. Number
of partitions and thresholds come from a dynamic programme over estimated candidate
counts, which only decides cost: every choice finds every link.

Each fingerprint is indexed by its bits in every partition and probes all keys within
t_i; candidates are verified. Keys that very many fingerprints share are not paired at
all: two fingerprints are within 2 if and only if some value is within 1 of both, so
those fingerprints are grouped by the values around them, of which at most 65 meet.

Copies share a fingerprint and are counted once; links of copies are not expanded.
Texts without words have fingerprint zero and link like any others; null is read as
empty. Rows without a ``doc_id`` belong to a component but never name one. Repeated rows
get equal results.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.llm import words as W
from centstream.llm.components import components
from centstream.llm.store import stored

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Fingerprints of one index key that are still paired with each other.
PAIRED = 256
#: Weight of probing a key against verifying a candidate.
PROBE_COST = 2.0
FINGERPRINT_BITS = 64
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 17


def fingerprints_of(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprint of each text."""
    found = W.split(texts, W.VISIBLE)
    lengths = found.ends - found.starts
    # All words with one space after each; a shingle is a slice of it.
    take = np.repeat(found.starts - (np.cumsum(lengths + 1) - (lengths + 1)), lengths + 1)
    spaced = found.data[np.minimum(take + np.arange(len(take)), len(found.data) - 1)]
    ends = np.cumsum(lengths + 1)
    spaced[ends - 1] = 0x20
    counts, first = found.counts, found.first
    shingles = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    bounds = np.cumsum(shingles)
    row = np.repeat(np.arange(found.rows), shingles)
    word = np.arange(len(row)) - (bounds - shingles)[row] + first[row]
    last = word + np.minimum(counts[row], size) - 1
    begin, end = (ends - 1 - lengths)[word], (ends - 1)[last]
    data, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    sums = np.zeros((found.rows, FINGERPRINT_BITS), np.int64)
    for at in range(0, len(row), CHUNK):
        cut = slice(at, at + CHUNK)
        pairs = zip(begin[cut].tolist(), end[cut].tolist(), strict=True)
        hashed = np.fromiter((digest(data[b:e], SEED) for b, e in pairs), ">u8")
        bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1)
        heads = np.flatnonzero(np.diff(row[cut], prepend=-1))
        sums[row[cut][heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    majority = 2 * sums > shingles[:, None]
    return np.packbits(majority, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; the hash tells texts of one id apart."""

    def hashed(batches):
        for batch in batches:
            for part in W.pieces(batch, 2):
                fp = fingerprints_of(part.column(2), size).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(fp)], ["doc_id", "text_hash", "fp"]
                )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(hashed, "doc_id long, text_hash long, fp long")


@dataclass(frozen=True)
class Part:
    """Mask of a partition's bits, and how far apart its parts may be."""

    mask: int
    threshold: int

    @property
    def flips(self) -> list[int]:
        """Values to be xored to a key to get all keys within the threshold."""
        bits = [1 << b for b in range(FINGERPRINT_BITS) if self.mask >> b & 1]
        out = [0] if self.threshold >= 0 else []
        level = [(0, 0)]
        for _ in range(max(self.threshold, 0)):
            level = [(v | bits[i], i + 1) for v, k in level for i in range(k, len(bits))]
            out += [v for v, _ in level]
        return out


def bit_counts(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bits i and j set, over all rows."""

    def count(batches):
        total, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy().astype(">i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1]
            bits = bits.astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
            n += len(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(4097)), pa.array(np.append(total.ravel(), n))], ["at", "n"]
        )

    summed = classes.select("fp").mapInArrow(count, "at int, n long".replace("int", "long"))
    rows = summed.groupBy("at").agg(F.sum("n")).collect()  # 4,097 rows whatever the input
    flat = np.zeros(4097, np.int64)
    for at, n in rows:
        flat[at] = n
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of about equal size; each takes the bits most correlated with its own."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    linked = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    left, out = list(range(FINGERPRINT_BITS)), []
    for part in range(parts):
        room = len(left) // (parts - part)
        own = [max(left, key=lambda b: linked[b, left].sum())]
        left.remove(own[0])
        while len(own) < room:
            own.append(max(left, key=lambda b: linked[b, own].sum()))
            left.remove(own[-1])
        out.append(own)
    return out


def within(bits: list[int], share: np.ndarray, most: int) -> np.ndarray:
    """Estimated chance that two fingerprints differ in at most 0 .. ``most`` of ``bits``."""
    exactly = np.zeros(most + 1)
    exactly[0] = 1
    for bit in bits:
        differ = 2 * share[bit] * (1 - share[bit])
        moved = np.append(0, exactly[:-1]) * differ
        exactly = exactly * (1 - differ) + moved
    return np.cumsum(exactly)


def allocate(n: int, both: np.ndarray, radius: int = RADIUS) -> list[Part]:
    """Cheapest partitions and thresholds for ``n`` fingerprints."""
    share = np.diag(both) / max(n, 1)
    best, chosen = math.inf, []
    for parts in range(1, radius + 2):
        groups, budget = grouped_bits(n, both, parts), radius - parts + 1
        # plans[s]: cost and thresholds of the parts so far, whose thresholds + 1 sum to s
        plans = {0: (0.0, ())}
        for bits in groups:
            near, after = within(bits, share, radius), {}
            for used, (cost, taken) in plans.items():
                for t in range(-1, radius + 1):
                    if used + t + 1 > budget + parts:
                        break
                    keys = sum(math.comb(len(bits), k) for k in range(t + 1))
                    more = 0.0 if t < 0 else n * (PROBE_COST * keys + n * near[t])
                    new = (cost + more, (*taken, t))
                    after[used + t + 1] = min(after.get(used + t + 1, new), new)
            plans = after
        cost, taken = plans[budget + parts]
        if cost < best:
            masks = [sum(1 << b for b in bits) for bits in groups]
            best, chosen = cost, [Part(m, t) for m, t in zip(masks, taken, strict=True) if t >= 0]
    return chosen


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keys(classes: DataFrame, parts: list[Part], probe: bool) -> DataFrame:
    """(part, key, fp), one row per key."""
    rows = [
        (i, _signed(p.mask), _signed(flip))
        for i, p in enumerate(parts)
        for flip in (p.flips if probe else [0])
    ]
    # The plan of a partition is a literal of at most some thousand entries.
    plan = F.from_json(
        F.lit(str([{"part": i, "mask": m, "flip": f} for i, m, f in rows]).replace("'", '"')),
        "array<struct<part: int, mask: long, flip: long>>",
    )
    exploded = classes.select("fp", F.explode(plan).alias("k"))
    key = F.col("fp").bitwiseAND(F.col("k.mask")).bitwiseXOR(F.col("k.flip"))
    return exploded.select(F.col("k.part").alias("part"), key.alias("key"), "fp")


def links(classes: DataFrame, radius: int = RADIUS, paired: int = PAIRED) -> DataFrame:
    """Edges (u, v) of distinct fingerprints ``fp`` that join all within ``radius``.

    Pairs that share a key of over ``paired`` fingerprints may be joined through a third
    one that is within ``radius`` of both.
    """
    n, both = bit_counts(classes)
    parts = allocate(n, both, radius)
    indexed, probing = _keys(classes, parts, False), _keys(classes, parts, True)
    counts = indexed.groupBy("part", "key").agg(F.count("*").alias("n"))
    hot = stored(counts.filter(F.col("n") > paired).select("part", "key"), "hot-keys")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    crowded = not hot.isEmpty()
    cold = indexed.join(hot, ["part", "key"], "left_anti") if crowded else indexed
    pairs = cold.join(probing.withColumnRenamed("fp", "other"), ["part", "key"]).filter(
        (F.col("fp") != F.col("other")) & (distance <= radius)
    )
    found = pairs.select(F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v"))
    if crowded:
        members = probing.join(hot, ["part", "key"], "left_semi").select("fp")
        members = members.unionAll(indexed.join(hot, ["part", "key"], "left_semi").select("fp"))
        found = found.unionAll(_through_middle(members.distinct(), radius))
    return found.distinct()


def _through_middle(members: DataFrame, radius: int) -> DataFrame:
    """Edges among fingerprints that have a value within half the radius of both."""
    if radius > 2:
        raise ValueError("crowded keys are joined for a radius of at most 2")
    flips = F.array(*(F.lit(_signed(1 << b)) for b in range(FINGERPRINT_BITS)))
    around = F.explode(F.array_append(flips, F.lit(0).cast("long")))
    near = members.select("fp", around.alias("flip"))
    near = near.select(F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"), "fp")
    met = near.groupBy("middle").agg(F.collect_list("fp").alias("fps"))  # 65 at most
    met = met.filter(F.size("fps") > 1)
    distance = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    return (
        met.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
        .filter(F.col("u") != F.col("v"))
        .filter(distance <= radius)
        .select("u", "v")
    )


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, root): the component of every distinct fingerprint."""
    classes = stored(prints.select("fp").distinct(), "fingerprints")
    linked = stored(components(links(classes, radius)), "components")
    return classes.join(linked, classes.fp == linked.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def groups(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints = stored(fingerprints(docs, size), "prints")
    classes = stored(_classes(prints, radius), "classes")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    least = classes.join(first, "fp").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = classes.join(least, "root").select(F.col("fp").alias("own"), "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(stored(named, "named"), prints.fp == F.col("own"), "left").select(
        "doc_id", hexed, "component_id"
    )


def keep_one(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One row of each component, all its columns: the least id, rows without id last."""
    prints = stored(fingerprints(docs, size), "prints")
    classes = stored(_classes(prints, radius), "classes")
    first = prints.groupBy("fp").agg(F.min(first_of()).alias("first"))
    kept = classes.join(first, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return only(docs, prints, kept)


def first_of() -> Column:
    """Order of rows: by id, rows without one last, then by the text's hash."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")


def only(docs: DataFrame, prints: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept.first`` names; ``prints`` has a row for each of ``docs``."""
    kept = stored(
        kept.select(
            F.col("first.doc_id").alias("_kept_id"), F.col("first.text_hash").alias("_kept_hash")
        ),
        "kept",
    )
    same = docs["doc_id"].cast("long").eqNullSafe(kept["_kept_id"]) & (
        F.xxhash64(docs["text"]) == kept["_kept_hash"]
    )
    out = docs.join(kept, same, "left_semi")
    # Rows repeated with id and text would both stay; they are looked for, and rare.
    repeated = prints.groupBy("doc_id", "text_hash").count().filter("count > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "repeated")
    if repeated.isEmpty():
        return out
    again = out["doc_id"].cast("long").eqNullSafe(repeated["_id"]) & (
        F.xxhash64(out["text"]) == repeated["_hash"]
    )
    single = out.join(repeated, again, "left_anti")
    return single.unionAll(out.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"]))
