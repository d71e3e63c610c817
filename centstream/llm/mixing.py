"""Mixing of overlapping sources to target weights by min-cost flow.

Documents are added up by membership pattern (the set of sources that hold a text).
Word capacity flows from patterns to source quotas; the k-th copy of a word costs
k - 1, so nothing is repeated while fresh words can still be routed. The flow says how
many words each pattern gives. Its documents are then taken in the order of a seeded
hash: all of them once per whole copy, and for the rest each that still fits, until what
is open is less than any document left.

That is done in runs of hashes. The end of a run, the first document that does not fit,
is found by sums over 4,096 hash ranges and then inside one of them, so no pattern is
ever sorted as a whole, and whether a document is taken depends on its own row and its
pattern's runs alone: documents are not shuffled. Behind a run the next few are taken one
by one, then a new run begins with the sizes that still fit. A round brings one row per
pattern and ``FILLERS`` documents to the driver; more than ``MOST_PATTERNS`` are refused.

Size is the number of words; null and empty texts have size 0 and give no words. A null
source is a source of its own, last in order; so is a missing list of sources. Rows
equal in id and text share a hash and are taken together. Reruns agree, whatever the
order or the partitions of the input. No rows: an empty result.
"""

from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.llm import words as W
from centstream.llm.store import packed, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = 20240501
RANGES = 4096
#: Distinct sets of sources; their sums are planned on the driver.
MOST_PATTERNS = 100_000
#: Documents behind a run that are tried one by one before the next run.
FILLERS = 256


def _pattern(sources: Column) -> Column:
    """The set of sources as text; a source is told apart from null by its first letter."""
    marked = F.transform(sources, lambda s: F.coalesce(F.concat(F.lit("s"), s), F.lit("z")))
    some = F.when(F.size(sources) > 0, marked).otherwise(F.array(F.lit("z")))
    return F.to_json(F.array_sort(F.array_distinct(some)))


def _hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id.cast("long"), text)


def _slim(docs: DataFrame, sources: Column, seed: int) -> DataFrame:
    """(doc_id, pattern, h, size) of every document."""

    def sized(batches):
        for batch in batches:
            for part in W.pieces(batch, 3):
                size = pa.array(W.split(part.column(3), W.VISIBLE).counts, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], size], ["doc_id", "pattern", "h", "size"]
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _pattern(sources).alias("pattern"),
        _hash(F.col("doc_id"), F.col("text"), seed).alias("h"),
        "text",
    )
    return rows.mapInArrow(sized, "doc_id long, pattern string, h long, size long")


def targets(
    sizes: dict[str, int], total: float, weights=WEIGHTS, most: float = REPEATS
) -> dict[str, float]:
    """Shares of ``total`` by weight, none above ``most`` times its source's size.

    Sources in order take the weights in turn; what a stopped source leaves is shared by
    weight among the rest, until none is above.
    """
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    out, open_, left = {}, sorted(sizes), float(total)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        stopped = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not stopped:
            return out | {s: unit * weight[s] for s in open_}
        for s in stopped:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


class Flow:
    """Maximal flow by shortest augmenting levels; arcs can be added between runs."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def add(self, a: int, b: int, room: int) -> int:
        for x, y, r in ((a, b, room), (b, a, 0)):
            self.arcs[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> None:
        while True:
            level = {source: 0}
            queue = deque([source])
            while queue:
                node = queue.popleft()
                for arc in self.arcs[node]:
                    if self.room[arc] and self.to[arc] not in level:
                        level[self.to[arc]] = level[node] + 1
                        queue.append(self.to[arc])
            if sink not in level:
                return
            self._block(source, sink, level)

    def _block(self, source: int, sink: int, level: dict[int, int]) -> None:
        """Push along arcs that lead one level up until none is left."""
        tried = [0] * len(self.arcs)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                push = min(self.room[arc] for arc in path)
                for arc in path:
                    self.room[arc] -= push
                    self.room[arc ^ 1] += push
                path, node = [], source
            elif tried[node] < len(self.arcs[node]):
                arc = self.arcs[node][tried[node]]
                if self.room[arc] and level.get(self.to[arc]) == level[node] + 1:
                    path.append(arc)
                    node = self.to[arc]
                else:
                    tried[node] += 1
            elif path:
                node = self.to[path.pop() ^ 1]
                tried[node] += 1
            else:
                return


def route(
    capacity: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: int = REPEATS
) -> dict[tuple[str, ...], dict[str, int]]:
    """Words that each pattern gives to each of its sources, at least repetition.

    Costs are on the copies alone, so routing all that fits of one copy before the next
    is opened is the cheapest flow.
    """
    patterns, sources = sorted(capacity), sorted(quotas)
    at = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    flow = Flow(2 + len(patterns) + len(sources))
    given = {}
    for i, pattern in enumerate(patterns):
        for s in pattern:
            given[pattern, s] = flow.add(2 + i, at[s], repeats * capacity[pattern])
    for s in sources:
        flow.add(at[s], 1, quotas[s])
    for _ in range(repeats):
        for i, pattern in enumerate(patterns):
            flow.add(0, 2 + i, capacity[pattern])
        flow.run(0, 1)
    return {p: {s: flow.room[given[p, s] ^ 1] for s in p} for p in patterns}


class Plan:
    """Targets, and for each pattern how many copies and which documents once more."""

    def __init__(self, slim: DataFrame, weights, share: float, repeats: int):
        spark = slim.sparkSession
        sums = slim.groupBy("pattern").agg(F.sum("size").alias("size"))
        rows = sums.limit(MOST_PATTERNS + 1).collect()
        if len(rows) > MOST_PATTERNS:
            raise ValueError(f"more than {MOST_PATTERNS} distinct sets of sources")
        members = spark.createDataFrame(
            [(r.pattern,) for r in rows] or [("[]",)], "pattern string"
        ).select("pattern", F.from_json("pattern", "array<string>").alias("m"))
        names = {r.pattern: tuple(r.m) for r in members.collect()} if rows else {}
        capacity = {names[r.pattern]: r["size"] for r in rows}
        self.sizes: dict[str, int] = {}
        for pattern, size in capacity.items():
            for s in pattern:
                self.sizes[s] = self.sizes.get(s, 0) + size
        total = share * sum(capacity.values())
        self.targets = targets(self.sizes, total, weights, repeats)
        routed = route(capacity, {s: round(t) for s, t in self.targets.items()}, repeats)
        self.rows = []
        for r in rows:
            p, size = names[r.pattern], r["size"]
            words = sum(routed[p].values())
            copies, rest = divmod(words, size) if size else (0, 0)
            first = p[0]
            self.rows.append(
                (r.pattern, self.sizes[first], self.targets[first], int(copies), int(rest))
            )
        self._cut(slim)

    def _cut(self, slim: DataFrame) -> None:
        """For each pattern, the runs of hashes taken once more, and the hashes behind them.

        Documents are taken in hash order wherever they still fit: a run up to the first
        that does not, the next ones behind it one by one, and so on until none fits.
        """
        self.runs: dict[str, list[tuple[int, int, int, int]]] = {}
        self.fillers: list[tuple[str, int]] = []
        open_ = [(r[0], r[4], _FIRST, 0) for r in self.rows if r[4]]
        while open_:
            open_ = self._fill(slim, self._run(slim, open_))

    def _fitting(self, slim: DataFrame, open_: list[tuple[str, int, int, int]]) -> DataFrame:
        """Documents from a pattern's place on that are no larger than what is open."""
        spark = slim.sparkSession
        rest = spark.createDataFrame(open_, "pattern string, rest long, place long, least long")
        return (
            slim.withColumn("rank", _order("h"))
            .join(F.broadcast(rest), "pattern")
            .filter("rank >= place AND size BETWEEN least AND rest")
        )

    def _run(self, slim: DataFrame, open_: list) -> list[tuple[str, int, int, int]]:
        """Adds each pattern's run; what it leaves open, and the place behind its end."""
        spark, after = slim.sparkSession, {row[0]: row[1:] for row in open_}
        fitting = self._fitting(slim, open_)
        # Ranges of equal width, 4,096 over all hashes.
        step = F.shiftright("rank", 52).alias("step")
        hist = fitting.groupBy("pattern", "rest", step).agg(F.sum("size").alias("size"))
        hist.createOrReplaceTempView(view := "mix_ranges")
        reached = spark.sql(
            f"""SELECT pattern, min(CASE WHEN upto > rest THEN struct(step, upto - size AS before) END) AS at
                FROM (SELECT *, sum(size) OVER (PARTITION BY pattern ORDER BY step) AS upto FROM {view})
                GROUP BY pattern"""
        ).collect()  # a row per pattern at most
        for r in reached:
            if r["at"] is None:  # all that fit are taken
                self._take(r.pattern, _LAST, after)
        at = [(r.pattern, *r["at"]) for r in reached if r["at"] is not None]
        if not at:
            return []
        at = spark.createDataFrame(at, "pattern string, step long, before long")
        inside = fitting.withColumn("step", step.cast("long")).join(F.broadcast(at), ["pattern", "step"])
        inside = inside.groupBy("pattern", "rest", "before", "rank").agg(F.sum("size").alias("size"))
        inside.createOrReplaceTempView(view := "mix_inside")
        ends = spark.sql(
            f"""SELECT pattern, first(rest) AS rest, min(CASE WHEN before + upto > rest THEN rank END) AS next,
                  max(CASE WHEN before + upto <= rest THEN before + upto ELSE before END) AS took
                FROM (SELECT *, sum(size) OVER (PARTITION BY pattern ORDER BY rank) AS upto
                      FROM {view}) GROUP BY pattern"""
        ).collect()
        for r in ends:
            self._take(r.pattern, r.next - 1, after)
        return [(r.pattern, r.rest - r.took, r.next + 1, 1) for r in ends if r.rest > r.took and r.next < _LAST]

    def _take(self, pattern: str, last: int, open_: dict) -> None:
        rest, place, least = open_[pattern]
        if last >= place:
            self.runs.setdefault(pattern, []).append((place, last, least, rest))

    def _fill(self, slim: DataFrame, open_: list) -> list[tuple[str, int, int, int]]:
        """Takes the next ``FILLERS`` that fit one by one; patterns that may have more."""
        if not open_:
            return []
        self._fitting(slim, open_).createOrReplaceTempView(view := "mix_after")
        near = slim.sparkSession.sql(
            f"""SELECT pattern, rank, size FROM (SELECT *, row_number() OVER (
                  PARTITION BY pattern ORDER BY rank, size) AS n FROM {view})
                WHERE n <= {FILLERS}"""
        ).collect()  # FILLERS rows per pattern at most
        found: dict[str, list[tuple[int, int]]] = {}
        for r in near:
            found.setdefault(r.pattern, []).append((r["rank"], r["size"]))
        more = []
        for pattern, room, place, least in open_:
            rows = found.get(pattern, [])
            units: dict[int, int] = {}
            for rank, size in rows:
                units[rank] = units.get(rank, 0) + size
            if len(rows) == FILLERS:  # the last hash may go on beyond what was read
                del units[max(units)]
            for rank, size in sorted(units.items()):
                place = rank + 1
                if size <= room:
                    room -= size
                    self.fillers.append((pattern, rank ^ _FIRST))
            if len(rows) == FILLERS and room:
                more.append((pattern, room, place, least))
        return more

    def joined(self, rows: DataFrame, size: Column) -> DataFrame:
        """``rows`` (with pattern and h) and their source_size, target and copies."""
        spark = rows.sparkSession
        plan = [
            (p, source, target, copies, self.runs.get(p, []))
            for p, source, target, copies, _ in self.rows
        ]
        run = "struct<place: long, last: long, least: long, most: long>"
        plan = spark.createDataFrame(
            plan, f"pattern string, source_size long, target double, whole int, runs array<{run}>"
        )
        more = spark.createDataFrame(self.fillers, "pattern string, h long").withColumn("more", F.lit(1))
        rank = _order("h")
        taken = F.exists(
            "runs",
            lambda r: (rank >= r["place"]) & (rank <= r["last"]) & (size >= r["least"]) & (size <= r["most"]),
        )
        copies = F.col("whole") + F.when(taken, 1).otherwise(F.coalesce("more", F.lit(0)))
        return (
            rows.join(F.broadcast(plan), "pattern")
            .join(F.broadcast(more), ["pattern", "h"], "left")
            .withColumn("copies", copies)
            .drop("whole", "runs", "more")
        )


#: Signed values in the order of unsigned hashes: the first and the last.
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def _order(column: str) -> Column:
    """Signed values in the order of the unsigned ones."""
    return F.col(column).bitwiseXOR(F.lit(_FIRST))


def mix(
    docs: DataFrame, sources: Column, weights=WEIGHTS, share: float = SHARE,
    repeats: int = REPEATS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every document.

    ``source_size`` and ``target`` are those of the first of its sources.
    """
    slim = stored(_slim(docs, sources, seed), "mix")
    plan = Plan(slim, weights, share, repeats)
    return plan.joined(slim, F.col("size")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        "copies",
    )


def mixed(
    docs: DataFrame, sources: Column, weights=WEIGHTS, share: float = SHARE,
    repeats: int = REPEATS, seed: int = SEED,
) -> DataFrame:
    """The documents of the mix, all their columns, one row for each copy."""
    slim = stored(_slim(docs, sources, seed), "mix")
    plan = Plan(slim, weights, share, repeats)
    rows = docs.select(
        packed(docs.columns), _pattern(sources).alias("pattern"), _hash(docs["doc_id"], docs["text"], seed).alias("h")
    )
    words = F.coalesce(F.regexp_count("kept.text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    chosen = plan.joined(rows, words).filter("copies > 0")
    repeated = chosen.select("kept", F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"))
    return repeated.select("kept.*")
