"""What the mix takes against its targets, document by document."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from centstream.llm import mixing


def taken_in_order(docs):
    """Words of each source: whole copies, then in hash order whatever still fits."""
    h = mixing._hash(F.col("doc_id"), F.col("text"), mixing.SEED)
    hashes = {r.doc_id: r.h % (1 << 64) for r in docs.select("doc_id", h.alias("h")).collect()}
    plan = defaultdict(list)
    for r in mixing.mix(docs, F.array("source")).collect():
        plan[r.source_size, r.target].append((hashes[r.doc_id], r["size"], r.doc_id, r.taken))
    for (size, target), rows in plan.items():
        whole, room = divmod(round(target), size)
        for _, own, doc_id, taken in sorted(rows):
            fits = 0 < own <= room
            room -= own * fits
            yield doc_id, own * (whole + fits), taken
        left = [own for _, own, _, taken in rows if 0 < own and taken < (whole + 1) * own]
        yield "gap", True, not room or room < min(left)


@pytest.mark.parametrize("fillers", [3, 256])
def test_targets_are_met_beside_one_giant_document(spark, monkeypatch, fillers):
    monkeypatch.setattr(mixing, "FILLERS", fillers)
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(5, 40), f"s{i % 3}") for i in range(12_000)]
    rows += [(90_000 + k, "w " * 30_000, f"s{k}") for k in range(3)]
    rows += [(91_000, "w " * 7, "s0"), (91_001, "", "s1"), (91_002, None, "s2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gaps = []
    for seed in (mixing.SEED, 1, 2):
        sources = defaultdict(list)
        for r in mixing.mix(docs, F.array("source"), seed=seed).collect():
            sources[r.source_size, r.target].append((r["size"], r.copies))
        assert len(sources) == 3
        for (size, target), rows in sources.items():
            gap = round(target) - sum(own * copies for own, copies in rows)
            once_more = target // size + 1
            left = [own for own, copies in rows if own and copies < once_more]
            assert 0 <= gap and (not gap or not left or gap < min(left)), (seed, target, gap)
            gaps.append(gap / target)
    assert sorted(gaps)[len(gaps) // 2] < 0.001
    for doc_id, want, have in taken_in_order(docs):
        assert want == have, doc_id
    rows = mixing.mixed(docs, F.array("source")).groupBy("doc_id").count().collect()
    wanted = {r.doc_id: r.copies for r in mixing.mix(docs, F.array("source")).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in rows} == wanted


def test_repeated_rows_that_do_not_fit_together_end(spark):
    rows = [(1, "a b c", "s")] * 40 + [(2, "d", "s"), (3, "e f", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, F.array("source"), share=1.02).collect()
    assert sum(r.taken for r in got) == sum(r["size"] for r in got) + 2
