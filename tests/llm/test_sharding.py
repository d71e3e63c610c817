"""Sharding: every column, equal texts, gapless places, growth and rebalancing with a stored map."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from centstream.llm import sharding
from centstream.session import new_folder

DOCS = "doc_id long, text string, _text int, _row int"


def made(seed=1, texts=400):
    rng = random.Random(seed)
    rows = [(i, "t" * rng.randint(0, 60) + str(i)) for i in range(texts)]
    rows += [(1000 + i, rows[i % 9][1]) for i in range(90)]  # groups of eleven
    return rows + [(None, None), (2000, ""), (2001, None), rows[0], rows[0], (3000, "x" * 300)]


def frame(spark, rows):
    return spark.createDataFrame([(*row, 5, 5) for row in rows], DOCS).repartition(3)


def test_every_column(spark):
    rows = made()
    got = sharding.assignment(frame(spark, rows), 6).collect()
    want = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        want[(doc_id, len(data) + 8, None if text is None else zlib.crc32(data), "bytes", None)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got) == want
    places, loads = defaultdict(list), Counter()
    for r in got:
        places[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert set(places) == set(range(6))
    assert all(sorted(own) == list(range(len(own))) for own in places.values())
    assert max(loads.values()) - min(loads.values()) <= 0.1 * sum(loads.values()) / 6
    text_of = dict(rows)
    shards = defaultdict(set)
    for r in got:
        shards[text_of[r.doc_id] or ""].add(r.shard)
    assert all(len(found) == 1 for found in shards.values())


def test_copies_of_a_text_beyond_a_fair_share_are_dealt(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(5000 + i, f"other {i}" * 3) for i in range(1500)]
    got = sharding.assignment(frame(spark, rows), 4).collect()
    loads = Counter()
    for r in got:
        loads[r.shard] += r.size
    assert len({r.shard for r in got if r.doc_id < 3000}) == 4
    assert max(loads.values()) <= 1.05 * min(loads.values())


def test_a_stored_map_is_rebalanced(spark):
    maps, shards = new_folder(spark, "maps"), 4
    docs = frame(spark, made(2, 3000))
    first = {r.doc_id: r.shard for r in sharding.assignment(docs, shards, maps).collect()}
    again = {r.doc_id: r.shard for r in sharding.assignment(docs, shards, maps).collect()}
    assert first == again  # nothing is overfull, so no slot moves
    assert sharding.latest_map(spark, maps).first().version == 2
    more = docs.unionByName(frame(spark, [(9000 + i, f"new {i} " * 9) for i in range(300)]))
    grown = sharding.assignment(more, shards + 1, maps).collect()
    moved = [r for r in grown if r.doc_id in first and r.shard != first[r.doc_id]]
    assert moved and len(moved) < len(first) / 2
    loads = Counter()
    for r in grown:
        loads[r.shard] += r.size
    assert len(loads) == shards + 1
    assert max(loads.values()) <= 1.1 * sum(loads.values()) / (shards + 1)
    stored = sharding.latest_map(spark, maps)
    assert (stored.count(), stored.first().version) == (sharding.SLOTS, 3)
    assert sharding.latest_map(spark, new_folder(spark, "none")) is None


def test_no_python_and_no_rows(spark):
    docs = frame(spark, made())
    plan = sharding.assignment(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sharding.assignment(docs.filter(F.lit(False))).count() == 0
