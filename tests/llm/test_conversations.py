"""The prefix trie against a plain one, over odd, long and equal conversations."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest

from centstream.llm import conversations as C
from centstream.llm.ordered import running_sums

SCHEMA = "conv_id long, turn long, role string, text string, depth int, part int"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def plain(rows):
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    told = {c: [row[3:] for row in sorted(rows)] for c, rows in told.items()}
    built = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = told.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        weight = (len(own) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += weight
            leaves[node[:d]] += not children[node]
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        ends = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(node), parent, len(own), children[node], leaves[node], saved[node], ends))
    return sorted(out, key=repr)


def made():
    rng = random.Random(3)
    rows = []
    for conv in [*range(-3, 12), *range(95, 130), *range(200, 240), 10**12]:
        size = rng.choice([0, 1, 2, 4, 5, 8, 9, 13])
        same = rng.random() < 0.4
        for turn in range(size):
            rows.append((conv, turn, "user" if turn % 2 else "bot", "shared" * turn if same else rng.choice("abc")))
    rows += [(200, turn, "user", f"long {turn}") for turn in range(20, 400)]  # one very long conversation
    rows += [(300, None, None, None), (300, None, "user", ""), (300, 1, "", "é\U0001f600"), (301, 1, "a", "b")]
    rows += [(301, 1, "a", "b"), (301, 1, "ab", ""), (None, 1, "user", "nobody"), (302, 0, "user", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_trie_is_that_of_all_prefixes(spark, partitions):
    rows = made()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([(*row, 7, 7) for row in rows], SCHEMA)
        got = C.trie(*C.rebuilt(frame)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_no_conversation_has_no_root(spark):
    assert C.trie(*C.rebuilt(spark.createDataFrame([], SCHEMA))).collect() == []
    nobody = spark.createDataFrame([(None, 1, "user", "text", 1, 1)], SCHEMA)
    assert C.trie(*C.rebuilt(nobody)).collect() == []


def test_sums_run_on_over_partitions(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, -5]), i, rng.randint(0, 9)) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "key long, at long, value long").repartition(5)
    got = running_sums(frame, "key", ["at"], ["value"], "sums").collect()
    totals, want = defaultdict(int), []
    for key, at, value in rows:
        want.append((key, at, value, totals[key]))
        totals[key] += value
    assert sorted(map(tuple, got)) == sorted(want)


def test_ids_of_a_node_are_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(C, "PIECE", 10)
    rows = [(1, b"a", c) for c in range(-50, 105)] + [(2, b"b", 7)]
    batches = [
        pa.RecordBatch.from_pylist([dict(zip(("depth", "key", "conv_id"), r, strict=True)) for r in rows[at : at + 13]])
        for at in range(0, len(rows), 13)
    ]
    pieces = list(C._id_pieces(iter(batches)))
    assert sum(piece.num_rows for piece in pieces) == 17
    got = {d: e for b in C._piece_hashes(iter(pieces)) for d, e in zip(b["depth"].to_pylist(), b["ends"].to_pylist())}
    want = hashlib.sha256(",".join(map(str, range(-50, 105))).encode()).hexdigest()
    assert got == {1: want, 2: hashlib.sha256(b"7").hexdigest()}
