"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first
turns, and conversations that start with it are its members. Turns are reduced to 128-bit
digests at once, so no text is shuffled. A node's key is a polynomial hash of its turns'
digests modulo 2^127 - 1; its parts can be joined, so a conversation of any length is hashed
in pieces.

Blocks of ``BLOCK`` successive turns come first: conversations that agree up to a block's
start are grouped by the hash at its end, and a group of equal blocks is one row with a count
from there on. Only in blocks where such siblings diverge are turn boundaries regrouped; where
all members share a block, its turns are taken from one of them.

The members of a node are those of the nodes below it and those that end there, so the least
member of a node owns all its nodes from there down: what a conversation owns is one run at
its end. Sums over subtrees are the run's sums from its end upwards, plus the totals of the
runs that hang below, which each owner adds to its own ancestors. That is one row per turn at
most. Conversations are sorted and summed in ranges, so one of them may hold any share of all
turns; of equal conversations, any number may share a node.

Rows without ``conv_id`` belong to no conversation and are left out. Null role and text are
empty ones. Turns of equal number are taken in the order of their digests, repeated rows as
turns of their own. Texts of any length count whole. Other columns are ignored. No rows: no
node, not even the root.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.llm.ordered import carried, in_order, running_sums
from centstream.llm.store import stored

#: Turns of a block.
BLOCK = 4
#: Modulus and multiplier of the keys.
MODULUS = (1 << 127) - 1
FACTOR = 0x2F0B4C47A6D3E59B8C1D7F3A95E6B21D
#: Ids that are joined into one piece before they are hashed.
PIECE = 1 << 16

ROOT = 1
BLOCKS = "conv_id long, block long, part int, behind long, local binary, digests binary, ns array<long>, last boolean"
KEYED = "conv_id long, block long, start binary, stop binary, keys array<binary>, ns array<long>, last boolean"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, digest, n) of each turn: place from 0, digest, code points of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)).alias("digest"),
        F.length(text).cast("long").alias("n"),
        F.lit(1).cast("long").alias("one"),
    ).filter("conv_id IS NOT NULL")
    numbered = running_sums(rows, "conv_id", ["turn", "digest"], ["one"], "turns")
    return numbered.select("conv_id", F.col("one_before").alias("i"), "digest", "n")


def _hashed(state: int, digest: bytes) -> int:
    return (state * FACTOR + int.from_bytes(digest, "big") + 1) % MODULUS


@lru_cache(1 << 16)
def _power(n: int) -> int:
    return pow(FACTOR, n, MODULUS)


def _key(state: int) -> bytes:
    return state.to_bytes(16, "big")


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns as rows of ``BLOCKS``; a block never lies in two partitions."""
    names = [column.split()[0] for column in BLOCKS.split(", ")]
    schema = pa.schema(
        zip(
            names,
            [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.bool_()],
            strict=True,
        )
    )
    conv, part, block, behind, state, begun, digests, ns = None, 0, 0, 0, 0, 0, [], []
    made: list[tuple] = []

    def flush(last: bool) -> None:
        row = (conv, block, part, behind - len(ns), _key(begun), b"".join(digests), list(ns), last)
        made.append(row)
        digests.clear()
        ns.clear()

    def batch_of() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*made, strict=True), schema.types, strict=True)], names
        )
        made.clear()
        return out

    for batch in batches:
        for own, i, digest, n, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != conv or i // BLOCK != block:
                if ns:
                    flush(own != conv)
                if own != conv:
                    behind = state = 0
                conv, block, part, begun = own, i // BLOCK, at, state
            digests.append(digest)
            ns.append(n)
            state = _hashed(state, digest)
            behind += 1
        if made:
            yield batch_of()
    if ns:
        flush(True)
        yield batch_of()


def keyed_blocks(turns: DataFrame) -> DataFrame:
    """Rows of ``KEYED``: the key before a block, at its end and after each of its turns.

    ``last`` marks the block in which the conversation ends.
    """
    rows = turns.withColumn("block", F.floor(F.col("i") / BLOCK)).select("conv_id", "i", "digest", "n", "block")
    spread = in_order(rows, "conv_id", ["i"], ["block"]).select("conv_id", "i", "digest", "n", "part")
    local = stored(spread.mapInArrow(_cut, BLOCKS), "blocks")
    end = F.struct("conv_id", "block", "behind", "local", "digests")
    ends = []
    for part, first, last in local.groupBy("part").agg(F.min("conv_id"), F.max(end)).collect():
        state, digests = _number(last.local), bytes(last.digests)
        for at in range(0, len(digests), 16):
            state = _hashed(state, digests[at : at + 16])
        ends.append((part, first, last.conv_id, (last.behind + len(digests) // 16, state)))
    # One row per partition: a state is turns and their hash.
    brought = carried(
        ends, (0, ROOT), lambda a, b: (a[0] + b[0], (a[1] * _power(b[0]) + b[1]) % MODULUS)
    )
    ends.sort()
    unfinished = {a[0]: a[2] for a, b in zip(ends, ends[1:], strict=False) if a[2] == b[1]}
    given = turns.sparkSession.sparkContext.broadcast((brought, unfinished))

    def key(batches):
        carry, going_on = given.value
        names = [column.split()[0] for column in KEYED.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.bool_()]
        for batch in batches:
            out = []
            for conv, block, part, behind, begun, digests, ns, last in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                owner, (_, state) = carry.get(part, (None, (0, ROOT)))
                if owner != conv:
                    state = ROOT
                state = (state * _power(behind) + _number(begun)) % MODULUS
                start, keys = _key(state), []
                for at in range(0, len(digests), 16):
                    state = _hashed(state, digests[at : at + 16])
                    keys.append(_key(state))
                out.append((conv, block, start, keys[-1], keys, ns, last and going_on.get(part) != conv))
            if out:
                columns = zip(zip(*out, strict=True), kinds, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    return local.mapInArrow(key, KEYED)


def _turns_in(rows: DataFrame, *more: Column | str) -> DataFrame:
    """(depth, key, parent, n, ...) of every turn of blocks with ``keys`` and ``ns``."""
    before = F.concat(F.array("start"), F.slice("keys", F.lit(1), F.size("keys") - 1))
    turn = F.posexplode(F.arrays_zip("keys", before.alias("parents"), "ns")).alias("j", "t")
    return rows.select("block", turn, *more).select(
        (F.col("block") * BLOCK + F.col("j") + 1).alias("depth"),
        F.col("t.keys").alias("key"),
        F.col("t.parents").alias("parent"),
        F.col("t.ns").alias("n"),
        *more,
    )


def _nodes(blocks: DataFrame) -> DataFrame:
    """(depth, key, parent, n, conv_id, n_convs) of every node below the root."""
    content = F.min(F.struct("conv_id", "keys", "ns")).alias("one")
    same = blocks.groupBy("block", "start", "stop").agg(F.count("*").alias("n_convs"), content)
    same = same.select("block", "start", "stop", "n_convs", "one.*")
    same = stored(same, "block-groups")
    split = same.groupBy("block", "start").agg(F.min("stop").alias("lo"), F.max("stop").alias("hi"))
    split = stored(split.filter("lo <> hi").select("block", "start"), "diverging")
    whole = _turns_in(same.join(split, ["block", "start"], "left_anti"), "conv_id", "n_convs")
    cut = _turns_in(same.join(split, ["block", "start"], "left_semi"), "conv_id", "n_convs")
    first = F.min(F.struct("conv_id", "parent", "n")).alias("first")
    regrouped = cut.groupBy("depth", "key").agg(F.sum("n_convs").alias("n_convs"), first)
    return whole.unionByName(regrouped.select("depth", "key", "n_convs", "first.*"))


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, key, conv_id) as (depth, key, first id, ids joined by commas)."""
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    at, ids, made = None, [], []

    def flush():
        made.append((*at, ids[0], ",".join(map(str, ids)).encode()))
        ids.clear()

    for batch in batches:
        for depth, key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and ((depth, key) != at or len(ids) == PIECE):
                flush()
            at = (depth, key)
            ids.append(conv)
        if made:
            columns = zip(zip(*made, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["depth", "key", "first", "ids"])
            made.clear()
    if ids:
        flush()
        columns = zip(zip(*made, strict=True), kinds, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["depth", "key", "first", "ids"])


def _piece_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as (depth, key, SHA-256 of all of a node's ids); one piece is held at a time."""
    at, running, made = None, None, []

    def out():
        columns = zip(zip(*made, strict=True), [pa.int64(), pa.binary(), pa.string()], strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["depth", "key", "ends"])
        made.clear()
        return batch

    for batch in batches:
        for depth, key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (depth, key) == at:
                running.update(b",")
            else:
                if at:
                    made.append((*at, running.hexdigest()))
                at, running = (depth, key), hashlib.sha256()
            running.update(ids)
        if made:
            yield out()
    if at:
        made.append((*at, running.hexdigest()))
        yield out()


def _ends(members: DataFrame) -> DataFrame:
    """(depth, key, ends) from (depth, key, conv_id) of the conversations that end at a node.

    Ids are joined to pieces where they lie; then a node's few pieces pass through one
    running hash, as SHA-256 of one string must.
    """
    order = ["depth", "key", "conv_id"]
    spread = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(spread.mapInArrow(_id_pieces, "depth long, key binary, first long, ids binary"), "id-pieces")
    whole = pieces.repartition("depth", "key").sortWithinPartitions("depth", "key", "first")
    return whole.mapInArrow(_piece_hashes, "depth long, key binary, ends string")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, i, digest, n); i counts from 0 without gaps.

    ``conversations`` has every ``conv_id`` once, those without turns too. Columns: conv_id
    (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over
    the subtree, members but one times the last text's code points), ends_sha256.
    """
    blocks = stored(keyed_blocks(turns), "keyed-blocks")
    nodes = stored(_nodes(blocks), "nodes")
    children = nodes.filter("depth > 1").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")
    ).agg(F.count("*").alias("n_children"))
    known = nodes.join(children, ["depth", "key"], "left").na.fill(0, ["n_children"]).select(
        "depth", "key", "parent", "conv_id", "n_convs", "n_children",
        ((F.col("n_convs") - 1) * F.col("n")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        (-F.col("depth")).alias("height"),
    )
    known = running_sums(known, "conv_id", ["height"], ["saved", "leaf"], "runs")
    known = stored(known, "known-nodes")

    runs = known.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.sum("saved").alias("run_saved"), F.sum("leaf").alias("run_leaves")
    ).filter("top > 1 AND (run_saved > 0 OR run_leaves > 0)")
    over = blocks.join(runs, "conv_id").filter(F.col("block") * BLOCK + 1 < F.col("top"))
    over = _turns_in(over, "top", "run_saved", "run_leaves").filter("depth < top")
    hung = over.groupBy("depth", "key").agg(F.sum("run_saved").alias("hung_saved"), F.sum("run_leaves").alias("hung_leaves"))

    last = F.col("block") * BLOCK + F.size("keys")
    some = blocks.filter("last").select(last.cast("long").alias("depth"), F.col("stop").alias("key"), "conv_id")
    root = F.lit(_key(ROOT))
    none = conversations.join(some, "conv_id", "left_anti")
    none = none.select(F.lit(0).cast("long").alias("depth"), root.alias("key"), "conv_id")
    ends = stored(_ends(some.unionByName(none)), "ends")

    parents = known.select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    top = conversations.agg(F.min("conv_id")).first()[0]
    nobody = F.lit(hashlib.sha256().hexdigest())
    below = (
        known.join(hung, ["depth", "key"], "left")
        .join(ends, ["depth", "key"], "left")
        .join(parents, ["depth", "parent"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") == 1, F.lit(top).cast("long")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            (F.col("leaf") + F.col("leaf_before") + F.coalesce("hung_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.col("saved_before") + F.coalesce("hung_saved", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends", nobody).alias("ends_sha256"),
        )
    )
    zero, nothing = F.lit(0).cast("long"), F.lit(None)
    facts = (
        conversations.select("conv_id", F.lit(1).alias("a"), zero.alias("b"), zero.alias("c"), zero.alias("d"), nothing.cast("string").alias("e"))
        .unionAll(known.select(nothing.cast("long"), zero, (F.col("depth") == 1).cast("long"), "leaf", "saved", nothing.cast("string")))
        .unionAll(ends.filter("depth = 0").select(nothing.cast("long"), zero, zero, zero, zero, "ends"))
    )
    whole = facts.agg(
        F.min("conv_id").alias("conv_id"), zero.alias("depth"), nothing.cast("long").alias("parent_conv_id"),
        F.sum("a").alias("n_convs"), F.sum("b").alias("n_children"),
        F.greatest(F.sum("c"), F.lit(1).cast("long")).alias("n_leaves"), F.sum("d").alias("saved_tokens"),
        F.coalesce(F.max("e"), nobody).alias("ends_sha256"),
    ).filter("conv_id IS NOT NULL")
    return whole.unionByName(below)


#: Conversations whose ids begin alike share the first turns of the least of them.
SHARED = 100
#: One more than the most turns that are shared.
MOST_SHARED = 6


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the conversations of the contract.

    The first h turns are those of conversation c - c % 100, as far as there are any, the
    rest are c's own behind its first h; h is crc32(c) % 6. At most five turns of one
    conversation go to the ids of its hundred.
    """
    turns = stored(turns_of(conversations), "numbered-turns")
    conv = F.col("conv_id")
    base = conv - conv % SHARED
    shared = F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED
    first = turns.filter((conv % SHARED == 0) & (F.col("i") < MOST_SHARED - 1)).groupBy(conv.alias("base"))
    first = first.agg(F.array_sort(F.collect_list(F.struct("i", "digest", "n"))).alias("head"))
    ids = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), shared.alias("h"))
    heads = ids.join(first, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")).alias("head")
    )
    heads = stored(heads, "heads")
    begun = heads.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    short = heads.filter(F.size("head") < F.col("h")).select("conv_id", F.size("head").alias("got"))
    rest = turns.withColumn("h", shared).filter(F.col("i") >= F.col("h")).join(short, "conv_id", "left")
    moved = (F.col("i") - F.col("h") + F.coalesce("got", F.col("h"))).cast("long")
    rest = rest.select("conv_id", moved.alias("i"), "digest", "n")
    return begun.unionByName(rest), heads.select("conv_id")
