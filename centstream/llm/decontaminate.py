"""Benchmark decontamination with suffix arrays of the training texts.

Each run of documents is a shard. Its training suffixes are sorted (sparsely: only
those whose first words begin some benchmark window, as no other suffix can hold
one), every benchmark suffix is binary-searched in that array, and each interval
found is extended to the longest verbatim match.

The benchmark is the stated query set. It goes through the driver in blocks of
``block_bytes`` of text, each broadcast for one narrow pass over the documents, so
memory does not grow with it. Documents are never shuffled.

A word is a run of ASCII letters (lower-cased), digits and non-ASCII characters. A
window is ``window`` consecutive words of an item; an item of fewer words, but not
none, is one window. Null and wordless texts match nothing. A null ``item_id`` counts
as hit words but names no item. Repeated rows get equal results; other columns are
ignored, whatever their names.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.llm import words as W
from centstream.llm.store import through

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Words of a window that a training suffix must begin with to enter the array.
SEED_WORDS = 4

SCAN = (
    "doc_id long, n_words long, starts array<long>, ends array<long>, "
    "item_ids array<long>, longest long"
)
WITH_TEXT = "doc_id long, text string"
MADE = ["n_words", "starts", "ends", "item_ids", "longest"]
MATCH = "doc_id long, item_id long, item_word long, doc_word long, n_words long"


@dataclass
class Block:
    """Benchmark suffixes of one block, sorted, and the words they are made of."""

    item_ids: list
    vocabulary: np.ndarray  # sorted hashes; a word's id is its place
    letters: np.ndarray
    letter_starts: np.ndarray
    letter_lengths: np.ndarray
    seeds: list  # (words, sorted keys of the window beginnings of so many words)
    suffixes: np.ndarray  # packed windows, sorted
    lengths: np.ndarray  # words of each
    holders: list  # (item, first word) pairs of each
    item_words: list  # word ids of each item
    depth: int


def _pack(ids: np.ndarray) -> np.ndarray:
    """Rows of word ids as byte strings that sort alike; -1 ends a row."""
    ids = np.where(np.minimum.accumulate(ids, axis=1) < 0, 0, ids + 1)
    return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * ids.shape[1]}").ravel()


def _keys(columns: list[np.ndarray], size: int) -> np.ndarray:
    key = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        key = key * np.uint64(size) + column.astype(np.uint64)
    return key


def index(items: list[tuple], window: int = WINDOW) -> Block | None:
    """Sorted suffixes of ``(item_id, text)`` pairs; None if they hold no word."""
    found = W.split(pa.array([text for _, text in items], pa.string()))
    if not len(found.starts):
        return None
    hashed = W.hashes(found.data, found.starts, found.ends)
    vocabulary, first, ids = np.unique(hashed, return_index=True, return_inverse=True)
    lengths = found.ends - found.starts
    if not W.same_bytes(
        found.data, found.starts, found.data, found.starts[first[ids]],
        np.minimum(lengths, lengths[first[ids]]),
    ).all() or (lengths != lengths[first[ids]]).any():
        raise ValueError("two benchmark words share a hash; change words.BASE")
    bounds = np.append(found.first, len(ids))
    item_words = [ids[bounds[i] : bounds[i + 1]] for i in range(found.rows)]
    holders: dict[tuple, list] = defaultdict(list)
    for item, own in enumerate(item_words):
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if size else 0):
            holders[tuple(own[at : at + size].tolist())].append((item, at))
    depth = max(map(len, holders))
    rows = np.full((len(holders), depth), -1)
    for i, suffix in enumerate(holders):
        rows[i, : len(suffix)] = suffix
    sizes = (rows >= 0).sum(axis=1)
    seeds = []
    for size in sorted({min(int(n), SEED_WORDS) for n in sizes}):
        own = rows[np.minimum(sizes, SEED_WORDS) == size]
        seeds.append((size, np.unique(_keys([own[:, k] for k in range(size)], len(vocabulary)))))
    packed = _pack(rows)
    order = np.argsort(packed, kind="stable")
    return Block(
        [item_id for item_id, _ in items], vocabulary, found.data,
        found.starts[first], lengths[first], seeds, packed[order], sizes[order],
        [list(holders.values())[i] for i in order], item_words, depth,
    )


def blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark, a bounded part at a time."""
    items, size = [], 0
    for item_id, text in benchmark.select("item_id", "text").toLocalIterator():
        items.append((item_id, text))
        size += len(text or "")
        if size >= block_bytes:
            yield index(items, window)
            items, size = [], 0
    yield index(items, window)


def _among(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


class Shard:
    """Training suffixes of a run of texts that can hold a window, in sorted order."""

    def __init__(self, texts: pa.Array, block: Block):
        found = W.split(texts)
        self.counts, self.first, self.row = found.counts, found.first, found.row
        hashed = W.hashes(found.data, found.starts, found.ends)
        place = np.minimum(
            np.searchsorted(block.vocabulary, hashed), len(block.vocabulary) - 1
        )
        ids = np.where(block.vocabulary[place] == hashed, place, -1)
        # A stop after every text, so that no suffix reads on into the next.
        self.at = np.arange(len(ids)) + found.row
        self.tokens = np.full(len(ids) + found.rows + block.depth, -1)
        self.tokens[self.at] = ids
        begins = self._begins(block)
        known = np.unique(begins[:, None] + np.arange(block.depth)) if len(begins) else begins
        known = known[self.tokens[known] >= 0]
        wrong = known[~self._verified(known, found, block)]
        if len(wrong):  # words that only share the hash of a benchmark word
            self.tokens[wrong] = -1
            begins = self._begins(block)
        rows = self.tokens[begins[:, None] + np.arange(block.depth)]
        packed = _pack(rows) if len(begins) else np.zeros(0, f"S{4 * block.depth}")
        order = np.argsort(packed, kind="stable")
        self.suffixes, self.places = packed[order], begins[order]

    def _begins(self, block: Block) -> np.ndarray:
        found = np.zeros(len(self.tokens), bool)
        for size, keys in block.seeds:
            begins = np.flatnonzero(self.tokens[: len(self.tokens) - block.depth] >= 0)
            columns = []
            for k in range(size):
                column = self.tokens[begins + k]
                begins, column = begins[column >= 0], column[column >= 0]
                columns = [self.tokens[begins + j] for j in range(k)] + [column]
            found[begins[_among(keys, _keys(columns, len(block.vocabulary)))]] = True
        return np.flatnonzero(found)

    def _verified(self, known: np.ndarray, found: W.Words, block: Block) -> np.ndarray:
        word = np.searchsorted(self.at, known)
        ids = self.tokens[known]
        same = found.ends[word] - found.starts[word] == block.letter_lengths[ids]
        same[same] = W.same_bytes(
            found.data, found.starts[word[same]],
            block.letters, block.letter_starts[ids[same]], block.letter_lengths[ids[same]],
        )
        return same

    def search(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the sorted suffixes that begin with each benchmark window."""
        low = np.searchsorted(self.suffixes, block.suffixes, "left")
        last = np.ascontiguousarray(block.suffixes).view(np.uint8).reshape(-1, 4 * block.depth)
        beyond = np.arange(4 * block.depth) >= 4 * block.lengths[:, None]
        last = np.where(beyond, 255, last).astype(np.uint8)
        high = np.searchsorted(self.suffixes, last.view(f"S{4 * block.depth}").ravel(), "right")
        return low, high

    def occurrences(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Window and token place of every occurrence."""
        low, high = self.search(block)
        found = high - low
        window = np.repeat(np.arange(len(low)), found)
        step = np.arange(len(window)) - np.repeat(np.cumsum(found) - found, found)
        return window, self.places[np.repeat(low, found) + step]

    def row_of(self, place: np.ndarray) -> np.ndarray:
        return self.row[np.searchsorted(self.at, place)]

    def reach(self, place: int, words: np.ndarray) -> int:
        """Words that the text from ``place`` on has in common with ``words``."""
        own = self.tokens[place : place + len(words)]
        other = np.flatnonzero(own != words[: len(own)])
        return int(other[0]) if len(other) else len(own)


def _spans(shard: Shard, block: Block, window: np.ndarray, place: np.ndarray):
    """Row, first and last + 1 token of each maximal run of hit tokens."""
    depth = np.zeros(len(shard.tokens) + 1, np.int64)
    np.add.at(depth, place, 1)
    np.add.at(depth, place + block.lengths[window], -1)
    inside = np.cumsum(depth) > 0
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[0::2], edges[1::2]
    return shard.row_of(starts), starts, ends


def _scan_piece(batch: pa.RecordBatch, block: Block | None, before: bool) -> list[pa.Array]:
    texts = batch.column(1)
    n = batch.num_rows
    starts, ends, items, longest = ([[] for _ in range(n)] for _ in range(4))
    if block is None:
        counts = W.split(texts).counts
    else:
        shard = Shard(texts, block)
        counts = shard.counts
        window, place = shard.occurrences(block)
        row, begin, end = _spans(shard, block, window, place)
        shift = shard.first[row] + row  # a row's tokens begin after so many
        for r, b, e in zip(row.tolist(), (begin - shift).tolist(), (end - shift).tolist(), strict=True):
            starts[r].append(b)
            ends[r].append(e)
        found = np.unique(np.stack([shard.row_of(place), window]), axis=1)
        for r, w in found.T.tolist():
            items[r].extend({block.item_ids[item] for item, _ in block.holders[w]})
        for r, _, _, _, size in _maximal(shard, block, window, place):
            longest[r].append(size)
    merged = [[], [], [], []]
    for r in range(n):
        s, e, i, top = starts[r], ends[r], items[r], max(longest[r], default=0)
        if before:
            old = [batch.column(k)[r].as_py() for k in (3, 4, 5, 6)]
            s, e = _union(s, e, old[0], old[1])
            i, top = i + old[2], max(top, old[3])
        for out, value in zip(merged, (s, e, sorted({x for x in i if x is not None}), top), strict=True):
            out.append(value)
    longs = pa.list_(pa.int64())
    return [
        pa.array(counts, pa.int64()),
        *(pa.array(values, longs) for values in merged[:3]),
        pa.array(merged[3], pa.int64()),
    ]


def _union(starts, ends, more_starts, more_ends):
    out: list[list[int]] = []
    for s, e in sorted([*zip(starts, ends, strict=True), *zip(more_starts, more_ends, strict=True)]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [s for s, _ in out], [e for _, e in out]


def _maximal(shard: Shard, block: Block, window: np.ndarray, place: np.ndarray):
    """(row, item, item word, token place, words) of matches that can't begin earlier."""
    for w, at in zip(window.tolist(), place.tolist(), strict=True):
        for item, word in block.holders[w]:
            own = block.item_words[item]
            if word and at and shard.tokens[at - 1] == own[word - 1]:
                continue
            row = int(shard.row_of(np.array([at]))[0])
            yield row, item, word, at, shard.reach(at, own[word:])


def _passes(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int):
    """The documents' ids and texts, and a broadcast block for each pass over them."""
    context = docs.sparkSession.sparkContext
    for block in blocks(benchmark, window, block_bytes):
        yield context.broadcast(block)


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document: words, maximal runs of hit words, items found, longest match."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    passes = list(_passes(docs, benchmark, window, block_bytes))
    for number, shared in enumerate(passes):
        last = number == len(passes) - 1

        def search(batches, shared=shared, before=number > 0, last=last):
            for batch in batches:
                for part in W.pieces(batch, 1):
                    made = _scan_piece(part, shared.value, before)
                    kept = part.columns[: 1 if last else 2]
                    names = ["doc_id", "text"][: len(kept)]
                    yield pa.RecordBatch.from_arrays([*kept, *made], [*names, *MADE])

        out = out.mapInArrow(search, SCAN if last else SCAN.replace("doc_id long", WITH_TEXT))
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Longest verbatim matches and where they stand, one row each."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = []
    for shared in _passes(docs, benchmark, window, block_bytes):

        def search(batches, shared=shared):
            block = shared.value
            for batch in batches if block else ():
                for part in W.pieces(batch, 1):
                    shard = Shard(part.column(1), block)
                    rows = []
                    for row, item, word, at, size in _maximal(
                        shard, block, *shard.occurrences(block)
                    ):
                        doc_word = at - int(shard.first[row]) - row
                        rows.append(
                            (part.column(0)[row].as_py(), block.item_ids[item], word, doc_word, size)
                        )
                    columns = list(zip(*rows, strict=True)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns],
                        ["doc_id", "item_id", "item_word", "doc_word", "n_words"],
                    )

        found.append(base.mapInArrow(search, MATCH))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and the items' hash of each scanned document."""
    n_hit = F.aggregate(
        F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x
    )
    names = F.array_join(F.array_sort(F.col("item_ids").cast("array<string>")), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
        "longest",
    )


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all their columns, without those that hold a window."""
    column = docs.columns.index("text")
    for shared in _passes(docs, benchmark, window, BLOCK_BYTES):

        def clean(batches, shared=shared):
            block = shared.value
            for batch in batches:
                for part in W.pieces(batch, column):
                    hit = np.zeros(part.num_rows, bool)
                    if block:
                        shard = Shard(part.column(column), block)
                        hit[shard.row_of(shard.occurrences(block)[1])] = True
                    yield part.filter(pa.array(~hit))

        docs = through(docs, clean)
    return docs
