"""Spelling variants: words one edit apart, found by a scan of sorted lists.

Vocabulary: runs of letters of whole texts, counted. Two words are near if one inserted,
deleted or replaced code point turns one into the other. A word's form is its most frequent
near word if that is at least twice as frequent; its root is the end of the chain of forms.

Words are dealt so that near ones meet: a pair whose shorter word has m letters has its edit
either in the first half, and then shares the letters behind it, or in the second, and then
shares those before it. So each word goes to the lists of its halves, for m its own length
and one less; what a list's words share is its key, what may differ is their free part.
Lists with over ``CROWDED`` words or ``CROWDED_LETTERS`` free letters are halved again, and
again, down to one free letter, where the alphabet bounds them. Nothing is capped.

A list is sorted by free part. Ranges of rows that share a prefix stand for it, and the rows
of the edit matrix of a word against that prefix, three cells wide, are computed once for the
range and reused by all rows of it: adjacent rows' common prefixes say where ranges split. A
range is left as soon as its row of the matrix exceeds one edit. Words are scanned many at a
time with numpy. A pair is reported by the one list whose free part holds the first letter
that differs, so no pair is reported twice.

A null text has no words, a null id reads as the empty string. Rows count as often as they
are repeated. Other columns are ignored. No rows: an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.llm.store import stored

LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every so many (document, word) pairs lose a letter, as the contract says.
MANGLED = 97
SHORTEST, RAREST = 5, 3
#: Times a word's count that its form has at least.
RATIO = 2
#: Words, and letters that may differ, of a list that is not halved.
CROWDED, CROWDED_LETTERS = 1 << 14, 1 << 18
#: Rows, and cells of the letter matrix, that a task holds at a time; words that scan at once.
ROWS, CELLS, SCANNED = 1 << 15, 1 << 22, 1 << 12

LIST = ("m", "a", "b", "outside")
FOUND = "word string, n_near long, form_n long, form string"
FAR = np.int8(9)


def vocabulary(docs: DataFrame, mangled: int = MANGLED) -> DataFrame:
    """(word, n) of every word of ``SHORTEST`` letters that occurs ``RAREST`` times."""
    lowered = F.translate("text", UPPER, LOWER)
    run = F.explode(F.regexp_extract_all(lowered, F.lit(f"({LETTERS})"), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run)
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % mangled == 0, cut).otherwise(F.col("run")).alias("word")
    words = hashed.select(word).filter(F.length("word") >= SHORTEST)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= RAREST)


def _list_rows(m: Column, a: Column, b: Column) -> list[Column]:
    """Key, free part and role of a word in the list for edits in [a, b) of m letters."""
    length = F.length("word")
    behind = m - b
    outside = F.concat(
        F.col("word").substr(F.lit(1), a), F.lit("\n"), F.col("word").substr(length - behind + 1, behind)
    )
    return [
        m.alias("m"), a.alias("a"), b.alias("b"), outside.alias("outside"),
        F.col("word").substr(a + 1, length - behind - a).alias("free"),
        (length > m).alias("long"), "word", "n",
    ]


def _halved(rows: DataFrame) -> DataFrame:
    """Rows (m, a, b, word, n) in the lists of both halves of [a, b)."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b"))
    )
    rows = rows.select("m", F.explode(halves).alias("part"), "word", "n")
    rows = rows.select("m", "part.a", "part.b", "word", "n").filter("a < b")
    return rows.select(*_list_rows(*map(F.col, "mab")))


def lists(words: DataFrame, crowded: int = CROWDED, letters: int = CROWDED_LETTERS) -> DataFrame:
    """Every word in its lists: (m, a, b, outside, free, long, word, n).

    ``long``: the word has one letter more than the list's m.
    """
    roles = F.array(F.length("word"), F.length("word") - 1)
    rows = words.select(F.explode(roles).alias("m"), F.lit(0).alias("a"), "word", "n").withColumn("b", F.col("m"))
    rows = stored(_halved(rows.filter("m > 0")), "lists")
    out = None
    while True:
        size = F.sum(F.length("free"))
        full = rows.groupBy(*LIST).agg(F.count("*").alias("words"), size.alias("letters"))
        full = full.filter((F.col("words") > crowded) | (F.col("letters") > letters)).filter("b - a > 1")
        full = stored(full.select(*LIST), "crowded-lists")
        if full.isEmpty():
            return rows if out is None else out.unionByName(rows)
        calm = rows.join(full, list(LIST), "left_anti")
        out = calm if out is None else out.unionByName(calm)
        rows = rows.join(full, list(LIST), "left_semi")
        rows = stored(_halved(rows.select("m", "a", "b", "word", "n")), "lists")


class Sorted:
    """Free parts of whole lists, each list's in order."""

    def __init__(self, group: np.ndarray, free: list[str]):
        self.lens = np.fromiter(map(len, free), np.int64, len(free))
        width = int(self.lens.max(initial=0))
        self.codes = np.zeros((len(free), width + 3), np.uint32)
        flat = np.frombuffer("".join(free).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(free)), self.lens)
        self.codes[row, np.arange(len(flat)) - (np.cumsum(self.lens) - self.lens)[row]] = flat
        # Letters that a row shares with the one before; -1 at the start of a list.
        same = self.codes[1:, : width + 1] == self.codes[:-1, : width + 1]
        shared = np.argmin(np.concatenate([same, np.zeros((len(same), 1), bool)], axis=1), axis=1)
        shared = np.minimum(shared, np.minimum(self.lens[1:], self.lens[:-1]))
        new = group[1:] != group[:-1]
        self.lcp = np.concatenate([[-1], np.where(new, -1, shared)])
        heads = np.flatnonzero(self.lcp < 0)
        sizes = np.diff(np.append(heads, len(free)))
        self.begin, self.end = np.repeat(heads, sizes), np.repeat(heads + sizes, sizes)

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word, row of its list) at one edit, for the rows ``words``."""
        q, lo, hi = words, self.begin[words], self.end[words]
        # Row k of the matrix at k - 1, k and k + 1 letters of the word.
        left = np.full(len(q), FAR)
        on = np.zeros(len(q), np.int8)
        right = np.where(self.lens[q] > 0, np.int8(1), FAR)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(self.codes.shape[1] - 2):
            ended = self.lens[lo] == k
            gap = self.lens[q] - k
            distance = np.select([gap == -1, gap == 0, gap == 1], [left, on, right], FAR)
            hit = ended & (distance == 1)
            found.append((q[hit], lo[hit]))
            # Ranges split where neighbours share no more than k letters.
            bounds = np.append(np.flatnonzero(self.lcp <= k), len(self.lens))
            first, last = np.searchsorted(bounds, lo), np.searchsorted(bounds, hi)
            first += ended  # the row that ends here is done
            count = last - first
            of = np.repeat(np.arange(len(q)), count)
            at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]
            q, lo, hi, left, on, right = q[of], bounds[at], bounds[at + 1], left[of], on[of], right[of]
            letter, length = self.codes[lo, k], self.lens[q]
            before = self.codes[q, k - 1] if k else np.zeros(len(q), np.uint32)
            new_left = np.minimum(on + 1, left + (before != letter))
            new_on = np.minimum(np.minimum(right + 1, on + (self.codes[q, k] != letter)), new_left + 1)
            new_on[length < k + 1] = FAR
            new_right = np.minimum(right + (self.codes[q, k + 1] != letter), new_on + 1)
            new_right[length < k + 2] = FAR
            alive = np.minimum(np.minimum(new_left, new_on), new_right) <= 1
            q, lo, hi = q[alive], lo[alive], hi[alive]
            left, on, right = new_left[alive], new_on[alive], new_right[alive]
            if not len(q):
                break
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _scan(rows: pa.Table) -> pa.RecordBatch | None:
    """(word, n_near, form_n, form) from whole lists, sorted."""
    keys = np.stack([rows.column(c).to_numpy() for c in ("m", "a", "b")])
    outside = rows.column("outside").combine_chunks().dictionary_encode().indices.to_numpy()
    keys = np.concatenate([keys, outside[None]])
    group = np.cumsum(np.append(0, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
    size = np.bincount(group)[group]
    keep = np.flatnonzero(size > 1)  # a word alone in its list meets nobody
    if not len(keep):
        return None
    rows, group = rows.take(pa.array(keep)), group[keep]
    m, a, b = keys[:3, keep]
    long = rows.column("long").to_numpy()
    n = rows.column("n").to_numpy()
    words = rows.column("word").to_pylist()
    table = Sorted(group, rows.column("free").to_pylist())
    of, to = [], []
    short = np.flatnonzero(~long)
    for at in range(0, len(short), SCANNED):
        one, two = table.near(short[at : at + SCANNED])
        # Where only the longer one's last free letter is new, another list reports it.
        width = (b - a)[one]
        tail = long[two] & (table.codes[one, width - 1] == table.codes[two, width - 1])
        tail[tail] = [
            bool((table.codes[i, :w] == table.codes[j, :w]).all())
            for i, j, w in zip(one[tail], two[tail], width[tail], strict=True)
        ]
        own = ~tail | (b == m)[one]
        one, two = one[own], two[own]
        of += [one, two[long[two]]]
        to += [two, one[long[two]]]
    of, to = (np.concatenate([np.zeros(0, np.int64), *found]) for found in (of, to))
    if not len(of):
        return None
    partners = np.unique(to)
    place = np.empty(len(words), np.int64)
    place[sorted(partners.tolist(), key=words.__getitem__)] = np.arange(len(partners))
    order = np.lexsort((place[to], -n[to], of))
    of, to = of[order], to[order]
    first = np.flatnonzero(np.diff(of, prepend=-1))
    count = np.diff(np.append(first, len(of)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[i] for i in of[first]], pa.string()), pa.array(count),
            pa.array(n[to[first]]), pa.array([words[i] for i in to[first]], pa.string()),
        ],
        [c.split()[0] for c in FOUND.split(", ")],
    )


def _scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lists, a few whole ones at a time."""
    held: list[pa.RecordBatch] = []

    def run(parts: list[pa.RecordBatch]):
        made = _scan(pa.Table.from_batches(parts)) if parts else None
        if made is not None:
            yield made

    def key(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(i)[row].as_py() for i in range(len(LIST)))

    rows, width = 0, 1
    for batch in batches:
        at = 0
        changed = np.zeros(batch.num_rows, bool)
        for i in range(len(LIST)):
            column = batch.column(i)
            changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        if batch.num_rows and held:
            changed[0] = key(held[-1], held[-1].num_rows - 1) != key(batch, 0)
        widths = pc.utf8_length(batch.column(len(LIST))).to_numpy()
        for start in [*np.flatnonzero(changed).tolist(), batch.num_rows]:
            if start > at:
                held.append(batch.slice(at, start - at))
                rows += start - at
                width = max(width, int(widths[at:start].max()))
                at = start
            if start < batch.num_rows and (rows >= ROWS or rows * width >= CELLS):
                yield from run(held)
                held, rows, width = [], 0, 1
    yield from run(held)


def near_words(words: DataFrame, crowded: int = CROWDED, letters: int = CROWDED_LETTERS) -> DataFrame:
    """(word, n_near, form_n, form) of words with near ones: how many, and the most frequent."""
    dealt = lists(words, crowded, letters).repartition(*LIST).sortWithinPartitions(*LIST, "free")
    found = dealt.select(*LIST, "free", "long", "word", "n").mapInArrow(_scans, FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form; each round doubles the steps of every chain.

    Counts at least double at each step, so chains are short and rounds few.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(further, "root", "left")
        moved = stored(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of a vocabulary (word, n)."""
    words = stored(words, "vocabulary")
    joined = words.join(near_words(words), "word", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    known = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    )
    known = stored(known, "near-words")
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
