"""Line dedup by an exact set-similarity join.

A line's tokens are its distinct runs of ``SHINGLE`` words (a shorter line is one token),
as 64-bit hashes. A line goes if an earlier line has the same tokens or a Jaccard
similarity of at least ``SIMILARITY`` with it; earlier means a smaller ``doc_id``, then
text hash, then place in the text. Lines with equal token sets are one class.

Tokens are ordered by rarity: by the count of the hash range they fall in, over the
whole corpus, then by hash. That is one order for all lines, so two similar lines must
share a token among their first n - ceil(0.8 n) + 1 (prefix filter). Classes that share
one are joined if their sizes allow it (length filter) and if what is left behind the
shared token does (positional filter), and are then verified on all tokens. Tokens that
very many classes share are joined with the verification inside a semi join, which
gives each later class once, at its first match, and can be split.

Range counts and the candidates' bitmap have a fixed size whatever the input.

A line without words never goes. A null text has no lines. Rows equal in id and text are
one document and give one result row. Other columns are ignored or kept.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.llm import words as W
from centstream.llm.store import forget, packed, stored

SHINGLE = 5
SIMILARITY = (4, 5)
#: Hash ranges that tokens are counted in: the upper 16 bits.
RANGES = 1 << 16
#: Classes of one token that are still joined before they are verified.
PAIRED = 64
#: Bytes of a word that is still hashed together with others.
LONG_WORD = 64
#: Bits of the candidates' bitmap, and of one of its pieces.
BITMAP, PIECE = 1 << 24, 1 << 15

LINE = (
    "doc_id long, text_hash long, n_lines long, line long, cls long, size int, prefix array<long>"
)


class Lines:
    """Token sets of the lines of a batch of texts."""

    def __init__(self, texts: pa.Array):
        found = W.split(texts)
        breaks = np.flatnonzero(found.raw == 0x0A)
        # A line begins with each text and behind each line break.
        begins = np.sort(np.concatenate([found.text_starts, breaks + 1]))
        self.text = np.searchsorted(found.text_starts, begins, "right") - 1
        self.number = np.arange(len(begins)) - np.searchsorted(begins, found.text_starts)[self.text]
        self.begins = begins
        line = np.searchsorted(begins, found.starts, "right") - 1
        hashed = word_hashes(found.data, found.starts, found.ends)
        counts = np.bincount(line, minlength=len(begins))
        self._shingle(counts, np.cumsum(counts) - counts, hashed)

    def _shingle(self, counts: np.ndarray, first: np.ndarray, hashed: np.ndarray) -> None:
        """Tokens from the words' hashes, and the number and first of each line's words."""
        shingles = np.where(counts == 0, 0, np.maximum(counts - SHINGLE + 1, 1))
        of = np.repeat(np.arange(len(counts)), shingles)
        word = np.arange(len(of)) - (np.cumsum(shingles) - shingles - first)[of]
        padded = np.append(hashed, np.zeros(SHINGLE, np.uint64))
        run = padded[: len(hashed)].copy()
        for k in range(1, SHINGLE):
            run *= W.BASE
            run += padded[k : len(hashed) + k]
        token = run[word]
        short = np.flatnonzero(counts[of] < SHINGLE)
        own = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE):
            there = k < counts[of[short]]
            own = own * W.BASE + np.where(there, padded[word[short] + k], np.uint64(0))
        token[short] = own
        token ^= token >> np.uint64(31)
        self.of, self.token = of, token * W.INVERSE

    def ordered(self, ranks: np.ndarray) -> None:
        """Distinct tokens of each line, the rarest first.

        A token's range is its upper bits; with the range's rank in their place, tokens
        sort by rarity and stay distinct.
        """
        low = np.uint64((1 << 48) - 1)
        ranked = ranks[range_of(self.token)] << np.uint64(48) | (self.token & low)
        of, token = by_line(self.of, ranked, len(self.begins))
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (token[1:] != token[:-1])
        self.of, self.token = of[new], token[new]
        self.sizes = np.bincount(self.of, minlength=len(self.begins))
        self.first = np.cumsum(self.sizes) - self.sizes
        mixed = (self.token ^ (self.token >> np.uint64(33))) * W.BASE
        total = np.append(np.zeros(1, np.uint64), np.cumsum(mixed ^ (mixed >> np.uint64(29))))
        sums = total[self.first + self.sizes] - total[self.first]
        self.cls = ((sums ^ (sums >> np.uint64(32))) * W.INVERSE).view(np.int64)

    def prefixes(self) -> pa.Array:
        """The first tokens of each line; of two similar lines these share one."""
        size = self.sizes
        p = np.where(size > 0, size - (4 * size + 4) // 5 + 1, 0)
        take = np.repeat(self.first, p) + np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)
        return _list(self.token[take], p)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a step; very long words one by one."""
    lengths = ends - starts
    out = lengths.astype(np.uint64) * W.INVERSE
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    left = np.flatnonzero(lengths <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        left = left[lengths[left] > at]
        if not len(left):
            break
        unused = np.uint64(8) * np.maximum(at + 8 - lengths[left], 0).astype(np.uint64)
        mixed = (out[left] ^ (eight[starts[left] + at] << unused)) * W.BASE
        out[left] = mixed ^ (mixed >> np.uint64(32))
    for row in np.flatnonzero(lengths > LONG_WORD):
        out[row] = xxhash.xxh64_intdigest(data[starts[row] : ends[row]].tobytes())
    return out * W.INVERSE


def by_line(of: np.ndarray, token: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Both, in the order of line and then token.

    One sort of keys made of the line and the token's upper bits is several times as
    fast as a sort by two columns, which only follows where those bits leave ties.
    """
    bits = np.uint64(max(lines - 1, 1).bit_length())
    key = of.astype(np.uint64) << (np.uint64(64) - bits) | token >> bits
    order = np.argsort(key)
    of, token = of[order], token[order]
    if ((of[1:] == of[:-1]) & (token[1:] < token[:-1])).any():
        order = np.lexsort((token, of))
        of, token = of[order], token[order]
    return of, token


def range_of(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(48)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def range_ranks(docs: DataFrame, kind: type = Lines) -> np.ndarray:
    """Rank of each hash range by the tokens of the corpus that fall in it."""

    def count(batches):
        total = np.zeros(RANGES, np.int64)
        for batch in batches:
            for part in W.pieces(batch, 0):
                total += np.bincount(range_of(kind(part.column(0)).token), minlength=RANGES)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["at", "n"])

    rows = docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n"))
    counts = np.zeros(RANGES, np.int64)
    for at, n in rows.collect():  # RANGES rows at most
        counts[at] = n
    ranks = np.zeros(RANGES, np.uint64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(RANGES, dtype=np.uint64)
    return ranks


def _list(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _lines(docs: DataFrame, ranks) -> DataFrame:
    """A row for every line, wordless ones too, and one for each null text."""

    def cut(batches):
        for batch in batches:
            for part in W.pieces(batch, 2):
                found = Lines(part.column(2))
                found.ordered(ranks.value)
                size = found.sizes
                none = part.column(2).is_null().to_numpy(zero_copy_only=False)[found.text]
                text = pa.array(found.text)
                total = np.where(none, 0, np.bincount(found.text, minlength=part.num_rows)[found.text])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(text), part.column(1).take(text), pa.array(total),
                        pa.array(found.number), pa.array(found.cls, mask=size == 0),
                        pa.array(size.astype(np.int32)), found.prefixes(),
                    ],
                    [c.split()[0] for c in LINE.split(", ")],
                )

    return _texts(docs).mapInArrow(cut, LINE)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """``BITMAP`` bits, set where a value of the only column ``at`` falls."""
    bit = F.pmod("at", F.lit(BITMAP))
    pieces = (
        hashes.select((bit / PIECE).cast("int").alias("piece"), F.pmod(bit, F.lit(PIECE)).alias("bit"))
        .groupBy("piece")
        .agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        .collect()  # BITMAP / PIECE rows at most
    )
    bitmap = np.zeros(BITMAP // 8, np.uint8)
    for piece, bits in pieces:
        own = np.frombuffer(bytes(bits), np.uint8)
        bitmap[piece * PIECE // 8 : piece * PIECE // 8 + len(own)] = own
    return bitmap


def _there(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % BITMAP
    return (bitmap[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1


def _tokens_of(docs: DataFrame, classes: DataFrame, ranks, kind: type = Lines) -> DataFrame:
    """(cls, tokens) of the wanted classes (cls, text_hash), cut from the texts they began in.

    One bitmap keeps most other texts from being cut, another most other lines back.
    """
    sent = docs.sparkSession.sparkContext.broadcast
    of_text = sent(_bitmap(classes.select(F.col("text_hash").alias("at"))))
    of_line = sent(_bitmap(classes.select(F.col("cls").alias("at"))))

    def pick(batches):
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            batch = batch.take(pa.array(np.flatnonzero(_there(of_text.value, hashes))))
            for part in W.pieces(batch, 1):
                found = kind(part.column(1))
                found.ordered(ranks.value)
                rows = np.flatnonzero(_there(of_line.value, found.cls) & (found.sizes > 0))
                _, one = np.unique(found.cls[rows], return_index=True)
                rows, n = rows[one], found.sizes[rows[one]]
                take = np.repeat(found.first[rows], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.cls[rows]), _list(found.token[take], n)], ["cls", "tokens"]
                )

    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").filter("text IS NOT NULL")
    found = texts.mapInArrow(pick, "cls long, tokens array<long>")
    return found.join(classes, "cls", "left_semi").groupBy("cls").agg(F.first("tokens").alias("tokens"))


def _least_overlap(a: Column, b: Column) -> Column:
    """Tokens that sets of such sizes must share: ceil(4/9 (a + b))."""
    return ((4 * (a + b) + 8) / 9).cast("int")


def _fits(a: str, b: str) -> Column:
    """Length and positional filters."""
    size, place = (lambda s: F.col(f"{s}.size")), (lambda s: F.col(f"{s}.place"))
    rest = F.least(size(a) - place(a), size(b) - place(b))
    return (
        5 * F.least(size(a), size(b)) >= 4 * F.greatest(size(a), size(b))
    ) & (rest >= _least_overlap(size(a), size(b)))


def _possible(a: str, b: str) -> Column:
    """Earlier line first; length and positional filters."""
    return (F.col(f"{a}.born") < F.col(f"{b}.born")) & _fits(a, b)


def _similar(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(f"{a}.tokens", f"{b}.tokens"))
    return shared >= _least_overlap(F.size(f"{a}.tokens"), F.size(f"{b}.tokens"))


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_lines, line, gone) of every line; null texts have line null."""
    ranks = docs.sparkSession.sparkContext.broadcast(range_ranks(docs))
    lines = stored(_lines(docs, ranks), "lines")
    born = F.struct("doc_id", "text_hash", "line")
    classes = lines.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min(born).alias("born"), F.first("size").alias("size"), F.first("prefix").alias("prefix")
    )
    classes = stored(classes, "line-classes")
    postings = classes.select("cls", F.posexplode("prefix").alias("place", "token"))
    often = postings.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    often = stored(often, "shared-tokens")
    # Tokens and classes come once on the right, so these are hashed and postings not sorted.
    of_class = classes.select("cls", "born", "size").hint("shuffle_hash")
    shared = postings.join(often.hint("shuffle_hash"), "token").join(of_class, "cls")
    shared = stored(shared, "shared-postings")
    forget(often)

    few = shared.filter(F.col("n") <= PAIRED)
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & _possible("a", "b"))
    pairs = stored(
        pairs.select(F.col("a.cls").alias("one"), F.col("b.cls").alias("two")).distinct(), "line-pairs"
    )
    many = shared.filter(F.col("n") > PAIRED)
    wanted = pairs.select(F.col("one").alias("cls")).unionAll(pairs.select("two")).unionAll(many.select("cls"))
    wanted = classes.select("cls", "born.text_hash").join(wanted.distinct(), "cls")
    wanted = stored(wanted, "wanted-lines")
    tokens = stored(_tokens_of(docs, wanted, ranks), "line-tokens")

    one = tokens.select(F.col("cls").alias("one"), F.struct("tokens").alias("a"))
    two = tokens.select(F.col("cls").alias("two"), F.struct("tokens").alias("b"))
    gone = pairs.join(one, "one").join(two, "two").filter(_similar("a", "b")).select("two")
    used = [classes, shared, pairs, wanted, tokens]
    if not many.isEmpty():
        full = stored(many.join(tokens, "cls"), "crowded")
        used.append(full)
        a, b = full.alias("a"), full.alias("b")
        verified = F.when(_possible("a", "b"), _similar("a", "b")).otherwise(F.lit(False))
        met = b.join(a, (F.col("a.token") == F.col("b.token")) & verified, "left_semi")
        gone = gone.unionAll(met.select(F.col("cls").alias("two")))
    gone = gone.distinct().select(F.col("two").alias("cls"), F.lit(True).alias("late"))
    fate = stored(classes.select("cls", "born").join(gone, "cls", "left"), "line-fates")
    forget(*used)
    fate = fate.select(F.col("cls").alias("of"), "born", F.coalesce("late", F.lit(False)).alias("late"))
    joined = lines.join(fate, lines.cls == fate.of, "left")
    later = ~F.col("born").eqNullSafe(born) | F.col("late")
    return joined.select(
        "doc_id", "text_hash", "n_lines", F.when(F.col("n_lines") > 0, F.col("line")).alias("line"),
        (F.col("of").isNotNull() & later).alias("gone"),
    )


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed): the lines of each document that go."""
    line = F.when(F.col("gone"), F.col("line"))
    removed = F.array_sort(F.collect_set(line)).alias("removed")
    grouped = marked(docs).groupBy("doc_id", "text_hash").agg(F.max("n_lines").alias("n_lines"), removed)
    return grouped.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents, all their columns, without the lines that go."""
    line = F.when(F.col("gone"), F.col("line"))
    gone = marked(docs).groupBy("doc_id", "text_hash").agg(F.collect_set(line).alias("_gone"))
    gone = gone.filter(F.size("_gone") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_gone"
    )
    rows = docs.select(packed(docs.columns))
    old = F.col("kept.text")
    same = F.col("kept.doc_id").cast("long").eqNullSafe(F.col("_id")) & (
        F.xxhash64(old) == F.col("_hash")
    )
    left = F.filter(F.split(old, "\n"), lambda _, i: ~F.array_contains("_gone", i.cast("long")))
    text = F.when(F.col("_gone").isNull(), old).otherwise(F.array_join(left, "\n"))
    return rows.join(gone, same, "left").select(F.col("kept").withField("text", text).alias("kept")).select("kept.*")
