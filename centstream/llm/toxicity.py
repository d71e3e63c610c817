"""Toxicity score: boosted trees over dense features of a text, with isotonic calibration.

Lexicon: beginnings of words (4, 5, 6 and 8 bytes, and whole short words) whose share of
toxic documents stands out, counted by Spark over all labelled training rows, all of
their text. The ``LEXICON`` most telling ones are kept. Dense features: densities and
strengths of lexicon words, how near they are to the second person, capitals,
punctuation, and words written with signs, digits or drawn-out letters. For rows that
train the trees, the lexicon is the one that their own fold did not take part in.

The trees are fitted on at most ``SAMPLE`` labelled training rows, chosen by a hash of the
id; everything else covers all rows. Labels of held-out ids (crc32 of the id as text,
modulo 4, is 2) are never read. Null and empty texts get a score from features of
zero. Null labels and labels of unknown documents are ignored; of repeated labels the
toxic one counts. Without labels of both classes every score is the share of toxic rows.
Repeated rows get equal scores; other columns are ignored or kept.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centstream.llm import boosting
from centstream.llm import words as W
from centstream.llm.store import through

THRESHOLD = 0.3
#: Labelled rows that train the trees.
SAMPLE = 20_000
#: Word beginnings kept, toxic rows each must be in, and least log-odds.
LEXICON = 4096
LEAST_ROWS = 3
LEAST_ODDS = 1.5
FOLDS = 4
#: Labels up to this number are broadcast to their documents; more are joined by shuffle.
SENT_LABELS = 2_000_000
NEAR = 5

#: Bytes of a word beginning; whole words are marked by a byte that no text has.
BEGINNINGS = (4, 5, 6, 8)
WHOLE = 7
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie ihnen tu te toi ton "
    "ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro"
).split()

FEATURES = (
    "words density hits strength strongest mean strong strong_density distance near second capitals "
    "shouted exclamation question marks signed drawn digits"
).split()


def held_out(doc_id: Column) -> Column:
    """Whether the labels of an id may not be learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _beginnings(found: W.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word, key) of every word beginning and every short whole word."""
    size = found.ends - found.starts
    padded = np.append(found.data, np.zeros(8, np.uint8))
    eight = np.zeros(len(size), np.uint64)
    for k in range(8):
        byte = padded[found.starts + k].astype(np.uint64)
        eight |= np.where(size > k, byte << np.uint64(8 * k), np.uint64(0))
    out = []
    for n in BEGINNINGS:
        word = np.flatnonzero(size > n if n <= WHOLE else size >= n)
        mask = np.uint64((1 << 8 * n) - 1)
        out.append((word, eight[word] & mask))
    word = np.flatnonzero((size >= 3) & (size <= WHOLE))
    mark = np.uint64(0xFF) << (np.uint64(8) * size[word].astype(np.uint64))
    out.append((word, eight[word] | mark))
    return out


@dataclass
class Lexicon:
    """Sorted keys and their log-odds, in all and without each fold."""

    keys: np.ndarray
    odds: np.ndarray  # (1 + FOLDS, keys)

    def __post_init__(self):
        self.table = np.zeros(1 << 16, bool)
        self.table[self._short(self.keys)] = True

    @staticmethod
    def _short(keys: np.ndarray) -> np.ndarray:
        three = keys & np.uint64(0xFFFFFF)
        return (three ^ three >> np.uint64(8)).astype(np.int64) & 0xFFFF

    def strengths(self, found: W.Words, fold: int = 0) -> np.ndarray:
        """Greatest log-odds among each word's beginnings; 0 if none is in the lexicon."""
        out = np.zeros(len(found.starts))
        if not len(self.keys):
            return out
        for word, key in _beginnings(found):
            likely = np.flatnonzero(self.table[self._short(key)])
            word, key = word[likely], key[likely]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            np.maximum.at(out, word[hit], self.odds[fold, at[hit]])
        return np.maximum(out, 0)


def _letters() -> tuple[np.ndarray, ...]:
    at = np.arange(256)
    upper, lower = (at >= 65) & (at <= 90), (at >= 97) & (at <= 122)
    marks = np.isin(at, [*b".,;:\"'()-"])
    signs = np.isin(at, [*b"*@$#!|+"])
    digits = (at >= 48) & (at <= 57)
    return upper, upper | lower | (at >= 128), marks, signs, digits


_UPPER, _LETTER, _MARK, _SIGN, _DIGIT = _letters()
_SECOND = np.array(sorted({int.from_bytes(w.encode()[:8], "little") for w in SECOND_PERSON}), np.uint64)


def features(texts: pa.Array, lexicon: Lexicon, fold: int = 0) -> np.ndarray:
    """Dense features of each text, in the order of ``FEATURES``."""
    found = W.split(texts)
    rows, counts = found.rows, found.counts
    n = np.maximum(counts, 1)
    strength = lexicon.strengths(found, fold)
    hit = np.flatnonzero(strength > 0)
    row = found.row
    hits = np.bincount(row[hit], minlength=rows)
    total = np.bincount(row[hit], strength[hit], rows)
    strongest = np.zeros(rows)
    np.maximum.at(strongest, row[hit], strength[hit])
    strong = np.bincount(row[hit[strength[hit] >= 3.5]], minlength=rows)

    size = found.ends - found.starts
    padded = np.append(found.data, np.zeros(8, np.uint8))
    short = np.flatnonzero(size <= 8)
    key = np.zeros(len(short), np.uint64)
    for k in range(8):
        byte = padded[found.starts[short] + k].astype(np.uint64)
        key |= np.where(size[short] > k, byte << np.uint64(8 * k), np.uint64(0))
    at = np.minimum(np.searchsorted(_SECOND, key), len(_SECOND) - 1)
    you = short[_SECOND[at] == key]
    distance, near = np.full(rows, 50.0), np.zeros(rows)
    if len(you) and len(hit):
        after = np.searchsorted(you, hit)
        gap = np.full(len(hit), 50.0)
        for side in (np.maximum(after - 1, 0), np.minimum(after, len(you) - 1)):
            same = row[you[side]] == row[hit]
            gap = np.where(same, np.minimum(gap, np.abs(you[side] - hit)), gap)
        np.minimum.at(distance, row[hit], gap)
        near = np.bincount(row[hit[gap <= NEAR]], minlength=rows)

    raw = found.raw
    text_of = lambda places: np.searchsorted(found.text_starts, places, "right") - 1
    per = lambda places: np.bincount(text_of(places), minlength=rows) if len(places) else np.zeros(rows)
    upper = _UPPER[raw]
    letters = np.maximum(per(np.flatnonzero(_LETTER[raw])), 1)
    run = np.add.accumulate(np.append(0, upper))
    shouted = np.flatnonzero((size >= 3) & (run[found.ends] - run[found.starts] == size))
    letter = _LETTER[raw]
    inner = _SIGN[raw[1:-1]] & letter[:-2] & letter[2:]
    digit = _DIGIT[raw[1:-1]] & letter[:-2] & letter[2:]
    drawn = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & letter[2:] & (raw[2:] < 128)
    columns = [
        np.log1p(counts),
        hits / n,
        np.log1p(hits),
        total / n,
        strongest,
        total / np.maximum(hits, 1),
        np.log1p(strong),
        strong / n,
        distance,
        near / n,
        np.bincount(row[you], minlength=rows) / n,
        per(np.flatnonzero(upper)) / letters,
        np.bincount(row[shouted], minlength=rows) / n,
        per(np.flatnonzero(raw == 0x21)) / n,
        per(np.flatnonzero(raw == 0x3F)) / n,
        per(np.flatnonzero(_MARK[raw])) / n,
        per(np.flatnonzero(inner) + 1) / n,
        per(np.flatnonzero(drawn) + 1) / n,
        per(np.flatnonzero(digit) + 1) / n,
    ]
    return np.stack(columns, axis=1).astype(float)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, fold, text) of the labelled documents that may be learned from."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), "toxic")
    known = known.filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    if known.limit(SENT_LABELS + 1).count() <= SENT_LABELS:
        known = F.broadcast(known)
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        known, F.col("doc_id") == F.col("id")
    )
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
    return joined.select("doc_id", "toxic", fold.alias("fold"), "text")


def mine(rows: DataFrame) -> tuple[Lexicon, int, float]:
    """Lexicon of training rows, how many rows there are, and the toxic share."""
    totals = np.zeros((2, FOLDS))
    for toxic, fold, n in rows.groupBy("toxic", "fold").count().collect():
        totals[toxic, fold] = n

    def count(batches):
        for batch in batches:
            for part in W.pieces(batch, 3):
                found = W.split(part.column(3))
                toxic, fold = (part.column(k).to_numpy().astype(np.int64) for k in (1, 2))
                kind = toxic * FOLDS + fold
                keys, kinds = [], []
                for word, key in _beginnings(found):
                    pair = np.empty(len(word), [("key", "u8"), ("row", "i8")])
                    order = np.lexsort((key, found.row[word]))
                    pair["key"], pair["row"] = key[order], found.row[word][order]
                    new = np.ones(len(pair), bool)
                    new[1:] = pair[1:] != pair[:-1]
                    keys.append(pair["key"][new])
                    kinds.append(kind[pair["row"][new]])
                key, k = np.concatenate(keys), np.concatenate(kinds)
                order = np.lexsort((k, key))
                key, k = key[order], k[order]
                heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (k[1:] != k[:-1])))[: len(key)]
                n = np.diff(np.append(heads, len(key)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[heads].view(np.int64)), pa.array(k[heads]), pa.array(n)],
                    ["key", "kind", "n"],
                )

    counted = rows.mapInArrow(count, "key long, kind long, n long").groupBy("key").agg(
        *(
            F.coalesce(F.sum(F.when(F.col("kind") == i, F.col("n"))), F.lit(0)).alias(f"k{i}")
            for i in range(2 * FOLDS)
        )
    )
    clean = sum(F.col(f"k{i}") for i in range(FOLDS))
    toxic = sum(F.col(f"k{i}") for i in range(FOLDS, 2 * FOLDS))
    all_clean, all_toxic = float(totals[0].sum()), float(totals[1].sum())
    odds = F.log((toxic + 0.5) / (all_toxic + 1)) - F.log((clean + 0.5) / (all_clean + 1))
    doubt = F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    best = (
        counted.filter((toxic >= LEAST_ROWS) & (odds >= LEAST_ODDS))
        .orderBy((odds / doubt).desc(), "key")
        .limit(LEXICON)
        .collect()
    )
    keys = np.array([r[0] for r in best], np.int64).view(np.uint64)
    counts = np.array([r[1:] for r in best], float).reshape(-1, 2, FOLDS)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    rows_of = [(counts.sum(2), totals.sum(1))]
    rows_of += [(counts.sum(2) - counts[:, :, f], totals.sum(1) - totals[:, f]) for f in range(FOLDS)]
    table = [
        np.where(
            c[:, 1] > 0, np.log((c[:, 1] + 0.5) / (t[1] + 1)) - np.log((c[:, 0] + 0.5) / (t[0] + 1)), 0
        )
        for c, t in rows_of
    ]
    n = int(totals.sum())
    return Lexicon(keys, np.array(table)), n, float(totals[1].sum() / n) if n else 0.0


@dataclass
class Model:
    """Lexicon and calibrated trees; without trees, a constant."""

    lexicon: Lexicon
    trees: boosting.Trees | None
    share: float

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        return self.trees.score(features(texts, self.lexicon))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model of the toxic labels of documents that aren't held out."""
    rows = training_rows(docs, labels)
    lexicon, n, share = mine(rows)
    if share in (0.0, 1.0):
        return Model(lexicon, None, share)
    part = min(1.0, sample / n)
    chosen = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))

    def dense(batches):
        for batch in batches:
            for piece in W.pieces(batch, 3):
                folds = piece.column(2).to_numpy()
                x = np.zeros((piece.num_rows, len(FEATURES)))
                for fold in np.unique(folds):
                    own = np.flatnonzero(folds == fold)
                    x[own] = features(piece.column(3).take(pa.array(own)), lexicon, 1 + int(fold))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:3], pa.array(list(x), pa.list_(pa.float64()))],
                    ["doc_id", "toxic", "fold", "x"],
                )

    got = chosen.mapInArrow(dense, "doc_id long, toxic int, fold int, x array<double>")
    got = got.select("doc_id", "toxic", "fold", "x").collect()  # about ``sample`` rows
    got = sorted(tuple(r) for r in got)
    x, y = np.array([r[3] for r in got]), np.array([r[1] for r in got], float)
    return Model(lexicon, boosting.fit_calibrated(x, y, np.array([r[2] for r in got])), share)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for part in W.pieces(batch, 2):
                values = shared.value.score(part.column(2))
                predicted = pa.array((values >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(values), predicted],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    ids = F.col("doc_id").cast("long")
    return docs.select(ids.alias("doc_id"), held_out(ids).alias("held_out"), "text").mapInArrow(
        score, "doc_id long, held_out boolean, score double, predicted int"
    )


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all their columns, that score below the threshold."""
    shared, column = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            for part in W.pieces(batch, column):
                yield part.filter(pa.array(shared.value.score(part.column(column)) < threshold))

    return through(docs, keep)
