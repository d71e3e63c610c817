"""Words of a batch of texts as byte positions, found with numpy.

Both word classes of the operators are unions of whole UTF-8 sequences: every byte
above 0x7F belongs to a word, so bytes can be tested instead of code points.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are taken at a time; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``, to be applied to lower-cased bytes.
ALNUM = _class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: ``[^\x20\x09-\x0D]``
VISIBLE = ~_class((0x20, 0x20), (0x09, 0x0D))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    """``raw`` and lower-cased ``data`` bytes; start, end and row of each word, in order."""

    raw: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    text_starts: np.ndarray
    rows: int

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    @property
    def first(self) -> np.ndarray:
        """Number of the first word of each row."""
        counts = self.counts
        return np.cumsum(counts) - counts


def split(texts: pa.Array, kind: np.ndarray = ALNUM) -> Words:
    """Words of each text; null has none."""
    parts = [b"" if text is None else text for text in texts.cast(pa.binary()).to_pylist()]
    raw = np.frombuffer(b" " + b" ".join(parts) + b" ", dtype=np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    text_starts = 1 + np.cumsum(lengths + 1) - (lengths + 1)
    data = LOWER[raw]
    inside = kind[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    row = np.searchsorted(text_starts, starts, "right") - 1
    return Words(raw, data, starts, ends, row, text_starts, len(parts))


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about ``PIECE_BYTES`` of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    sizes = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(sizes) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


#: Odd multiplier of the rolling hash, and its inverse modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)


#: Powers are kept for runs of texts of up to this many bytes, twice 40 MB in all.
_KEPT = PIECE_BYTES + (1 << 20)
_kept: dict[int, np.ndarray] = {}


def _powers(of: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers; longer texts compute their own."""
    if n <= _KEPT and int(of) in _kept:
        return _kept[int(of)][:n]
    out = np.full(max(n, _KEPT), of, dtype=np.uint64)
    out[:1] = 1
    np.multiply.accumulate(out, out=out)
    if n <= _KEPT:
        _kept[int(of)] = out
    return out[:n]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each span of ``data``; equal spans have equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(BASE, len(data)), out=total[1:])
    mixed = (total[ends] - total[starts]) * _powers(INVERSE, len(data))[starts]
    mixed ^= mixed >> np.uint64(29)
    return mixed * BASE


def same_bytes(a, a_starts, b, b_starts, lengths) -> np.ndarray:
    """Whether each pair of spans of equal length holds the same bytes."""
    if not len(lengths):
        return np.zeros(0, bool)
    offset = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    equal = a[np.repeat(a_starts, lengths) + offset] == b[np.repeat(b_starts, lengths) + offset]
    heads = np.cumsum(lengths) - lengths
    return np.logical_and.reduceat(equal, heads)
