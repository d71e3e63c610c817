"""Personal data: proposed spans, boosted trees over format and context, thresholds.

Base spans come from the contract's four patterns and their checks; they always stay.
High-recall generators propose further spans, which may overlap: written-out or spaced
e-mail addresses, spaced or bracketed IP addresses, and runs of digit groups. Boosted
trees learn from the corpus itself how such spans look (length, digits, grouping, signs,
checksum) and what stands around them: base spans rewritten into forms that the patterns
miss are positive, look-alikes that break the kind's format negative; other proposals
have no label. Proposals above their kind's threshold that overlap no base span are
added, the surest first.

The trees are fitted on a bounded number of examples, spread over kinds and documents. A
threshold per kind is then taken from the scores of every document's examples, by trees
that did not see the document's fold, so that ``PRECISION`` of what passes is positive
among examples. Every document is scanned whole. Scanning is linear in the text.

Null is read as the empty text, which has no spans. Repeated rows get equal results.
Offsets are code points, ends exclusive. Other columns are ignored or kept.
"""

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.llm import boosting
from centstream.llm import words as W
from centstream.llm.store import forget, stored, through

#: Examples that train the trees, the same share for each kind.
SAMPLE_SPANS = 20_000
FOLDS = 3
#: Bins of scores that examples are counted in.
BINS = 4096
EXAMPLE = {
    "kind": pa.int64(), "k": pa.int64(), "h": pa.int64(), "y": pa.int64(), "x": pa.list_(pa.float64())
}
PRECISION = 0.95
KINDS = ("email", "ip", "card", "phone")

# The patterns of the contract. A digit run is entered at its begin only,
# where a leftmost match must begin, so that long runs are read once.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_AT = re.compile(r"\s?(?:@|\(at\)|\[at\]|\{at\})\s?|\sat\s", re.IGNORECASE)
_LEFT = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_SPELLED = r"\s?(?:\(dot\)|\[dot\]|\{dot\})\s?|\sdot\s"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_RIGHT = re.compile(rf"{_LABEL}(?:(?:\.|{_SPELLED}){_LABEL}){{1,8}}", re.IGNORECASE)
#: A plain word "at" only counts before a domain with its dots written out.
_RIGHT_OF_WORD = re.compile(rf"{_LABEL}(?:(?:{_SPELLED}){_LABEL}){{1,8}}", re.IGNORECASE)
_LOOSE_IP = re.compile(
    r"(?<![0-9])[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\)|\(dot\)|\[dot\])\s?[0-9]{1,3}){3}(?![0-9])"
)
_NUMBERS = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().\-/]{0,3}[0-9])++(?![0-9A-Za-z])")

_LAST_LABEL = re.compile(r"[A-Za-z]*$")

CUES = (
    "tel phone call fax mobil mail contact kontakt ip server host card visa account iban konto "
    "numero correo telefon llam appel password token version page id"
).split()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches: an address begins where the run before its @ begins."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's spans, in order."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = (p.lstrip("0") or "0" for p in m[0].split("."))
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of whatever may be personal data."""
    out = set()
    for m in _AT.finditer(text):
        left = _LEFT.search(text, max(0, m.start() - 64), m.start())
        tail = _RIGHT_OF_WORD if m[0].strip().lower() == "at" else _RIGHT
        right = tail.match(text, m.end()) if left else None
        if left and right:
            out.add((left.start(), 0, right.end()))
    if _DIGIT.search(text):
        out |= {(m.start(), 1, m.end()) for m in _LOOSE_IP.finditer(text)}
        for m in _NUMBERS.finditer(text):
            n = len(_NOT_DIGIT.sub("", m[0]))
            if 12 <= n <= 19 and m[0][0] != "+":
                out.add((m.start(), 2, m.end()))
            if 7 <= n <= 15:
                out.add((m.start(), 3, m.end()))
    return sorted(out)


def describe(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of a proposal."""
    start, kind, end = span
    own = text[start:end]
    digits = _NOT_DIGIT.sub("", own)
    groups = re.findall(r"[0-9]+", own)
    before, after = text[max(0, start - 32) : start].lower(), text[end : end + 16].lower()
    return [
        float(kind),
        len(own),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        len(set(digits)),
        float(luhn(digits)) if digits else 0.0,
        own.count("."),
        own.count("-"),
        own.count(" "),
        float("(" in own),
        float(own.startswith("+") or before.endswith("+")),
        float("@" in own),
        sum(c.isalpha() for c in own) / len(own),
        float(before[-1:].isspace() or not before),
        float(after[:1].isspace() or not after),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in ("$", "€", "£", "#", "/")),
        float(any(cue in before for cue in CUES)),
        float(any(cue in after for cue in CUES)),
        float(max((len(g.lstrip("0")) * 1000 + int(g[:3]) for g in groups), default=0) <= 3255),
        len(_LAST_LABEL.search(own)[0]),
    ]


def rewritten(own: str, kind: int, pick: int) -> list[tuple[str, int]]:
    """Forms of a base span that the patterns miss (1), and look-alikes of them (0)."""
    digits = _NOT_DIGIT.sub("", own)
    if kind == 0:
        local, _, domain = own.rpartition("@")
        at = (" (at) ", "(at)", "[at]", " [at] ", " at ", "{at}", " @ ")[pick % 7]
        dot = (".", "(dot)", "[dot]", " dot ", " (dot) ")[3 if at == " at " else pick // 7 % 5]
        labels = domain.split(".")
        broken = [*labels[:-1], str(pick % 1000) if pick % 2 else labels[-1][:1]]
        return [(local + at + dot.join(labels), 1), (local + at + dot.join(broken), 0)]
    if kind == 1:
        dot = ("[.]", "(.)", "(dot)", "[dot]", " . ")[pick % 5]
        parts = [str(int(p)) for p in own.split(".")]
        broken = list(parts)
        broken[pick % 4] = str(256 + pick % 744)
        return [(dot.join(parts), 1), (dot.join(broken), 0)]
    if kind == 2:
        gap = (".", "  ", "/", " - ", ". ")[pick % 5]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + pick % 9) % 10)
        return [(gap.join(d[k : k + 4] for k in range(0, len(d), 4)), y) for d, y in ((digits, 1), (wrong, 0))]
    plain = own[1:] if pick % 2 else "00" + own[1:]
    d = digits[-8:]
    date = f"{1900 + int(d[:4]) % 200}-{1 + int(d[4:6]) % 12:02d}-{1 + int(d[6:8]) % 28:02d}"
    amount = ("." if pick % 3 else " ").join((digits[:3], digits[3:6], digits[6:9]))
    return [(plain, 1), ((date, amount, digits[: 7 + pick % 2])[pick // 2 % 3], 0)]


def examples(text: str, h: int):
    """(kind, number within kind, label, features) of known spans and rewritten ones.

    A proposal that no base span covers says nothing: it may well be personal data. So
    labels come from base spans as they stand, from rewritten forms of them in their
    place, and from look-alikes that break the kind's format.
    """
    counts = [0] * len(KINDS)
    for n, (start, kind, end) in enumerate(base_spans(text)):
        left, right = text[max(0, start - 64) : start], text[end : end + 64]
        for form, y in rewritten(text[start:end], kind, (h + 7919 * n) % 9973):
            changed, own = left + form + right, (len(left), kind, len(left) + len(form))
            for p in proposals(changed):
                if _covered(p, [own]) and _covered(own, [p]):
                    label = y if p[1] == kind else 0  # of another kind: not what it is
                    yield p[1], counts[p[1]], label, describe(changed, p)
                    counts[p[1]] += 1


def _covered(span: tuple, base: list[tuple]) -> bool:
    """Whether base spans share at least four fifths of a proposal."""
    length = span[2] - span[0]
    return any(5 * (min(span[2], e) - max(span[0], s)) >= 4 * length for s, _, e in base)


@dataclass
class Model:
    trees: boosting.Trees | None
    thresholds: tuple[float, ...]

    def added(self, text: str, base: list[tuple]) -> list[tuple[int, int, int]]:
        """Proposals that pass their kind's threshold and overlap no surer span."""
        if self.trees is None:
            return []
        found = proposals(text)
        if not found:
            return []
        taken = bytearray(len(text))
        for s, _, e in base:
            taken[s:e] = b"x" * (e - s)
        spans = [p for p in found if b"x" not in taken[p[0] : p[2]]]
        if not spans:
            return []
        scores = self.trees.score(np.array([describe(text, p) for p in spans]))
        out = []
        for score, span in sorted(zip((-scores).tolist(), spans, strict=True)):
            if -score >= self.thresholds[span[1]] and b"x" not in taken[span[0] : span[2]]:
                taken[span[0] : span[2]] = b"x" * (span[2] - span[0])
                out.append(span)
        return sorted(out)


def train(docs: DataFrame, sample_spans: int = SAMPLE_SPANS) -> Model:
    """Trees from examples of all kinds and many documents; thresholds from all examples."""
    h = F.xxhash64(F.lit("sample"), F.col("doc_id").cast("long"), "text").alias("h")
    rows = docs.select(h, "text")

    most = sample_spans // len(KINDS)

    def look(batches):
        first = [[] for _ in KINDS]

        def keep(own):
            own.sort()
            del own[most:]

        for batch in batches:
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for kind, k, y, x in examples(text or "", h):
                    if k < sample_spans:
                        first[kind].append((k, h, y, x))
            for own in first:
                if len(own) > 2 * most:
                    keep(own)
        for own in first:
            keep(own)
        out = [(kind, *example) for kind, own in enumerate(first) for example in own]
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, EXAMPLE.values(), strict=True)], list(EXAMPLE)
        )

    # Every document's first example of a kind comes before any second one. A task sends
    # its first ones only, and the first of all are merged as sorted runs, kind by kind.
    found = stored(rows.mapInArrow(look, "kind long, k long, h long, y long, x array<double>"), "examples")
    got = sorted(
        tuple(r)
        for kind in range(len(KINDS))
        for r in found.filter(F.col("kind") == kind).orderBy("k", "h", "y", "x").limit(most).collect()
    )
    forget(found)
    if not got or len({r[3] for r in got}) < 2:
        return Model(None, (2.0,) * len(KINDS))
    x, y = np.array([r[4] for r in got]), np.array([r[3] for r in got], float)
    fold = np.array([r[2] % FOLDS for r in got])
    trees = boosting.fit_calibrated(x, y, fold)
    unseen = [boosting.fit(x[fold != k], y[fold != k]) for k in range(FOLDS)]
    for own in unseen:
        own.knots, own.levels = trees.knots, trees.levels
    return Model(trees, _thresholds(rows, unseen))


def _thresholds(rows: DataFrame, unseen: list[boosting.Trees]) -> tuple[float, ...]:
    """Each kind's threshold from the scores of every document's examples.

    A document is scored by the trees that saw none of its fold.
    """
    shared = rows.sparkSession.sparkContext.broadcast(unseen)

    def count(batches):
        total = np.zeros((len(KINDS), BINS + 1, 2), np.int64)
        for batch in batches:
            folds = [[] for _ in range(FOLDS)]
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folds[h % FOLDS] += examples(text or "", h)
            for trees, own in zip(shared.value, folds, strict=True):
                if own:
                    scores = trees.score(np.array([e[3] for e in own]))
                    kind, y = (np.array([e[k] for e in own]) for k in (0, 2))
                    np.add.at(total, (kind, (scores * BINS).astype(int), y), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])

    total = np.zeros(len(KINDS) * (BINS + 1) * 2, np.int64)
    counted = rows.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n"))
    for at, n in counted.collect():  # a row per kind, bin and label at most
        total[at] = n
    return tuple(_threshold(own) for own in total.reshape(len(KINDS), BINS + 1, 2))


def _threshold(counts: np.ndarray) -> float:
    """Least bin of scores from which on ``PRECISION`` of the examples are positive."""
    both = np.cumsum(counts[::-1], axis=0)[::-1]
    rows = both.sum(1)
    good = (both[:, 1] >= PRECISION * rows) & (counts.sum(1) > 0)
    return float(np.flatnonzero(good)[0] / BINS) if good.any() else 2.0


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string"
)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Counts and spans of each document; narrow, nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches):
        model, names = shared.value, [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            for part in W.pieces(batch, 1):
                counts, hashed, spans = [], [], []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    base = base_spans(text)
                    counts.append([sum(k == i for _, k, _ in base) for i in range(len(KINDS))])
                    hashed.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    spans.append(_joined(sorted(base + model.added(text, base))))
                columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns, pa.array(hashed), pa.array(spans)], names
                )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(search, RESULT)


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all their columns, with each span replaced by its kind."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index("text")

    def replace(text: str | None, model: Model) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        out, done = [], 0
        for start, kind, end in sorted(base + model.added(text, base)):
            if end > done:
                out += [text[done : max(start, done)], f"[{KINDS[kind].upper()}]"]
                done = end
        return "".join([*out, text[done:]])

    def change(batches):
        for batch in batches:
            for part in W.pieces(batch, column):
                texts = [replace(t, shared.value) for t in part.column(column).to_pylist()]
                arrays = list(part.columns)
                arrays[column] = pa.array(texts, part.schema.field(column).type)
                yield pa.RecordBatch.from_arrays(arrays, part.schema.names)

    return through(docs, change)
