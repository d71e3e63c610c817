"""License scan: Aho-Corasick finds tags and phrases, a shunting-yard parser reads tags.

One automaton, built once per task, holds the notice phrases and the tag
``spdx license identifier``. It runs over each whole text, brought to lower-case words
with one space between, so that a match can only stand on whole words. Behind a tag the
original text is read as a licence expression with ``AND``, ``OR``, ``WITH`` and
parentheses, turned into postfix order by precedence and evaluated in one pass: each
operand must be a known identifier or a ``LicenseRef-``, ``WITH`` binds an exception to one
licence, ``AND`` adds obligations up, ``OR`` keeps the fewer and adds alternatives up.

Base labels come from the contract's three phrases. Further phrases and tags add labels;
they never remove one. ``obligations`` is the number of licences that all tags of a text ask
for at least, ``alternatives`` the largest number of ways that one tag leaves open. Score:
how sure the labels are, the surest evidence counting: a tag without choice 1, one with a
choice 0.95, a long notice 0.9, a base phrase 0.8, a tag that is malformed or names what is
no licence 0.3, nothing 0.

Null is read as the empty text, which has no words, no labels and score 0. Time is linear in
a text, however long it or its tags are. Repeated rows are scanned each on its own, other
columns are ignored. No rows: an empty result.
"""

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centstream.llm import words as W

#: The phrases of the contract and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Further notices, and the labels they stand for.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by 4 0": "cc-by",
    "cc0 1 0": "cc0",
    "creative commons attribution": "cc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: Identifiers of licences and of exceptions, in lower case.
IDENTIFIERS = frozenset(
    "0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 apsl-2.0 "
    "artistic-1.0 artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent "
    "bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 "
    "cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 "
    "cddl-1.1 cecill-2.1 cpl-1.0 ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.3-only "
    "gfdl-1.3-or-later gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 "
    "gpl-3.0-only gpl-3.0-or-later hpnd isc lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only "
    "lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later lppl-1.3c mit mit-0 mpl-1.1 mpl-2.0 "
    "mpl-2.0-no-copyleft-exception ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 "
    "php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sleepycat unicode-3.0 unlicense upl-1.0 "
    "vim w3c wtfpl x11 zlib zpl-2.1".split()
)
EXCEPTIONS = frozenset(
    "autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 font-exception-2.0 "
    "gcc-exception-2.0 gcc-exception-3.1 libtool-exception linux-syscall-note llvm-exception "
    "openjdk-assembly-exception-1.0 qt-gpl-exception-1.0 universal-foss-exception-1.0".split()
)
OWN = "licenseref-"

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, obligations long, alternatives double"
)
NAMES = [column.split()[0] for column in RESULT.split(", ")]

_IDENTIFIER = re.compile(r"[A-Za-z0-9.+:-]+")
_GAP = re.compile(r"[ \t]*")
_TAG = re.compile(r"SPDX[^0-9A-Za-z\x80-\U0010FFFF]+License[^0-9A-Za-z\x80-\U0010FFFF]+Identifier"
                  r"[ \t]*:", re.IGNORECASE | re.ASCII)  # fmt: skip
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Licensing:
    """What an expression names, the licences it asks for at least, and its alternatives."""

    names: frozenset[str]
    least: int
    ways: float


def _tokens(text: str, at: int) -> list[str]:
    """Tokens of one line from ``at`` on, up to what can't belong to an expression."""
    out: list[str] = []
    while at < len(text):
        at = _GAP.match(text, at).end()
        if at < len(text) and text[at] in "()":
            out.append(text[at])
            at += 1
            continue
        match = _IDENTIFIER.match(text, at)
        if not match:
            break
        word, operand = match[0], bool(out) and out[-1].lower() not in (*PRECEDENCE, "(")
        if operand and word.lower() not in PRECEDENCE:
            break
        out.append(word)
        at = match.end()
    while out and (out[-1].lower() in PRECEDENCE or out[-1] == "("):
        out.pop()
    return out


def postfix(tokens: list[str]) -> list[str] | None:
    """Postfix order of an expression; None if it isn't well formed."""
    output, waiting, operand = [], [], False
    for token in tokens:
        low = token.lower()
        if low in PRECEDENCE:
            if not operand:
                return None
            while waiting and PRECEDENCE.get(waiting[-1], 0) >= PRECEDENCE[low]:
                output.append(waiting.pop())
            waiting.append(low)
            operand = False
        elif token == "(":
            if operand:
                return None
            waiting.append(token)
        elif token == ")":
            if not operand:
                return None
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        else:
            if operand:
                return None
            output.append(token.rstrip("."))
            operand = True
    if not operand or "(" in waiting:
        return None
    return output + waiting[::-1]


def _known(name: str) -> bool:
    return name in IDENTIFIERS or name.removesuffix("+") in IDENTIFIERS or name.startswith(OWN)


def evaluate(order: list[str]) -> Licensing | None:
    """A postfix expression; None if an operand is no licence or ``WITH`` joins others."""
    names: set[str] = set()
    # A licence that stands alone keeps its name until it is joined; then that is noted.
    stack: list[tuple[int, float, str | None]] = []

    def joined() -> tuple[int, float]:
        least, ways, alone = stack.pop()
        if alone:
            names.add(alone)
        return least, ways

    for place, token in enumerate(order):
        name = token.lower()
        if name not in PRECEDENCE:
            exception = place + 1 < len(order) and order[place + 1].lower() == "with"
            if not (name in EXCEPTIONS if exception else _known(name)):
                return None
            stack.append((1, 1.0, name))
        elif name == "with":
            (*_, right), (*_, left) = stack.pop(), stack.pop()
            if not left or "-with-" in left or not right:
                return None
            stack.append((1, 1.0, f"{left}-with-{right}"))
        else:
            (least, ways), (first, first_ways) = joined(), joined()
            if name == "and":
                stack.append((first + least, first_ways * ways, None))
            else:
                stack.append((min(first, least), first_ways + ways, None))
    least, ways = joined()
    return Licensing(frozenset(names), least, ways)


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for phrase in sorted({*BASE, *NOTICES, TAG}):
        made.add_word(f" {phrase} ", phrase)
    made.make_automaton()
    return made


_SPACED = np.where(W.ALNUM[W.LOWER], W.LOWER, np.uint8(0x20)).astype(np.uint8).tobytes()


def scan_text(text: str, found: ahocorasick.Automaton) -> tuple:
    """Columns of ``RESULT`` after the id."""
    parts = text.encode("utf-8", "surrogatepass").translate(_SPACED).split()
    joined = (b" " + b" ".join(parts) + b" ").decode("utf-8", "surrogatepass")
    starts, base, labels, score, tagged, word, counted = [], set(), set(), 0.0, False, 0, 0
    obligations, alternatives = 0, 0.0
    for begin, phrase in sorted((end - len(p) - 1, p) for end, p in found.iter(joined)):
        word += joined.count(" ", counted, begin)
        counted = begin
        if phrase in BASE:
            starts.append(word)
            base.add(BASE[phrase])
            score = max(score, 0.8)
        if phrase in NOTICES:
            labels.add(NOTICES[phrase])
            score = max(score, 0.9)
        tagged |= phrase == TAG
    if tagged:
        for tag in _TAG.finditer(text):
            order = postfix(_tokens(text, tag.end()))
            found_out = evaluate(order) if order else None
            if found_out is None:
                score = max(score, 0.3)
                continue
            score = max(score, 1.0 if found_out.ways == 1 else 0.95)
            labels |= found_out.names
            obligations += found_out.least
            alternatives = max(alternatives, found_out.ways)
    return (
        len(parts),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | labels)),
        score,
        obligations,
        alternatives,
    )


def scan(docs: DataFrame) -> DataFrame:
    """Places and labels of each document; narrow, nothing is shuffled."""

    def search(batches):
        found = automaton()
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.int64(), pa.float64()]
        for batch in batches:
            for part in W.pieces(batch, 1):
                rows = [scan_text(text or "", found) for text in part.column(1).to_pylist()]
                columns = [part.column(0), *zip(*rows, strict=True)]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, NAMES)

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(search, RESULT)
