"""License scan: every column against a plain scan, expressions, long tags."""

import re
import time
from itertools import product

import pytest

from centstream.llm import licenses as L

DOCS = "doc_id long, text string, n_words int, obligations int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TAG = "SPDX-License-Identifier: "


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))

    def places(phrase):
        own = phrase.split()
        return [i for i in range(len(words)) if words[i : i + len(own)] == own]

    base = {label: places(phrase) for phrase, label in L.BASE.items()}
    starts = [place for own in base.values() for place in own]
    labels = {label for label, own in base.items() if own}
    more = labels | {label for phrase, label in L.NOTICES.items() if places(phrase)}
    notice = any(places(phrase) for phrase in L.NOTICES)
    score = 0.9 if notice else 0.8 if starts else 0.0
    joined = (",".join(sorted(labels)), ",".join(sorted(more)))
    ends = (min(starts, default=None), max(starts, default=None))
    return (len(words), len(starts), *ends, *joined, score, 0, 0.0)


TEXTS = [
    None, "", " .. ", "MIT License", "mit licenses", "the MIT--License,\nthe mit license mit license",
    "GNU Lesser General Public License and Apache\tLicense 2.0", "éMIT License", "0 mit license0 apache license",
    "GNU Affero General Public License; general public general public license", "BSD license. All rights reserved",
    "word " * 50_000 + "apache license", "Mozilla Public License mozilla public license", "cc-by 4.0, CC0 1.0, cc-by-sa",
]


def test_every_column_is_that_of_a_plain_scan(spark):
    rows = [(i, text, 9, 9) for i, text in enumerate(TEXTS)] + [(None, "mit license", 1, 1), (3, TEXTS[3], 9, 9)]
    got = L.scan(spark.createDataFrame(rows, DOCS)).collect()
    want = [(doc_id, *plain(text)) for doc_id, text, *_ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert L.scan(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize(
    "expression, labels, score, obligations, alternatives",
    [
        ("MIT", "mit", 1.0, 1, 1),
        ("MIT OR Apache-2.0", "apache-2.0,mit", 0.95, 1, 2),
        ("MIT AND Apache-2.0", "apache-2.0,mit", 1.0, 2, 1),
        ("(MIT OR ISC) AND (Zlib OR 0BSD)", "0bsd,isc,mit,zlib", 0.95, 2, 4),
        ("MIT OR ISC AND Zlib", "isc,mit,zlib", 0.95, 1, 2),
        ("GPL-2.0+ WITH Classpath-exception-2.0", "gpl-2.0+-with-classpath-exception-2.0", 1.0, 1, 1),
        ("LicenseRef-Mine AND mit", "licenseref-mine,mit", 1.0, 2, 1),
        ("see the file", "", 0.3, 0, 0),
        ("(MIT OR ISC) WITH Classpath-exception-2.0", "", 0.3, 0, 0),
        ("MIT WITH ISC", "", 0.3, 0, 0),
        ("Classpath-exception-2.0", "", 0.3, 0, 0),
        ("MIT OR", "mit", 1.0, 1, 1),
        ("(MIT", "", 0.3, 0, 0),
        ("AND MIT", "", 0.3, 0, 0),
    ],
)
def test_expressions(expression, labels, score, obligations, alternatives):
    got = L.scan_text(f"// {TAG}{expression}\nmore text", L.automaton())
    assert got[5:] == (labels, score, obligations, alternatives)


def test_tags_of_a_text_add_up():
    text = f"{TAG}MIT\n{TAG}ISC OR (Zlib AND MIT)\n{TAG}nothing\nApache License"
    got = L.scan_text(text, L.automaton())
    assert got[4:] == ("apache", "apache,isc,mit,zlib", 1.0, 2, 2)


def test_evaluation_is_that_of_all_choices():
    names = ["mit", "isc", "zlib", "0bsd"]
    for first, second, third in product(("AND", "OR"), repeat=3):
        tokens = f"( {names[0]} {first} {names[1]} ) {second} {names[2]} {third} {names[3]}".split()
        order = L.postfix(tokens)
        stack = []
        for token in order:
            if token.lower() not in L.PRECEDENCE:
                stack.append([(token,)])
                continue
            right, left = stack.pop(), stack.pop()
            stack.append(left + right if token.lower() == "or" else [a + b for a in left for b in right])
        got = L.evaluate(order)
        assert (got.least, got.ways) == (min(map(len, stack[0])), len(stack[0]))
        assert got.names == set(names)


@pytest.mark.parametrize("word", ["AND", "OR"])
def test_a_tag_line_of_a_megabyte(word):
    line = TAG + f" {word} ".join(f"LicenseRef-{i}" for i in range(60_000))
    assert len(line) > 900_000
    found, began = L.automaton(), time.perf_counter()
    got = L.scan_text(line, found)
    assert time.perf_counter() - began < 2
    assert got[7:] == (60_000, 1.0) if word == "AND" else (1, 60_000.0)
