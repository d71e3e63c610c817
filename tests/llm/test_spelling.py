"""Spelling variants against words compared through their deletions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from centstream.llm import spelling as S

DOCS = "doc_id long, text string, word string, n int"
LOW = str.maketrans(S.UPPER, S.LOWER)


def plain_words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain(words):
    less, near = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            less[word[:i] + "\0" + word[i + 1 :]].add(word)
            if (shorter := word[:i] + word[i + 1 :]) in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in less.values():
        for word in group:
            near[word] |= group - {word}
    form = {}
    for word in words:
        if near[word]:
            best = min(near[word], key=lambda v: (-words[v], v))
            if words[best] >= 2 * words[word]:
                form[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, len(near[word]), words.get(form.get(word))))
    return sorted(out)


def got_of(frame):
    return sorted(map(tuple, frame.collect()))


def test_words_and_variants_of_documents(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choices("abcé", k=rng.randint(5, 7))) for _ in range(120)]
    rows = [(i, " ".join(rng.choices(stems, k=60)).title() + "\n12,x", "clash", 1) for i in range(40)]
    rows += [(None, "Étude étude ÉTUDE. Etude " * 3, None, None), (None, None, None, None), (1, "", "", 0)]
    rows += [rows[0], (2, "aaaaab " * 97 + "x" * 50_000, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    want = plain_words(rows)
    assert dict(map(tuple, S.vocabulary(docs).collect())) == want
    assert got_of(S.variants(S.vocabulary(docs))) == plain(want)


@pytest.mark.parametrize("crowded, letters", [(1 << 14, 1 << 18), (3, 1 << 18), (1 << 14, 40)])
def test_lists_of_any_size_give_the_same_pairs(spark, crowded, letters):
    rng = random.Random(4)
    words = {"".join(rng.choices("ab", k=rng.randint(1, 9))): rng.randint(1, 50) for _ in range(400)}
    words |= {"aaaaaaaaab"[i:] + "ÿ" * 400: i + 1 for i in range(4)}  # long ones
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {row.word: (row.n_near, row.form_n, row.form) for row in S.near_words(frame, crowded, letters).collect()}
    assert {w: n for w, (n, _, _) in got.items()} == {w: n for w, *_, n, _ in plain(words) if n}
    for word, form, *_ in plain(words):
        if form:
            assert got[word][1:] == (words[form], form)


def test_small_pieces_and_batches(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS", 5)
    monkeypatch.setattr(S, "SCANNED", 2)
    words = {f"word{a}{b}": 1 + i for i, (a, b) in enumerate([(a, b) for a in "abcdefgh" for b in "xyz"])}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    dealt = S.lists(frame).sort(*S.LIST, "free").select(*S.LIST, "free", "long", "word", "n").toArrow()
    found, best = Counter(), {}
    for batch in S._scans(iter(dealt.to_batches(max_chunksize=3))):
        for word, n_near, form_n, form in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found[word] += n_near
            best[word] = min(best.get(word, (0, "")), (-form_n, form))
    want = plain(words)
    assert found == {w: n for w, *_, n, _ in want if n}
    assert all(best[w][1] == form for w, form, *_ in want if form)


def test_no_words(spark):
    assert S.variants(S.vocabulary(spark.createDataFrame([], DOCS))).collect() == []
