"""The numbered operators against plain versions on small tables, odd rows included."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from centstream.llm import (
    decontaminate, embeddings, licenses, lines, mixing, pii, sharding, simhash, toxicity, urls,
)
from centstream.llm import components as graph

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
VISIBLE = r"[^\x20\x09-\x0D]+"


def words(text, pattern=ALNUM):
    return re.findall(pattern, (text or "").translate(LOW))


def made(seed=1, n=60):
    """Documents with copies, near copies, a hot source, odd rows and one long text."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Über", "ñandú", "日本"]
    texts = [
        "\n".join(" ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(3))
        for _ in range(n)
    ]
    texts += texts[:5]
    texts += [t.replace(" ", "  ", 1) + " x" for t in texts[5:10]]
    texts += [None, "", " \n ", "!!!", "word " * 30_000, "A"]
    rows = [
        (i, t, "en", None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 5}", len(t or ""))
        for i, t in enumerate(texts)
    ]
    return rows + [(None, "no id at all", None, None, None), rows[0]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def windows(items):
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for at in range(len(w) - size + 1 if size else 0):
            yield item, tuple(w[at : at + size])


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_decontamination_is_that_of_every_window(spark, docs, block_bytes):
    rows = made()
    long_text = words(rows[3][1])
    items = [
        (1, " ".join(long_text[5:30])), (2, "A"), (3, None), (4, "  "), (10, rows[7][1]),
        (None, " ".join(long_text[:12])), (5, "never seen words " * 5),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    scanned = decontaminate.scan(docs, benchmark, block_bytes=block_bytes)
    got = Counter(tuple(r) for r in decontaminate.digest(scanned).drop("longest").collect())
    by_window = defaultdict(set)
    for item, window in windows(items):
        by_window[window].add(item)
    want = Counter()
    for doc_id, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in by_window}:
            for at in range(len(w) - size + 1):
                if (own := tuple(w[at : at + size])) in by_window:
                    hit |= set(range(at, at + size))
                    found |= by_window[own]
        names = ",".join(sorted(str(i) for i in found if i is not None))
        digest = hashlib.sha256(names.encode()).hexdigest()
        count = len(found - {None})
        want[doc_id, len(w), len(hit), count, digest, bool(hit)] += 1
    assert got == want
    kept = Counter(r.doc_id for r in decontaminate.remove(docs, benchmark).collect())
    assert kept == Counter({k[0]: n for k, n in want.items() if not k[5]})


def test_decontamination_finds_longest_matches(spark):
    text = " ".join(f"t{i}" for i in range(40))
    docs = spark.createDataFrame([(7, f"before {text} after")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, f"other {text}")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.matches(docs, benchmark).collect()] == [(7, 1, 1, 1, 40)]


def test_empty_benchmark_and_documents(spark, docs, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove(docs, none).count() == len(made())
    assert decontaminate.scan(nothing, none).count() == 0


def test_mix_comes_near_its_targets(spark, docs, nothing):
    rows = mixing.mix(docs, F.array("source")).collect()
    assert len(rows) == len(made())
    for r in rows:
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert sorted(map(tuple, rows), key=repr) == sorted(
        map(tuple, mixing.mix(docs.repartition(5), F.array("source")).collect()), key=repr
    )
    assert mixing.mix(nothing, F.array("source")).count() == 0
    taken = sum(r["copies"] for r in rows)
    assert mixing.mixed(docs, F.array("source")).count() == taken


def test_targets_stop_at_twice_the_size():
    got = mixing.targets({"a": 10, "b": 100, "c": 100}, 315.0)
    assert got == {"a": 20.0, "b": pytest.approx(295 / 3), "c": pytest.approx(590 / 3)}


def test_flow_repeats_only_what_it_must():
    capacity = {("a",): 10, ("a", "b"): 10}
    routed = mixing.route(capacity, {"a": 12, "b": 8})
    assert routed[("a",)] == {"a": 12} or sum(routed[("a", "b")].values()) <= 10
    assert sum(sum(r.values()) for r in routed.values()) == 20


def test_urls(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow"),
             (None, "/", "block")]
    pages = [
        (1, "http://A.Example.NET/en/x?y"), (2, "https://example.net/fr/"), (3, "http://net"),
        (4, None), (5, "no scheme"), (6, "x://notnet/"), (7, "http://b.org/fr/#a"), (8, ""),
        (9, "http://" + "a." * 3000 + "net/"), (9, "http://q.net?/en/"),
    ]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    for block_bytes in (1, 1 << 20):
        got = {(r.page_id, r.path): (r.rule, r.verdict) for r in urls.judge(pages, rules, block_bytes).collect()}
        assert got[1, "/en/x"] == ("example.net/en/", "allow")
        assert got[2, "/fr/"] == ("net/", "block")
        assert got[3, ""] == got[4, ""] == got[5, ""] == got[8, ""] == (None, "allow")
        assert got[6, "/"] == (None, "allow")
        assert got[7, "/fr/"] == ("org/fr/", "allow")
        assert got[9, "/"] == ("net/", "block")
        assert got[9, ""] == (None, "allow")


def fingerprint(text):
    w = words(text, VISIBLE)
    shingles = [" ".join(w[k : k + 3]) for k in range(max(len(w) - 2, 1))] if w else []
    hashed = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def reached(nodes, near):
    """Least number of each node's component."""
    up = list(range(nodes))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in near:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(k) for k in range(nodes)]


def test_simhash_groups(docs, nothing):
    rows = made()
    prints = [fingerprint(t) for _, t, *_ in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    root = reached(len(rows), pairs)
    least = {}
    for k, r in enumerate(root):
        least[r] = min(least.get(r, 1 << 60), rows[k][0] if rows[k][0] is not None else 1 << 60)
    want = Counter(
        (rows[k][0], f"{prints[k]:016x}", None if least[r] == 1 << 60 else least[r])
        for k, r in enumerate(root)
    )
    assert Counter(tuple(r) for r in simhash.groups(docs).collect()) == want
    assert simhash.groups(nothing).count() == 0
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len(set(root))


@pytest.mark.parametrize("paired", [2, 256])
def test_links_of_close_fingerprints(spark, paired):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(50)}
    for v in list(values)[:10]:
        for _ in range(30):
            values.add(v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    values = sorted(values)
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    found = graph.components(simhash.links(table, 2, paired)).collect()
    got = defaultdict(set)
    for r in found:
        got[r.root].add(r.node % (1 << 64))
    near = [(i, j) for i in range(len(values)) for j in range(i)
            if (values[i] ^ values[j]).bit_count() <= 2]
    want = defaultdict(set)
    for k, r in enumerate(reached(len(values), near)):
        want[r].add(values[k])
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_thresholds_keep_the_pigeonhole_sum():
    both = np.full((64, 64), 250.0) + np.diag(np.full(64, 250.0))
    for n in (1000, 10**10):
        parts = simhash.allocate(n, both * (n // 1000))
        assert sum(p.threshold + 1 for p in parts) == 3
        assert sum(p.mask for p in parts) == (1 << 64) - 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "u long, v long")
    got = {r.node: r.root for r in graph.components(edges.repartition(7)).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_embeddings_link_as_all_pairs_do(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((20, 16))
    x = np.concatenate([base, base[:8] + 0.15 * rng.standard_normal((8, 16)), base[:3], 2 * base[:2]])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    odd = [(90, None), (91, [0.0] * 16), (92, [float("nan")] * 16), (93, []), (94, [None] * 16),
           (95, [float("inf")] + [1.0] * 15), (96, [1.0, 0.0]), (97, [1.0, 0.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect()}
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    close = v @ v.T >= 0.95
    root = reached(len(v), [(i, j) for i, j in zip(*np.nonzero(close), strict=True) if i > j])
    want = {i: (int(close[i].sum()) - 1, root[i], root[i] == i) for i in range(len(v))}
    want |= {k: (0, k, True) for k in range(90, 96)} | {96: (1, 96, True), 97: (1, 96, False)}
    assert got == want


def test_toxicity_learns_a_lexicon_it_was_not_given(spark):
    rng = random.Random(2)
    plain = [f"plain{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        text = rng.choices(plain, k=40) + (["zorgle", "blarnt"] * 2 if toxic else [])
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (None, "zorgle", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(labels + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert held and all(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    none = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.scored(docs, none).collect()} == {0.0}


def test_sharding_is_gapless_and_near_equal(docs, nothing):
    rows = sharding.assignment(docs, 4).collect()
    assert len(rows) == len(made())
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sharding.assignment(nothing).count() == 0


def test_rebalance_moves_only_slots_of_full_shards(docs):
    sums = sharding.slot_sums(docs.filter("length(text) < 10000"))
    first = sharding.first_map(sums, 4)
    again = sharding.rebalance(first, sums, 4, tolerance=0.5)
    moved = first.alias("a").join(again.alias("b"), "_vslot").filter("a.shard <> b.shard")
    assert moved.count() == 0 and {r.version for r in again.select("version").distinct().collect()} == {2}
    grown = sharding.rebalance(first, sums, 5, tolerance=0.0)
    moved = first.alias("a").join(grown.alias("b"), "_vslot").filter("a.shard <> b.shard")
    assert 0 < moved.count() < sharding.SLOTS


PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            n = re.sub("[^0-9]", "", m[0])
            good = (
                k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split("."))
                or k == 2 and 12 <= len(n) <= 19 and pii.luhn(n) or k == 3 and 9 <= len(n) <= 15
            )
            out += [(m.start(), k, m.end())] if good else []
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choices("1234567890.+-@ ()ab%é", k=rng.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("4111 1111 1111 1111", "a@b@c.de.fg@h.i", "1.2.3.4.5.6.7.8", "+49 (0) 30-1234567"):
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("a" * 200_000 + "1" * 200_000) == []


def test_pii_keeps_base_spans_and_redacts(spark, docs):
    rows = [(i, f"mail me{i}@x{i}.com or call +49 30 12345{i:03d} now", "en", "s", 0) for i in range(50)]
    rows += [(99, "id 12345 of 2020-01-02", "en", "s", 0), (100, None, None, None, None)]
    table = spark.createDataFrame(rows, DOCS)
    model = pii.train(table)
    got = {r.doc_id: r for r in pii.scan(table, model).collect()}
    assert got[3].n_email == 1 and got[3].n_phone == 1 and got[100].spans == ""
    text = {r.doc_id: r.text for r in pii.redacted(table, model).collect()}
    assert text[3] == "mail [EMAIL] or call [PHONE] now" and text[100] is None


def line_fates(rows):
    known, gone = [], defaultdict(list)
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            w = words(line)
            if not w:
                continue
            own = {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))}
            if any(5 * len(own & o) >= 4 * len(own | o) for o in known):
                gone[doc_id].append(k)
            known.append(own)
    return gone


@pytest.mark.parametrize("paired", [1, 64])
def test_lines_go_as_all_pairs_say(spark, docs, nothing, monkeypatch, paired):
    monkeypatch.setattr(lines, "PAIRED", paired)
    rows = [r[:2] for r in made()]
    base = " ".join(f"b{i}" for i in range(60))
    rows += [(200 + i, base.replace(f"b{i * 7} ", "changed ")) for i in range(8)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = line_fates(rows)
    got = {r.doc_id: (r.n_lines, list(r.removed)) for r in lines.report(table).collect()}
    assert set(got) == {r[0] for r in rows}
    assert {k: v[1] for k, v in got.items() if v[1]} == dict(want)
    assert got[next(r[0] for r in made() if r[1] is None)] == (0, [])
    assert lines.report(nothing).count() == 0
    assert lines.cleaned(table).count() == len(rows)


def test_licenses(spark):
    texts = {
        1: "Released under the MIT License.", 2: None, 3: "mit  LICENSE mit-license apache license",
        4: "// SPDX-License-Identifier: (Apache-2.0 OR MIT) AND GPL-2.0 WITH Classpath-exception-2.0\nx",
        5: "SPDX-License-Identifier: OR", 6: "the general public licenses",
    }
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(table).collect()}
    assert tuple(got[1])[1:7] == (5, 1, 3, 3, "mit", "mit")
    assert tuple(got[2])[1:] == (0, 0, None, None, "", "", 0.0, 0, 0.0)
    assert tuple(got[3])[1:6] == (6, 3, 0, 4, "apache,mit")
    assert got[4].labels == "apache-2.0,gpl-2.0-with-classpath-exception-2.0,mit"
    assert got[4].base_labels == "" and tuple(got[4])[7:] == (0.95, 2, 2.0)  # a choice is left
    assert got[5].labels == "" and got[6].n_base == 0


def test_shunting_yard():
    assert licenses.postfix("A OR B AND C WITH D".split()) == ["A", "B", "C", "D", "with", "and", "or"]
    for bad in ("A B", "AND A", "( A", "A )", "A OR"):
        assert licenses.postfix(bad.split()) is None
    both = licenses.evaluate(licenses.postfix("( MIT OR ISC ) AND Zlib".split()))
    assert (both.names, both.least, both.ways) == ({"mit", "isc", "zlib"}, 2, 2)
