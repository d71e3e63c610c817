"""Every query and stage over odd tables: nulls, ties, repeats, clashing columns, no rows."""

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline as pipeline
from centstream.llm import lines, pii, queries, sharding
from centstream.llm.store import stored

#: Names that operators use for results or on the way.
CLASHING = (
    "size shard slot law taken target score predicted held_out fp fingerprint component_id pattern "
    "h copies node root id toxic fold kept k n text_hash n_words n_hit starts ends item_ids of born "
    "late cls bytes records version other cut more whole page_id rule verdict vec_id copy place "
    "_vslot _within _before _kept_id _kept_hash _copy _id _hash _gone _doc a.b doc`id"
).split()
TEXTS = (
    None,
    "",
    " \n\t ",
    "one",
    "one two",
    "the quick brown fox jumps over the lazy dog and runs away from the farm at night",
    "THE quick brown fox jumps over the lazy dog and runs away from the farm at night",
    "you are a wretched grolk, you grolk! " * 3,
    "mail a@b.example or +44 20 7946 0958, SPDX-License-Identifier: (MIT OR Apache-2.0) AND",
    "word " * 40_000,
    "x" * 200_000,
    "\U0001f600 éè \u0000 ퟿",
)


def written(folder, documents, embeddings, pages, benchmark, labels, conversations):
    extra = {name: pa.array([7] * len(documents), pa.int32()) for name in CLASHING}
    ids, texts, sources = zip(*documents, strict=True) if documents else ((), (), ())
    tables = {
        "documents": {
            "doc_id": pa.array(ids, pa.int64()),
            "text": pa.array(texts, pa.string()),
            "lang": pa.nulls(len(documents), pa.string()),
            "source": pa.array(sources, pa.string()),
            "n_chars": pa.nulls(len(documents), pa.int64()),
        } | extra,
        "embeddings": {
            "vec_id": pa.array([i for i, _ in embeddings], pa.int64()),
            "embedding": pa.array([v for _, v in embeddings], pa.list_(pa.float32())),
            "label": pa.nulls(len(embeddings), pa.int32()),
            "node": pa.nulls(len(embeddings), pa.int32()),
            "n_links": pa.nulls(len(embeddings), pa.int32()),
        },
        "pages": {
            "page_id": pa.array([i for i, _ in pages], pa.int64()),
            "url": pa.array([u for _, u in pages], pa.string()),
            "html": pa.nulls(len(pages), pa.string()),
            "host": pa.nulls(len(pages), pa.string()),
        },
        "benchmark": {
            "item_id": pa.array([i for i, _ in benchmark], pa.int64()),
            "text": pa.array([t for _, t in benchmark], pa.string()),
            "n_words": pa.nulls(len(benchmark), pa.int32()),
        },
        "labels": {
            "doc_id": pa.array([i for i, _ in labels], pa.int64()),
            "quality": pa.nulls(len(labels), pa.int32()),
            "toxic": pa.array([t for _, t in labels], pa.int32()),
            "text": pa.nulls(len(labels), pa.string()),
            "id": pa.nulls(len(labels), pa.int32()),
        },
        "conversations": {
            "conv_id": pa.array([c for c, *_ in conversations], pa.int64()),
            "turn": pa.array([t for _, t, *_ in conversations], pa.int64()),
            "role": pa.array([r for *_, r, _ in conversations], pa.string()),
            "text": pa.array([x for *_, x in conversations], pa.string()),
            "depth": pa.nulls(len(conversations), pa.int32()),
            "part": pa.nulls(len(conversations), pa.int32()),
            "one": pa.nulls(len(conversations), pa.int32()),
        },
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    return str(folder)


def odd(folder):
    documents = [(i, text, ("a", "b", None)[i % 3]) for i, text in enumerate(TEXTS * 2)]
    documents += [(None, "nobody's text", "a"), (None, None, None), (-1, "one two", "a")]
    documents += [(5, TEXTS[5], "b")] * 3  # repeated as a whole
    nan = float("nan")
    vectors = [
        (0, None), (1, []), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [1.0, 0.0]),
        (6, [2.0, 0.0]), (6, [2.0, 0.0]), (None, [1.0, 0.01]), (7, [1.0, 0.0, 0.0]), (8, [-1.0, 0.0]),
    ]
    pages = [(0, None), (1, ""), (2, "no scheme"), (3, "http://"), (None, "http://a.net/x"), (3, "http://")]
    benchmark = [(0, None), (1, ""), (2, TEXTS[5]), (2, TEXTS[5]), (None, "one two")]
    labels = [(i, i % 2) for i in range(12)] + [(7, 1), (None, 1), (3, None), (99, 1), (4, 5)]
    conversations = [
        (0, 0, "user", "hi"), (0, 1, None, None), (0, None, "a", "x"), (1, 0, "user", "hi"),
        (1, 0, "user", "hi"), (None, 0, "user", "hi"), (7, 3, "", "long " * 50_000), (-3, 0, None, ""),
    ]
    return written(folder, documents, vectors, pages, benchmark, labels, conversations)


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_queries_and_stages_hold_up(spark, tmp_path, rows):
    sf_dir = odd(tmp_path) if rows == "odd" else written(tmp_path, [], [], [], [], [], [])
    counts = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
        for name in ("documents", "embeddings", "pages")
    }
    for name, query in queries.queries().items():
        got = query(spark, sf_dir).collect()
        table = {"op3": "pages", "op5": "embeddings"}.get(name.partition("_")[0], "documents")
        if name.startswith(("op11", "op12")):  # a row per node or word
            assert bool(got) == bool(counts["documents"]), name
        elif name.startswith("op9"):  # rows equal in id and text are one document
            assert len(got) == len({(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()})
        else:
            assert len(got) == counts[table], name
    docs = documents(spark, sf_dir)
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = Counter(r.doc_id for r in docs.collect())
        docs = stored(stage(spark, docs, sf_dir), f"edge-{name}")
        after = Counter(r.doc_id for r in docs.collect())
        assert set(after) <= set(before), name
        assert name == "sharding" or docs.columns == columns
    assert set(docs.columns) == {*columns, *sharding.RESULTS}


def test_operators_that_keep_all_columns_keep_clashing_ones(spark, tmp_path):
    docs = documents(spark, odd(tmp_path))
    for kept in (lines.cleaned(docs), pii.redacted(docs, pii.train(docs))):
        assert kept.columns == docs.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in docs.collect())


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
