"""The pipeline's stages on the small tables, each judged on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
from centstream.llm import decontaminate, oracles, queries, simhash, toxicity
from centstream.llm.store import stored
from checks.compare import canonical, oracle_rows


def test_stages_do_what_their_operators_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{sf_dir}/labels.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    made = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        made[name] = (before, docs)
        assert name == "sharding" or docs.columns == columns

    before, after = made["toxicity"]
    scores = toxicity.scored(before, toxicity.train(before, labels)).collect()
    assert ids(after) == Counter(r.doc_id for r in scores if not r.predicted)
    before, after = made["simhash"]
    groups = simhash.groups(before).collect()
    assert ids(after) == Counter({r.component_id for r in groups})
    before, after = made["decontamination"]
    found = decontaminate.digest(decontaminate.scan(before, benchmark)).collect()
    assert ids(after) == Counter(r.doc_id for r in found if not r.contaminated)
    before, after = made["mixing"]
    assert set(ids(after)) <= set(ids(before)) and max(ids(after).values()) <= 2
    before, after = made["sharding"]
    assert ids(before) == ids(after)
    slots = Counter((r.shard, r.slot) for r in after.select("shard", "slot").collect())
    assert max(slots.values()) == 1


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_queries_with_sql_give_its_rows(spark, sf_dir):
    for name, statement in oracles.sql().items():
        frame = queries.queries()[name](spark, sf_dir)
        got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
        want = canonical(*oracle_rows(sf_dir, statement))
        assert repr(got) == repr(want), name


def test_every_operator_is_registered():
    names = sorted(int(name[2:].partition("_")[0]) for name in queries.queries())
    assert names == list(range(1, 14))
