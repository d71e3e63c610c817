"""The corpus pipeline: toxic documents go, then near-copies, then benchmark passages;
what is left is mixed to target weights and put into shards.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept.
All but the last return the columns of documents. A document that the mix repeats is
two rows. The stages' parameters are the production ones of their operators: near-copies
are documents whose fingerprints of three-word shingles are linked at two bits or fewer.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centstream.llm import decontaminate, mixing, sharding, simhash, toxicity
from centstream.llm.store import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, F.array("source"))


def put_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assigned(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", put_into_shards),
]

#: Training, fingerprints and hashes of the stages are beyond SQL; tests compare with
#: plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
