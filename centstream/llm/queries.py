"""The numbered operators and the pipeline as queries over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centstream.llm import (
    conversations, decontaminate, embeddings, licenses, lines, mixing, oracles, pii, scoring, sharding, simhash,
    spelling, toxicity, urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = decontaminate.scan(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return decontaminate.digest(scanned).drop("longest")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), F.array("source"))


#: The rules of the contract.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.judge(_table(spark, sf_dir, "pages"), rules)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(_table(spark, sf_dir, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assignment(_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.train(docs))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the lines that go are comma-joined."""
    found = lines.report(_table(spark, sf_dir, "documents"))
    numbers = F.col("removed").cast("array<string>")
    return found.withColumn("removed", F.array_join(numbers, ","))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.trie(*conversations.rebuilt(_table(spark, sf_dir, "conversations")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(_table(spark, sf_dir, "documents")))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_source_mixing": op2_source_mixing,
    "op3_url_filter": op3_url_filter,
    "op4_simhash": op4_simhash,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_sharding": op7_sharding,
    "op8_pii": op8_pii,
    "op9_line_dedup": op9_line_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lm_scoring": op13_lm_scoring,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracles.sql()
