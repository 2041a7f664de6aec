"""From raw documents to token ids: quality, exact copies, near copies, benchmark passages, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``. Stages work on all rows they are given; null texts are
empty, and empty tables go through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarweave.llm import bpe, quality, quotient, templates, weighted_minhash
from tarweave.session import ship_package, stage

#: SQL cannot express the quality model; the stages are tested against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a quality of the threshold or more, by a model fitted on the labels of these documents."""
    ship_package(spark)
    field = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(F.col("text"), field) >= quality.THRESHOLD)


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return quotient.drop_exact_copies(docs)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest id."""
    return weighted_minhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return templates.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids, round_trip``: byte-level BPE ids, and whether they decode to the text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ship_package(spark)
    found = docs.withColumn("t", bpe.round_trip(F.col("text"), path, public_tokenizers.PATTERN))
    same = F.col("t.raw") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return found.select("doc_id", "source", "lang", F.size("t.ids").cast("long").alias("n_tokens"), "t.ids", same.alias("round_trip"))


STAGES = [
    ("quality", good_quality),
    ("exact", one_of_equal),
    ("near", one_of_near),
    ("benchmark", without_benchmark),
    ("tokens", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
