"""A training corpus from raw documents: each stage reads what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.llm import bpe_codec, exact_dedup, near_dedup, quality_classifier, source_mix
from lossgrid.session import materialise

VOCABULARY = "byte_bpe_50k.tiktoken"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects."""
    return quality_classifier.drop_poor(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return source_mix.draw(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to its bytes again.

    The id column carries along what the result needs of a row; rows repeated by the mix stay repeated.
    """
    path = public_tokenizers.path(VOCABULARY)
    keyed = docs.select(F.struct("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")).alias("doc_id"), "text")
    decoded = bpe_codec.round_trip(keyed, path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id.doc_id",
        "doc_id.source",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        (F.sha2("decoded", 256) == F.col("doc_id.sha")).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", no_exact_copies),
    ("near dedup", no_near_copies),
    ("source mix", mixed_sources),
    ("byte bpe", token_ids),
]
#: The first stage is trained, and SQL has no functions for the others' texts; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; what each stage kept is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
