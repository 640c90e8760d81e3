"""A corpus cleaned in five stages, each written as Parquet before the next one reads it.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before kept. All but the last return
the columns of ``documents``. Nulls, empty texts, ties and repeated rows follow the operators' docstrings; an
empty table passes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.llm import bpe, decontam, minhash, quality, toxicity
from batchloom.llm.common import table
from batchloom.storage import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits are cut from the others."""
    return quality.kept_documents(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go."""
    model = toxicity.fit_labels(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn("__severity", toxicity.severity(F.col("text"), model))
    return scored.where("NOT __severity.toxic").drop("__severity")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at five-word shingle similarity 0.8, the one with the least id stays."""
    return minhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as token ids, with their number and whether they decode to the text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.encode_and_decode(docs, path)
    return both.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
        "ids",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Toxicity is a trained model and fingerprints need XXH64, so SQL can't express the pipeline; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
