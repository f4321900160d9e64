"""From raw documents to packed training sequences.

Each stage works on all that the one before kept and returns the columns of documents; the last
returns the packed pieces with their ids. ``run`` writes each stage's result to the shared scratch
folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkgate.llm import mixing, neardup_texts, packing, quality, substrings
from chunkgate.llm.carried import carry, unpack
from chunkgate.llm.catalog import BYTE_END, BYTE_VOCABULARY
from chunkgate.session import scratch_dir


#: Columns that stages read; whatever others a table has, with whatever names, goes through them unchanged (but n_chars, which follows the text).
READ = ("doc_id", "text", "source")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees, which are grown on the labelled among ``docs``."""
    trees = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge_quality(carry(docs, READ), trees).where("kept").select(unpack(docs.columns, READ))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return neardup_texts.deduplicated(carry(docs, READ)).select(unpack(docs.columns, READ))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller doc_id has too; those of which nothing is left go."""
    out = substrings.remove_repeats(carry(docs, READ)).where("n_words > n_removed").select(unpack(docs.columns, READ))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their ids."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path(BYTE_VOCABULARY), BYTE_END, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed", packed),
]
#: Trees, samples and tokenizers have no SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
