"""The corpus pipeline: documents in, token ids of clean, distinct documents out.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet in the shared folder and read again as the next one's ``docs``.  All
but the last return the columns of ``documents``.  Rows keep their nulls:
a null text counts as empty, and the quality rules reject it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from titleflow.llm.common import free_name, materialise, table
from titleflow.llm.queries import BPE_FILE


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_docs(docs)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; ``n_chars`` is that of the text that is left."""
    counts = free_name(docs.columns, "_n_lines"), free_name(docs.columns, "_n_dropped")
    kept = line_dedup.dedup_lines(docs, min_docs=10, counts=counts).drop(*counts)
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the smallest id."""
    return simhash.drop_near_duplicates(docs, width=4, max_bits=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    found = free_name(docs.columns, "_leaks")
    return decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"), found=found).where(F.size(found) == 0).drop(found)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    source = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    done = bpe.encode_decode(source, BPE_FILE, ["doc_id", "lang", "source", "text_sha256"])
    same = F.sha2(F.col("decoded").cast("binary"), 256) == F.col("text_sha256")
    return done.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "text_sha256", same.alias("decodes"))


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("bpe", encode),
]

#: SQL has neither the shingle hashes nor the tokenizer; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
