"""The corpus pipeline: documents to clean, distinct, tokenised training text.

Each stage is a function of (spark, docs, sf_dir) that calls one operator of
``strata.llm``; its result is written as Parquet and read again as the next
stage's documents, so every stage starts from a table and a lost executor repeats
work of its own stage only.  All stages but the last return the columns of
``documents``; the last returns each kept document's token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from strata.llm.queries import severity_grade, table, tokenizer_path
from strata.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model doesn't reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), severity_grade()))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents chained by 0.8 similar five-word shingle sets, the one with the smallest id."""
    return jaccard_join.drop_near_duplicates(docs, n=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and digests of ids and decoded text."""
    out = bpe.encode_decode(docs, tokenizer_path())
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

ORACLE_SQL = None  # trained weights and tokenizers are beyond SQL; tests/llm checks every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
