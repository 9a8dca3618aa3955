"""A training corpus from raw documents: quality, near copies, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of documents; the last returns ids.  `run` writes every stage's rows to the shared folder
before the next one reads them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.llm import bytebpe, decontaminate, lshforest, passages, quality
from topicflow.llm.common import Scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return lshforest.drop_copies(docs, Scratch(spark, "stage-near"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of fifty words that an earlier document has are cut out; n_chars follows the text."""
    done = passages.cut_passages(docs, Scratch(spark, "stage-passages"))
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated with benchmark items go."""
    return decontaminate.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"), "text")
    tokens = bytebpe.encode(rows, ranks, pattern, keep=["doc_id", "lang", "source", "text_sha256"])
    back = bytebpe.decode(tokens, ranks, pattern)
    return back.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.coalesce(F.sha2("decoded", 256) == F.col("text_sha256"), F.octet_length("decoded") == 0).alias("round_trip"), "ids",
    )


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", to_tokens),
]
# The classifier is fitted, and the ids come from merges: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = folder.save(name, stage(spark, docs, sf_dir))
        if i:
            folder.drop(STAGES[i - 1][0])
    return docs
