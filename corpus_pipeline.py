"""Corpus pipeline: documents in, token ids out.

Quality classifier (rejected documents go), SimHash near-duplicates (one document of each
group stays), benchmark decontamination (documents with a benchmark passage go), personal
data (replaced by its kind), BPE encoding. Each stage's result is written as Parquet to
the shared folder of `spark.checkpoint.dir` and read again as the next one's documents.

A stage takes (spark, docs, sf_dir); all but the last return the columns of `docs`.
Edge cases are those of the operators; empty tables pass through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, pii, quality, simhash
from tidemark.llm.common import table
from tidemark.session import ensure_checkpoint_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from `labels`, accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of `benchmark`."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose personal data is replaced by its kind."""
    shared = pii.shared_tagger(docs)
    masked = docs.withColumn("text", pii.redacted(F.col("text"), shared))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded again."""
    shared = bpe.share(spark, bpe.public_tokenizer())
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return (docs.select(*kept, bpe.digest(F.col("text"), shared, with_ids=True).alias("e"))
            .select(*kept, "e.*"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

ORACLE_SQL = None  # models and tokenizers are beyond SQL; tests/llm holds a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last one's rows."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
