"""The corpus pipeline: stages over the documents table, each written and read by the next.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep
the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statweave.llm import decontaminate, near_dedup, packing, secrets, toxicity
from statweave.plans.staging import ensure_checkpoint_dir, freeing_tables
from statweave.sources.tables import table


def remove_toxic_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that score as toxic; the model learns from the labelled ones."""
    return toxicity.remove_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class: five-word shingles, similarity 0.8 or more."""
    return near_dedup.near_dedup(docs, words=5, percent=80)


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove every document that holds a ten-word window of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the text; every document stays, ``n_chars`` follows the text."""
    masked = secrets.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all kept documents in length buckets and token-budget batches."""
    return packing.packed(packing.token_lengths(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", remove_toxic_text),
    ("near duplicates", keep_one_of_each),
    ("benchmark decontamination", remove_benchmark_text),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # the stages learn models and cluster texts, which SQL cannot express


def written(docs: DataFrame) -> DataFrame:
    """``docs`` as a table of its own, which no enclosing ``freeing_tables`` removes."""
    path = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/documents-{uuid.uuid4().hex}"
    docs.write.parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again.

    What a stage staged for itself is removed when its rows are written.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with freeing_tables(spark):
            docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
