"""A training corpus from raw documents: quality, near copies, benchmark passages, personal data, packed sequences.

Every stage takes what the one before kept, read from Parquet, and all but the last return the columns of
``documents``.  No SQL can express the stages' models and tokenizer, so ``ORACLE_SQL`` is None; the tests hold every
stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm import decontamination, packing, pii, quality, set_join
from verdant.llm.queries import quality_model, table, tokenizer
from verdant.session import scratch_path

#: Near copies: words of a shingle, least Jaccard similarity in per cent (the query op10 has 4 and 85, its contract's).
NEAR_WORDS, NEAR_PERCENT = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled rows outside the held-out fold, accepts."""
    return quality.keep_good(docs, quality_model(spark, sf_dir))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near copies: 5-word shingles, Jaccard 0.80 or more."""
    return set_join.keep_one(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of at most 2048 ids."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality", keep_good),
    ("near_copies", keep_one_of_each_group),
    ("decontamination", remove_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "corpus_pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
