"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of
``docs``. A stage's result is written as parquet and read back as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mendwork.llm import language, mixing, near_dedup, packing, secrets
from mendwork.llm.common import is_fold
from mendwork.llm.queries import EPOCHS, SEED, WEIGHTS
from mendwork.session import materialise


# Likeness in per cent from which documents are near-duplicates, and bands that miss 4 in 10,000 pairs at it.
NEAR_PERCENT = 80
NEAR_BANDS = 12


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language."""
    return language.keep_recognised(docs, language.fit(docs.where(~is_fold("doc_id", 4, 2))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return near_dedup.deduplicate(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets; every document stays."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's share of as many tokens as there are; documents of a second epoch repeat."""
    return mixing.mix(docs, weights=WEIGHTS, max_epochs=EPOCHS, seed=SEED).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("packing", pack),
]

# The tokenizer, the classifiers' fits and MinHash have no SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
