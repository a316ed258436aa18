"""The corpus pipeline: quality, near duplicates, contamination, personal data, packing.

Each stage works on all rows the one before it kept, has its input as ``docs`` and writes nothing
that a later stage needs. Deciding stages drop rows whole, each by its own text; the personal-data stage changes
texts; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.llm import decontaminate, ngram_join, packing, pseudonyms, quality
from roadledger.llm.common import table, written
from roadledger.llm.queries import SAMPLE_KEY

SECRET = "spark.roadledger.pseudonym.secret"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.keep_good(spark, docs, sf_dir)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return ngram_join.keep_one(spark, docs, sf_dir)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.keep_clean(spark, docs, sf_dir)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms under the key that the session has in
    ``SECRET`` (a name that Spark hides in its pages and logs). The key of the sample tables is public: it
    serves where none is set, for tests and samples only."""
    hidden = pseudonyms.pseudonymize(docs, spark.conf.get(SECRET, SAMPLE_KEY))
    return hidden.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), checksums=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", personal_data_stage),
    ("packing", packing_stage),
]

# No SQL: the stages fit a model, permute under a key and tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
