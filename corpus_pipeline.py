"""From documents to a training mix: five operators, one after the other.

Every stage gets what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill.llm import decontamination, mixing, pii, quality, set_join
from topicmill.llm.common import table
from topicmill.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject."""
    return quality.keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles: the one with the least id."""
    return set_join.keep_one(docs.select(*COLUMNS))


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind."""
    found = pii.find_pii(docs.select(*COLUMNS), masked=True)
    length = F.length("masked").cast(docs.schema["n_chars"].dataType)
    return found.select("doc_id", F.col("masked").alias("text"), "lang", "source", length.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how many of their words it takes."""
    mixed = mixing.mix(docs.select(*COLUMNS)).where("taken > 0")
    return mixed.select(*COLUMNS, "size", "source_size", "target", "whole", "taken")


STAGES = [
    ("quality classifier", keep_good_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_text),
    ("personal data", mask_personal_data),
    ("mixing sources", mix_sources),
]

# A trained classifier is no SQL; tests/llm/test_pipeline.py holds the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
