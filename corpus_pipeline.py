"""A training-data pipeline over ``documents``: five stages, each one operator of the subpackage llm.

Each stage's result is written as Parquet and read back as the next one's input. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bag_minhash, decontaminate, exact_dedup, quality
from tidemark.llm.common import written
from tidemark.llm.queries import packed
from tidemark.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go (score under 0.5)."""
    return quality.keep_good(docs, quality.learn(docs, read_table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space, the owner stays."""
    return exact_dedup.keep_owners(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, one document stays."""
    return bag_minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; n_chars follows."""
    return decontaminate.remove_spans(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # tokens and signatures are beyond SQL; tests/llm holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
