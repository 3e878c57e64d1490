"""A corpus pipeline: quality classifier, n-gram Jaccard join, benchmark decontamination, source mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; a stage's result is written and read
again before the next.  The stages aren't SQL-expressible, so there is no ORACLE_SQL; tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.common import stash, table
from tidewell.llm.decontaminate import clean_documents
from tidewell.llm.mixing import mixed_documents
from tidewell.llm.near_duplicates import one_of_each_class
from tidewell.llm.quality import good_documents
from tidewell.llm.shards import pack_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of those that are here, doesn't reject."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near duplicates."""
    return one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of benchmark text: a passage in a long document is a leak, too."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"), share=None)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document."""
    return pack_shards(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
