"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import archives, licenses, oracles
from tidewell.llm.common import table
from tidewell.llm.decontaminate import contamination
from tidewell.llm.language_model import score_documents
from tidewell.llm.mixing import mix_sources
from tidewell.llm.near_duplicates import components
from tidewell.llm.neighbours import search
from tidewell.llm.quality import score_quality
from tidewell.llm.shards import pack_shards
from tidewell.llm.tokens import over_limit


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies on this machine and the workers'."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_shards(table(spark, sf_dir, "documents"), shards=16)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.round_trip(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_limit(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_lm_scores": op2_lm_scores,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_sharding": op4_sharding,
    "op5_decontamination": op5_decontamination,
    "op6_warc": op6_warc,
    "op7_token_counts": op7_token_counts,
    "op8_mix_sources": op8_mix_sources,
    "op9_licenses": op9_licenses,
    "op10_neighbours": op10_neighbours,
}

ORACLE_SQL: dict[str, str] = {
    "op3_near_duplicates": oracles.NEAR_DUPLICATES,
    "op5_decontamination": oracles.CONTAMINATION,
    "op6_warc": archives.ORACLE_SQL,
    "op9_licenses": licenses.oracle(),
}
