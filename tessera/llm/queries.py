"""The registered queries: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import language_id, merkle, mixing, ngram_join, ogg, packing, pii, quality, sql, token_counts, toxicity
from .common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edits(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.read_back(ogg.store(table(spark, sf_dir, "documents")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_per_document(*mixing.plan(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_merkle": op2_merkle,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_language_id": op5_language_id,
    "op6_ngram_join": op6_ngram_join,
    "op7_toxicity": op7_toxicity,
    "op8_ogg": op8_ogg,
    "op9_pii": op9_pii,
    "op10_mixing": op10_mixing,
}

#: The others have no form in SQL: trained models, tokenizers, files, and draws by hash. Tests hold them against
#: plain versions, round trips and held-out rows.
ORACLE_SQL: dict[str, str] = {"op2_merkle": sql.MERKLE, "op6_ngram_join": sql.NGRAM_JOIN}
