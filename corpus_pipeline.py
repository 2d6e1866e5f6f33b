"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it has kept; its result is written as
Parquet and read again as the next one's ``docs``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import language_id, mixing, ngram_join, packing, pii
from tessera.llm.common import table, written
from tessera.llm.queries import vocabulary


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` says again how long the text is."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't accepted go."""
    return language_id.keep_accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts are replaced by their kind."""
    return _sized(pii.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often, and with as much of their text, as the mix takes them."""
    return _sized(mixing.mixed_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, by sequence and offset."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", redact_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs


#: Language ID, the field and byte-pair encoding have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None
