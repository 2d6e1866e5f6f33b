"""What the text operators share: reading tables, batches that fit a worker, and bounded hash samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import discard, written  # noqa: F401  the operators cut lineage with them

#: Rows and bytes in one Arrow batch handed to Python. They bound a worker's memory whatever the table's size.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20

#: Unsigned range of the hash that samples rows.
_HASH_SPAN = 1 << 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand Python at most BATCH_ROWS rows and about BATCH_BYTES bytes at a time, so that a batch of long texts fits a
    worker. Spark reads these settings when a result is computed, so they are the session's; smaller ones stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int("".join(c for c in spark.conf.get(key) if c.isdigit() or c == "-") or 0)
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def hash_below(column: Column, fraction: float, seed: str, otherwise: Column | None = None) -> Column:
    """True for about ``fraction`` of the distinct values of ``column``, the same ones on every run. A null goes by
    the value of ``otherwise``; without that it is never taken, since all nulls would be taken at once."""
    limit = max(0, min(_HASH_SPAN, round(fraction * _HASH_SPAN)))
    name = column.cast("string")
    below = lambda c, s: F.pmod(F.xxhash64(c, F.lit(s)), F.lit(_HASH_SPAN)) < F.lit(limit)
    return F.when(name.isNotNull(), below(name, seed)).otherwise(F.lit(False) if otherwise is None else F.coalesce(below(otherwise, seed + " of others"), F.lit(False)))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that the table doesn't have (names differ by more than case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def same_row(df: DataFrame) -> Column:
    """A hash of all of a row's columns, to choose among rows that repeat a key."""
    return F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
