"""The table store: a Parquet folder for each of the engine's tables.

Object tables are sorted by id within files, so a look-up by id reads few row groups; tile references are
partitioned by kind and zoom, so a tile's query prunes to one folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TABLES
from .scratch import scratch_path

KEYS = {"node_coord": "nid", "node_info": "nid", "way_info": "wid", "way_range": "wid", "way_nds": "wid", "rel_info": "rid", "rel_members": "rid", "rel_range": "rid"}


class Store(Mapping[str, DataFrame]):
    """The engine's tables by name: frames at hand, or a folder's tables."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None, path: str | None = None):
        self.spark, self.tables, self.path = spark, dict(tables or {}), path

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        if name not in self.tables:
            self.tables[name] = (
                self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{name}") if self.path else self.spark.createDataFrame([], TABLES[name])
            )
        return self.tables[name]

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def changeset(self) -> int:
        """The greatest changeset that was imported; a store without one can't be queried."""
        row = self["attr"].filter(F.col("key") == "changeset").agg(F.max(F.col("val").cast("long"))).first()
        if row is None or not row[0]:
            raise ValueError("the store has no changeset")
        return row[0]

    def get(self, name: str, id_: int | None = None, default=None):  # noqa: D102
        """A table, or with an id the rows of that id."""
        if name not in TABLES:
            return default
        return self[name] if id_ is None else self[name].filter(F.col(KEYS[name]) == id_)

    def write(self, path: str, mode: str = "errorifexists") -> Store:
        """All tables to a folder. ``mode``: "errorifexists" or "overwrite" to create, "append" to add."""
        for name in TABLES:
            df = self[name]
            if name == "tile_ref":
                df.repartition("kind", "zoom", F.expr("x div 64"), F.expr("y div 64")).sortWithinPartitions("x", "y", "ref").write.mode(mode).partitionBy("kind", "zoom").parquet(
                    f"{path}/{name}"
                )
            else:
                (df.sortWithinPartitions(KEYS[name]) if name in KEYS else df).write.mode(mode).parquet(f"{path}/{name}")
        return Store(self.spark, path=path)

    def settled(self) -> Store:
        """The same tables, written to the shared scratch folder: derived ones are computed once."""
        return self.write(scratch_path(self.spark, "store"))

    def union(self, other: Store) -> Store:
        """Both stores' rows."""
        return Store(self.spark, {n: self[n].unionByName(other[n]) for n in TABLES})


def open_store(spark: SparkSession, path: str) -> Store:
    return Store(spark, path=path)


def last_write_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the one with the greatest ``order``."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))
