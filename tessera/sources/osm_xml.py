"""Map XML: nodes, ways and relations as raw tables, read in parallel by element."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TAG = "array<struct<_k:string,_v:string>>"
_NODE = f"_id bigint, _changeset bigint, _lat double, _lon double, tag {_TAG}"
_WAY = f"_id bigint, _changeset bigint, nd array<struct<_ref:bigint>>, tag {_TAG}"
_RELATION = f"_id bigint, _changeset bigint, member array<struct<_type:string,_ref:bigint,_role:string>>, tag {_TAG}"

ELEMENTS = ("osm", "bounds", "node", "way", "relation", "tag", "nd", "member")


def _read(spark: SparkSession, path: str, element: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", element).schema(schema).load(path)


def _tags():
    none = F.array().cast("array<struct<k:string,v:string>>")
    return F.coalesce(F.transform("tag", lambda t: F.struct(t["_k"].alias("k"), t["_v"].alias("v"))), none).alias("tags")


def nodes(spark: SparkSession, path: str) -> DataFrame:
    rows = _read(spark, path, "node", _NODE)
    return rows.select(F.col("_id").alias("id"), F.col("_changeset").alias("changeset"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), _tags())


def ways(spark: SparkSession, path: str) -> DataFrame:
    """Ways with the ids of their nodes in order. A reference of 0 or none is an error of the file."""
    rows = _read(spark, path, "way", _WAY)
    refs = F.coalesce(F.transform("nd", lambda n: n["_ref"]), F.array().cast("array<bigint>"))
    wrong = F.exists(refs, lambda r: r.isNull() | (r == 0))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("way without a node's id: "), F.col("_id").cast("string")))).otherwise(refs)
    return rows.select(F.col("_id").alias("id"), F.col("_changeset").alias("changeset"), checked.cast("array<bigint>").alias("nds"), _tags())


def relations(spark: SparkSession, path: str) -> DataFrame:
    rows = _read(spark, path, "relation", _RELATION)
    member = F.transform("member", lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role")))
    none = F.array().cast("array<struct<type:string,ref:bigint,role:string>>")
    return rows.select(F.col("_id").alias("id"), F.col("_changeset").alias("changeset"), F.coalesce(member, none).alias("members"), _tags())


def unknown_elements(spark: SparkSession, path: str) -> list[str]:
    """Names of elements that the engine doesn't know. The file is read in parts that end with ">", so that neither
    its lines nor its root need fit a task."""
    parts = spark.read.option("lineSep", ">").text(path)
    name = F.regexp_extract("value", r"^\s*<([A-Za-z_][\w.:-]*)", 1)
    return sorted(r["name"] for r in parts.select(name.alias("name")).filter(~F.col("name").isin("", *ELEMENTS)).distinct().collect())
