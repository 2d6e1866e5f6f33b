"""Boundary XML: placemarks of folders, and their polygons' rings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RING = "struct<LinearRing:struct<coordinates:string>>"
_POLYGON = f"struct<outerBoundaryIs:array<{_RING}>,innerBoundaryIs:array<{_RING}>>"
_SIMPLE = "struct<_name:string,_VALUE:string>"
_PLACEMARK = (
    f"struct<name:string,ExtendedData:struct<SchemaData:array<struct<SimpleData:array<{_SIMPLE}>>>>,"
    f"Polygon:array<{_POLYGON}>,MultiGeometry:struct<Polygon:array<{_POLYGON}>>>"
)
_FOLDER = f"name string, Placemark array<{_PLACEMARK}>"


def placemarks(spark: SparkSession, path: str) -> DataFrame:
    """A row a placemark: folder, place in it, name, simple data (name, value), and rings in order.

    Placemarks outside a folder are ignored, as are all other elements."""
    folders = spark.read.format("xml").option("rowTag", "Folder").schema(_FOLDER).load(path)
    rows = folders.withColumn("folder_id", F.monotonically_increasing_id()).select(
        "folder_id", F.col("name").alias("folder"), F.posexplode("Placemark").alias("placemark_pos", "p")
    )
    none = F.array().cast(f"array<{_POLYGON}>")
    polygons = F.concat(F.coalesce("p.Polygon", none), F.coalesce("p.MultiGeometry.Polygon", none))

    def rings(polygon, part: str, inner: bool):
        empty = F.array().cast(f"array<{_RING}>")
        return F.transform(F.coalesce(polygon[part], empty), lambda r: F.struct(F.lit(inner).alias("is_inner"), r["LinearRing"]["coordinates"].alias("coordinates")))

    both = F.flatten(F.transform(polygons, lambda q: F.concat(rings(q, "outerBoundaryIs", False), rings(q, "innerBoundaryIs", True))))
    simple = F.transform(F.flatten("p.ExtendedData.SchemaData.SimpleData"), lambda s: F.struct(s["_name"].alias("name"), s["_VALUE"].alias("value")))
    no_data = F.array().cast("array<struct<name:string,value:string>>")
    return rows.select("folder_id", "folder", "placemark_pos", F.col("p.name").alias("name"), F.coalesce(simple, no_data).alias("simple"), both.alias("rings"))


def coordinates(text):
    """"lon,lat[,alt] lon,lat[,alt] ..." as an array of (lon, lat); any white space separates."""
    tokens = F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda t: t != "")
    pair = F.transform(tokens, lambda t: F.split(t, ","))
    return F.transform(
        F.filter(pair, lambda p: F.size(p).between(2, 3)),
        lambda p: F.struct(F.get(p, 0).cast("double").alias("lon"), F.get(p, 1).cast("double").alias("lat")),
    )
