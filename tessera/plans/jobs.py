"""Jobs that read sources, run operators and write results."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import REGIONS, Classes
from ..functions import geo
from ..operators import boundaries, encode, ingest, tiler
from ..sources import kml, osm_xml
from ..sources.scratch import discard, written
from ..sources.store import Store, open_store
from ..style import Style


def import_osm(spark: SparkSession, style_path: str, map_path: str, out: str, mode: str = "errorifexists", classes: Classes | None = None, compat: bool = False, strict: bool = True) -> Store:
    """A new store from a map file. A file with unknown elements is refused unless ``strict`` is off."""
    if strict and (unknown := osm_xml.unknown_elements(spark, map_path)):
        raise ValueError(f"unknown elements: {unknown}")
    style = Style.read(spark, style_path)
    tables = ingest.import_map(osm_xml.nodes(spark, map_path), osm_xml.ways(spark, map_path), osm_xml.relations(spark, map_path), style, classes, compat)
    return Store(spark, tables).write(out, mode)


def import_kml(spark: SparkSession, style_path: str, store_path: str, files: list[str], classes: Classes | None = None) -> Store:
    """Boundary files added to a store; ids go on below the store's least ones."""
    style, store = Style.read(spark, style_path), open_store(spark, store_path)
    for path in files:
        low = lambda table, key: min(boundaries.FIRST_ID + 1, store[table].agg(F.min(key)).first()[0] or 0) - 1
        tables = boundaries.import_boundaries(kml.placemarks(spark, path), style, classes, low("node_coord", "nid"), low("way_info", "wid"))
        # Computed as a whole first: what is appended to the live store is copied.
        Store(spark, tables).settled().write(store_path, "append")
        store = open_store(spark, store_path)
    return store


def serve(store: Store, request: str) -> DataFrame:
    """The tile that a request "/name/zoom/x/y" asks for; any zoom is served from the stored one above it."""
    spark = store.spark
    asked = spark.createDataFrame([(request,)], "request string").select(geo.parse_request(F.col("request")).alias("t")).first().t
    if asked is None:
        raise ValueError(f"not a request: {request!r}")
    t = spark.createDataFrame([asked], "zoom int, x int, y int").select(geo.stored_tile(F.col("zoom"), F.col("x"), F.col("y")).alias("t")).first().t
    return tiler.make_tile(store, t.zoom, t.x, t.y)


def region_tiles(store: Store, region: str | tuple[float, float, float, float] = "WW") -> DataFrame:
    """The populated tiles of a region."""
    found = store["tile_ref"].select(*tiler.KEY).distinct()
    box = REGIONS[region] if isinstance(region, str) else region
    if box == REGIONS["WW"]:
        return found
    return found.filter(geo.overlaps(F.col("zoom"), F.col("x"), F.col("y"), box))


def region_estimate(spark: SparkSession, region: str | tuple[float, float, float, float]) -> DataFrame:
    """Tiles of a region by zoom, from its corners alone."""
    latT, lonL, latB, lonR = REGIONS[region] if isinstance(region, str) else region
    zooms = spark.createDataFrame([(z,) for z in sorted(ingest.S.ZOOMS)], "zoom int")
    z = F.col("zoom")
    edge = lambda f, v: f(F.lit(v), z).cast("long")
    wide, high = edge(geo.tile_x, lonR) - edge(geo.tile_x, lonL), edge(geo.tile_y, latB) - edge(geo.tile_y, latT)
    return zooms.select("zoom", (wide * high).alias("tiles"))


def region_grid(spark: SparkSession, region: str | tuple[float, float, float, float]) -> DataFrame:
    """All tiles of a region, populated or not: unfolded by zoom, row and cell, over the whole cluster."""
    latT, lonL, latB, lonR = REGIONS[region] if isinstance(region, str) else region
    north = math.degrees(math.atan(math.sinh(math.pi)))  # where the map ends
    corner = {"latT": min(latT, north), "lonL": lonL, "latB": max(latB, -north), "lonR": lonR}
    zooms = spark.createDataFrame([(z,) for z in sorted(ingest.S.ZOOMS)], "zoom int")
    last = F.pow(F.lit(2.0), F.col("zoom")).cast("int") - 1
    edge = lambda f, c: F.least(F.greatest(f(F.lit(corner[c]), F.col("zoom")).cast("int"), F.lit(0)), last)
    rows = zooms.select("zoom", edge(geo.tile_x, "lonL").alias("x0"), edge(geo.tile_x, "lonR").alias("x1"), F.explode(F.sequence(edge(geo.tile_y, "latT"), edge(geo.tile_y, "latB"))).alias("y"))
    return rows.repartition("zoom", "y").select("zoom", F.explode(F.sequence("x0", "x1")).alias("x"), "y")


def prefetch(store: Store, out: str, region: str | tuple[float, float, float, float] = "WW", mode: str = "errorifexists", empty: bool = False) -> DataFrame:
    """The tiles of a region, encoded and written as one batch: the populated ones, or with ``empty`` all. Tiles that
    can't be encoded don't stop the others: ``failed`` beside them says which, and why. Gives the cache's
    attributes."""
    wanted = region_grid(store.spark, region) if empty else region_tiles(store, region)
    tiles = tiler.make_tiles(store, wanted, empty)
    coded = written(encode.encode_tiles(tiles, keep_failed=True), "tiles")
    encode.write_blobs(coded.filter("error is null").drop("error"), f"{out}/tiles", mode)
    coded.filter("error is not null").select(*tiler.KEY, "error").write.mode(mode).parquet(f"{out}/failed")
    discard(coded)
    box = REGIONS[region] if isinstance(region, str) else region
    attrs = {"name": "tessera", "pattern": "zoom/x/y", "ext": "bin", "bounds": " ".join(map(str, box)), "zmin": "3", "zmax": "15", "changeset": str(store.changeset())}
    frame = store.spark.createDataFrame(list(attrs.items()), "key string, val string")
    frame.write.mode(mode).parquet(f"{out}/attr")
    return frame
