"""From boundary placemarks to the store's tables: rings as ways of shared nodes, and a label for each placemark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dims import Classes
from ..sources.kml import coordinates
from ..style import NEVER, Style
from . import ingest

#: Nodes of a ring's segment at most; neighbouring segments share a node.
SEGMENT = 64
#: The first id given out; ids go down from it.
FIRST_ID = -2

# Folders and designations that name a class.
FOLDERS = {"cb_2018_us_state_500k": "boundary:state"}
DESIGNATIONS = {
    "wilderness": "core:wilderness",
    "special management area": "core:special",
    "mineral withdrawal": "core:mineral",
    "national recreation area": "core:recreation",
    "national historic landscape": "core:historic",
    "coal mine methane capture areas": "core:coal_methane",
    "proposed wilderness": "rec:wilderness",
    "proposed special management a*": "rec:special",
    "proposed mineral withdrawal a*": "rec:mineral",
}
#: Parts of the names of the simple data that hold a designation.
DESIGNATING = ("Designatio", "PROPOSAL")


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def class_name(folder: Column, simple: Column) -> Column:
    """A placemark's class: its folder's, or else the first known designation's; null without one."""
    said = F.filter(simple, lambda s: s["name"].contains(DESIGNATING[0]) | s["name"].contains(DESIGNATING[1]))
    known = F.filter(F.transform(said, lambda s: _lookup(DESIGNATIONS, F.lower(s["value"]))), lambda c: c.isNotNull())
    return F.coalesce(_lookup(FOLDERS, folder), F.get(known, 0))


def split_ring(nodes: Column, size: int = SEGMENT) -> Column:
    """A ring cut into segments of ``size`` nodes, each beginning with the last of the one before."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(nodes), F.lit(1)), F.lit(size - 1))
    return F.when(F.size(nodes) > 0, F.transform(starts, lambda s: F.slice(nodes, s, size))).otherwise(F.array())


def numbered(df: DataFrame, group: str, order: list[str], first: int, name: str) -> DataFrame:
    """Ids going down from ``first``: by group, and within it by ``order``. Only a row a group is ordered as a
    whole; rows are ordered within their groups."""
    sizes = df.groupBy(group).agg(F.count("*").alias("__n"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select(group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy(group).orderBy(*order)
    return df.join(ahead, group).withColumn(name, F.lit(first).cast("long") - F.col("__ahead") - F.row_number().over(inside) + 1).drop("__ahead")


def bucket(zoom: Column) -> Column:
    """The stored zoom from which a line of this zoom is drawn."""
    return F.when(zoom >= 15, 15).otherwise(zoom - (zoom % 2 == 0).cast("int"))


def shared_nodes(points: DataFrame, first: int = FIRST_ID) -> tuple[DataFrame, DataFrame]:
    """Points (bucket, lat, lon) with the id of their node, and the nodes: one for each bucket and position."""
    place = ["bucket", "lat", "lon"]
    spots = points.select(*place).distinct().withColumn("group", F.pmod(F.xxhash64(*place), F.lit(4096)))
    spots = numbered(spots, "group", place, first, "nid").drop("group")
    return points.join(spots, place), spots


def import_boundaries(placemarks: DataFrame, style: Style, classes: Classes | None = None, first_nid: int = FIRST_ID, first_wid: int = FIRST_ID) -> dict[str, DataFrame]:
    """The tables' rows for placemarks (``sources.kml``). To add to a store, give ids below its least ones."""
    classes = classes or Classes(style.classes)
    spark = placemarks.sparkSession
    styled = F.broadcast(ingest.styled_classes(spark, style, classes))
    known = spark.createDataFrame([(n, c) for n, c in classes.codes.items()], "class_name string, class int")
    lines = {n: style.lines[c["line"]]["min_zoom"] for n, c in style.classes.items() if c["line"]}
    too_low = sorted(n for n in lines if lines[n] < 3 and n in {*FOLDERS.values(), *DESIGNATIONS.values()})
    if too_low:
        raise ValueError(f"boundary classes drawn below zoom 3: {too_low}")
    line_zoom = spark.createDataFrame(list(lines.items()), "class_name string, line_zoom int")
    p = placemarks.withColumn("class_name", class_name(F.col("folder"), F.col("simple"))).join(F.broadcast(known), "class_name").join(styled, "class").join(F.broadcast(line_zoom), "class_name", "left")
    p = p.withColumn("place", F.struct("folder_id", "placemark_pos"))
    rings = p.select("place", "class", "line", "line_zoom", "folder", "name", F.posexplode("rings").alias("ring", "r"))
    rings = rings.withColumn("pts", coordinates(F.col("r.coordinates"))).filter(F.size("pts") > 0)
    segments = rings.select("place", "ring", "class", "line", "line_zoom", "folder", "name", F.posexplode(split_ring(F.col("pts"))).alias("seg", "pts")).filter(F.size("pts") > 0)
    segments = numbered(segments, "place", ["ring", "seg"], first_wid, "wid").filter("line")
    points = segments.select("wid", bucket(F.col("line_zoom")).alias("bucket"), F.posexplode("pts").alias("pos", "q"))
    points = points.select("wid", "bucket", "pos", F.col("q.lat").alias("lat"), F.col("q.lon").alias("lon"))
    found, spots = shared_nodes(points, first_nid)
    nds = found.groupBy("wid").agg(F.sort_array(F.collect_list(F.struct("pos", "nid"))).alias("a")).select("wid", F.col("a.nid").alias("nds"))
    way_range = ingest.boxes(points, "wid")
    placed = segments.select("wid", F.col("line_zoom").alias("min_zoom"), F.lit(False).alias("center")).join(way_range, "wid")
    name = F.when(_lookup(FOLDERS, F.col("folder")).isNotNull(), F.nullif("name", F.lit("")))
    info = segments.select("wid", "class", F.lit(0).alias("flags"), F.lit(0).alias("layer"), name.alias("name"))
    labels = _labels(p.filter(F.col("point") & (F.col("class") != 0) & (F.coalesce("name", F.lit("")) != "")), points, segments)
    last = spots.agg(F.min("nid").alias("least")).select(F.coalesce("least", F.lit(first_nid + 1).cast("long")).alias("least"))
    labels = numbered(labels, "place", ["name"], 0, "k").crossJoin(F.broadcast(last)).withColumn("nid", F.col("least") - 1 + F.col("k")).drop("k", "least")
    tables = {n: spark.createDataFrame([], s) for n, s in ingest.S.TABLES.items()}
    return tables | {
        "node_coord": spots.select("nid", "lat", "lon").unionByName(labels.select("nid", "lat", "lon")),
        "node_info": labels.select("nid", "class", F.lit(0).alias("flags"), F.lit(0).alias("ele"), "name"),
        "way_info": info,
        "way_nds": nds,
        "way_range": way_range,
        "tile_ref": ingest.placed_boxes(placed, "way", "wid").unionByName(ingest.placed_points(labels, "node", "nid")),
    }


def _labels(p: DataFrame, points: DataFrame, segments: DataFrame) -> DataFrame:
    """The middle of each placemark's box, with its name."""
    box = ingest.boxes(points.join(segments.select("wid", "place"), "wid"), "place")
    middle = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) / 2.0
    return p.select("place", "class", "name", F.coalesce("point_zoom", F.lit(NEVER)).alias("min_zoom")).join(box, "place").select(
        "place", "class", "name", "min_zoom", middle("latB", "latT").alias("lat"), middle("lonL", "lonR").alias("lon")
    )
