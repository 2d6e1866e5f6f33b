"""From raw map elements to the store's tables: classify, select, name, measure and place.

Selection joins the style by broadcast: a style sheet has a row a class and is the only thing broadcast here.
Geometry joins are equi-joins on node and way ids; where a feature's box is placed, it is exploded to the cells it
touches, so tiles are found by equality later.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..dims import Classes
from ..functions import geo, names, tags
from ..sources.scratch import written
from ..style import NEVER, Style

#: Square degrees from which on a polygon relation's members aren't kept, single precision.
LARGE_AREA = 64 * 0.002

STYLED = "class int, abrev int, line boolean, named boolean, poly boolean, point boolean, point_zoom int, min_zoom int"


def styled_classes(spark, style: Style, classes: Classes) -> DataFrame:
    """The style by class code: which parts a class has, and from which zoom on."""
    rows = []
    for name, c in style.classes.items():
        mode = style.lines[c["line"]]["mode"] if c["line"] else 0
        point_zoom = style.points[c["point"]]["min_zoom"] if c["point"] else None
        rows.append((classes.codes.get(name), c["abrev"], c["line"] is not None, bool(mode & S.NAMED), c["poly"] is not None, c["point"] is not None, point_zoom, style.min_zoom(name)))
    return spark.createDataFrame([r for r in rows if r[0] is not None], STYLED)


def _styles(df: DataFrame, styled: DataFrame, classes: Classes) -> DataFrame:
    """Adds ``s1``, the own class' style, and ``s2``, that of plain buildings for features with the building flag."""
    parts = F.struct(*(c for c in styled.columns if c != "class"))
    out = df.join(F.broadcast(styled.select(F.col("class"), parts.alias("s1"))), "class", "left")
    # One row of the style sheet at most.
    plain = styled.filter(F.col("class") == classes["building:yes"]).first()
    types = {f.name: f.dataType for f in styled.schema if f.name != "class"}
    s2 = F.struct(*(F.lit(plain[c] if plain else None).cast(t).alias(c) for c, t in types.items()))
    return out.withColumn("s2", F.when((F.col("flags").bitwiseAND(S.BUILDING) != 0) & F.lit(plain is not None), s2))


def _described(df: DataFrame, classes: Classes, way: bool, compat: bool) -> DataFrame:
    """Class, names, reference and what else all kinds of elements have."""
    out = df.withColumn("rest", tags.unclassed(classes, F.col("tags")))
    rest = F.col("rest")
    protect, national = tags.protection(rest)
    piste = tags.pistes(rest) if way else None
    out = out.withColumn("class", tags.override_class(classes, tags.fold_class(classes, F.col("tags")), protect, national, piste))
    out = out.withColumn("ref_name", tags.reference(rest))
    out = out.withColumn("n0", names.parsed_name(tags.first_part(tags.last(rest, "name")), compat))
    out = out.withColumn("n1", names.parsed_name(tags.first_part(tags.last(rest, "name:en")), compat))
    english = F.col("n1.name").isNotNull()
    for field, default in (("name", ""), ("abrev", "")):
        out = out.withColumn(f"tag_{field}", F.coalesce(F.when(english, F.col(f"n1.{field}")).otherwise(F.col(f"n0.{field}")), F.lit(default)))
    return out.withColumn("numbered", F.coalesce("n0.numbered", F.lit(False)) | F.coalesce("n1.numbered", F.lit(False))).drop("n0", "n1")


def _null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def nodes(raw: DataFrame, style: Style, classes: Classes, compat: bool = False) -> DataFrame:
    """Selected nodes: node_info's columns, position and the zoom from which they are drawn."""
    styled = styled_classes(raw.sparkSession, style, classes)
    d = _described(raw, classes, False, compat)
    d = d.withColumn("flags", tags.node_flags(F.col("tags"), F.col("rest")))
    feet, metres = tags.last(F.col("rest"), "ele:ft"), tags.last(F.col("rest"), "ele")
    last_is_feet = tags.last(F.transform(F.filter("rest", lambda t: t["k"].isin("ele", "ele:ft")), lambda t: F.struct(F.lit("k").alias("k"), t["k"].alias("v"))), "k") == "ele:ft"
    d = d.withColumn("ele", F.when(last_is_feet, names.elevation(feet, True, compat)).otherwise(names.elevation(metres, False, compat)))
    d = _styles(d, styled, classes)
    # Buildings without a point of their own are drawn as plain buildings.
    s = F.when(F.coalesce("s1.point", F.lit(False)), F.col("s1")).otherwise(F.col("s2"))
    d = d.withColumn("s", s)
    junction = (F.col("class") == classes["highway:motorway_junction"]) & (F.col("ref_name") != "")
    d = d.filter(F.col("s.point") & ((F.col("tag_name") != "") | junction))
    name = F.when(junction, F.col("ref_name")).when((F.col("tag_abrev") == "") | (F.col("s.abrev") == 0), F.col("tag_name")).otherwise(F.col("tag_abrev"))
    flags = F.when(junction, F.col("flags").bitwiseOR(S.NAMEREF)).otherwise(F.col("flags"))
    return d.select(F.col("id").alias("nid"), "class", flags.alias("flags"), "ele", _null_if_empty(name).alias("name"), "lat", "lon", F.col("s.point_zoom").alias("min_zoom"))


def ways(raw: DataFrame, style: Style, classes: Classes, compat: bool = False) -> DataFrame:
    """All ways: way_info's columns and nodes, and for selected ones the zoom and whether only the centre counts."""
    styled = styled_classes(raw.sparkSession, style, classes)
    d = _described(raw, classes, True, compat)
    d = d.withColumn("flags", tags.way_flags(F.col("tags"), F.col("rest"))).withColumn("layer", tags.whole(tags.last(F.col("rest"), "layer")))
    d = _styles(d, styled, classes)
    has_name = (F.col("tag_name") != "") | (F.col("ref_name") != "")
    off = F.lit(False)

    def part(s: str, kind: str) -> Column:
        have = F.coalesce(F.col(f"{s}.{kind}"), off)
        if kind == "line":
            return have & (has_name | ~F.col(f"{s}.named"))
        return have & has_name if kind == "point" else have

    zooms, chosen = [], {}
    for kind in ("line", "poly", "point"):
        first, second = part("s1", kind), part("s2", kind)
        chosen[kind] = first | second
        zooms.append(F.when(first, F.col("s1.min_zoom")).when(second, F.col("s2.min_zoom")))
    drawn = chosen["line"] | chosen["poly"]
    motorway = (F.col("class") == classes["highway:motorway"]) & (F.col("ref_name") != "")
    by_number = motorway | (F.col("numbered") & (F.col("ref_name") != ""))
    short = (F.col("tag_abrev") != "") & (F.coalesce("s1.abrev", F.lit(0)) != 0)
    named = F.when(by_number, F.col("ref_name")).when(short, F.col("tag_abrev")).when(F.col("tag_name") != "", F.col("tag_name")).otherwise(F.col("ref_name"))
    by_ref = by_number | (~short & (F.col("tag_name") == "") & (F.col("ref_name") != ""))
    flags = F.when(by_ref, F.col("flags").bitwiseOR(S.NAMEREF)).otherwise(F.col("flags"))
    d = d.withColumn("selected", drawn | chosen["point"]).withColumn("center", ~drawn & chosen["point"])
    return d.select(
        F.col("id").alias("wid"), "class", flags.alias("flags"), "layer", _null_if_empty(named).alias("name"), "nds", "selected", "center",
        F.coalesce(F.least(*zooms), F.lit(NEVER)).alias("min_zoom"),
    )


def way_members(members: Column) -> Column:
    """A relation's ways, and whether each is an inner one."""
    kept = F.filter(members, lambda m: m["type"] == "way")
    return F.transform(kept, lambda m: F.struct(m["ref"].alias("wid"), (m["role"] == "inner").cast("int").alias("inner")))


def label_node(members: Column) -> Column:
    """A relation's last centre or label node; -1 without one."""
    labels = F.filter(members, lambda m: (m["type"] == "node") & m["role"].isin("admin_centre", "label"))
    return F.coalesce(F.try_element_at(labels, F.lit(-1))["ref"], F.lit(-1).cast("long"))


def relation_type(text: Column) -> Column:
    out = F.lit(0)
    for k, name in enumerate(S.RELATION_TYPES):
        out = F.when(text == name, k).otherwise(out)
    return out


def relations(raw: DataFrame, style: Style, classes: Classes, compat: bool = False) -> DataFrame:
    """Selected relations: rel_info's columns, members, zoom, and whether they are polygons or centres only."""
    styled = styled_classes(raw.sparkSession, style, classes)
    d = _described(raw, classes, False, compat)
    d = d.withColumn("flags", tags.relation_flags(F.col("tags"))).withColumn("type", F.coalesce(relation_type(tags.last(F.col("rest"), "type")), F.lit(0)))
    d = _styles(d, styled, classes)
    off, has_name = F.lit(False), F.col("tag_name") != ""
    drawn = lambda s: F.coalesce(F.col(f"{s}.line") | F.col(f"{s}.poly"), off)
    point = lambda s: F.coalesce(F.col(f"{s}.point"), off) & has_name
    # The first that holds decides: drawn by the own class, drawn as a building, a point of either.
    s = F.when(drawn("s1"), F.col("s1")).when(drawn("s2"), F.col("s2")).when(point("s1"), F.col("s1")).when(point("s2"), F.col("s2"))
    d = d.withColumn("center", ~(drawn("s1") | drawn("s2"))).withColumn("s", s).filter(F.col("s").isNotNull() & (F.col("type") != 0))
    name = F.when((F.col("tag_abrev") == "") | F.coalesce(F.col("s1.abrev") == 0, off), F.col("tag_name")).otherwise(F.col("tag_abrev"))
    return d.select(
        F.col("id").alias("rid"), label_node(F.col("members")).alias("nid"), "class", "flags", "type", _null_if_empty(name).alias("name"),
        way_members(F.col("members")).alias("members"), "center", (~F.col("center") & F.col("s.poly")).alias("polygon"), F.col("s.min_zoom").alias("min_zoom"),
    )


def boxes(points: DataFrame, key: str) -> DataFrame:
    """The box of each key's points (lat, lon)."""
    return points.groupBy(key).agg(F.max("lat").alias("latT"), F.min("lon").alias("lonL"), F.min("lat").alias("latB"), F.max("lon").alias("lonR"))


def merged_boxes(parts: DataFrame, key: str) -> DataFrame:
    """The box around each key's boxes."""
    return parts.groupBy(key).agg(F.max("latT").alias("latT"), F.min("lonL").alias("lonL"), F.min("latB").alias("latB"), F.max("lonR").alias("lonR"))


def way_points(way_nds: DataFrame, node_coord: DataFrame) -> DataFrame:
    """A row for each resolved node of each way, with its place: references that aren't there are left out."""
    refs = way_nds.select("wid", F.posexplode("nds").alias("pos", "nid"))
    return refs.join(node_coord, "nid").select("wid", "pos", "nid", "lat", "lon")


def way_ranges(way_nds: DataFrame, node_coord: DataFrame, compat: bool = False) -> DataFrame:
    """Boxes of ways. One whose nodes are all missing has none; with ``compat`` it has the box (0, 0, 0, 0)."""
    found = boxes(way_points(way_nds, node_coord), "wid")
    return _zero_filled(way_nds.select("wid"), found, "wid") if compat else found


def relation_ranges(rels: DataFrame, way_range: DataFrame, compat: bool = False) -> DataFrame:
    """Boxes of relations, around those of their ways."""
    parts = rels.select("rid", F.explode("members").alias("m")).select("rid", F.col("m.wid").alias("wid")).distinct()
    found = merged_boxes(parts.join(way_range, "wid"), "rid")
    return _zero_filled(rels.select("rid"), found, "rid") if compat else found


def _zero_filled(keys: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return keys.join(found, key, "left").select(key, *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("latT", "lonL", "latB", "lonR")))


def large(d: str = "") -> Column:
    """Whether a box is too large for its relation's members to be kept."""
    area = ((F.col(f"{d}latT") - F.col(f"{d}latB")).cast("float") * (F.col(f"{d}lonR") - F.col(f"{d}lonL")).cast("float")).cast("float")
    return area >= F.lit(LARGE_AREA).cast("float")


def kept_members(rels: DataFrame, rel_range: DataFrame) -> DataFrame:
    """rel_members: each way once, at its first place; none for centres and for large polygons."""
    first = F.filter("members", lambda m, i: ~F.exists(F.slice("members", 1, i), lambda e: e["wid"] == m["wid"]))
    joined = rels.join(rel_range, "rid", "left").filter(~F.col("center") & ~(F.col("polygon") & F.coalesce(large(), F.lit(False))))
    return joined.withColumn("members", F.when(F.size("members") > 1, first).otherwise(F.col("members"))).filter(F.size("members") > 0).select("rid", "members")


def placed_points(df: DataFrame, kind: str, key: str) -> DataFrame:
    """tile_ref rows of points (lat, lon, min_zoom)."""
    return df.select(F.col(key).alias("ref"), F.explode(geo.point_tiles(F.col("lat"), F.col("lon"), F.col("min_zoom"))).alias("t")).select(
        F.lit(kind).alias("kind"), "t.zoom", "t.x", "t.y", "ref"
    )


def spans(df: DataFrame, key: str) -> DataFrame:
    """For boxes (latT, lonL, latB, lonR, min_zoom, center) and each zoom that serves them, the tiles they touch."""
    rows = df.select(F.col(key).alias("ref"), "latT", "lonL", "latB", "lonR", "center", F.explode(geo.served(F.col("min_zoom"))).alias("zoom"))
    span = geo.box_span(*(F.col(c) for c in ("latT", "lonL", "latB", "lonR", "zoom", "center")))
    return rows.select("ref", "zoom", span.alias("s")).select("ref", "zoom", "s.*")


def placed_boxes(df: DataFrame, kind: str, key: str) -> DataFrame:
    """tile_ref rows of boxes (latT, lonL, latB, lonR, min_zoom, center). A box is unfolded zoom by zoom, row by row and
    then cell by cell: a row of cells is the most that is ever held, however large the box."""
    rows = spans(df, key).filter("x0 <= x1 and y0 <= y1").select("ref", "zoom", "x0", "x1", F.explode(F.sequence("y0", "y1")).alias("y"))
    return rows.select(F.lit(kind).alias("kind"), "zoom", F.explode(F.sequence("x0", "x1")).alias("x"), "y", "ref")


def greatest_changeset(*raw: DataFrame) -> DataFrame:
    """attr: the greatest changeset of all elements."""
    every = reduce(DataFrame.unionByName, (r.select("changeset") for r in raw))
    return every.agg(F.max("changeset").alias("c")).select(F.lit("changeset").alias("key"), F.coalesce("c", F.lit(0)).cast("string").alias("val"))


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """How many nodes, ways and relations were kept."""
    kinds = (("nodes", "node_info"), ("ways", "way_info"), ("relations", "rel_info"))
    return reduce(DataFrame.unionByName, (tables[t].agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, t in kinds))


def import_map(raw_nodes: DataFrame, raw_ways: DataFrame, raw_rels: DataFrame, style: Style, classes: Classes | None = None, compat: bool = False) -> dict[str, DataFrame]:
    """The store's tables from raw elements (``sources.osm_xml``). Ten tables come of each element, so elements are
    parsed once and described once, to written tables."""
    classes = classes or Classes(style.classes)
    raw_nodes, raw_ways, raw_rels = (written(df, f"raw-{k}") for k, df in (("nodes", raw_nodes), ("ways", raw_ways), ("relations", raw_rels)))
    n = written(nodes(raw_nodes, style, classes, compat), "nodes")
    w = written(ways(raw_ways, style, classes, compat), "ways")
    r = written(relations(raw_rels, style, classes, compat), "relations")
    node_coord = raw_nodes.select(F.col("id").alias("nid"), "lat", "lon")
    way_nds = w.select("wid", "nds")
    # Boxes are needed for selected ways and for members of kept relations.
    members = r.select(F.explode("members.wid").alias("wid")).distinct()
    needed = w.filter("selected").select("wid").unionByName(members).distinct()
    way_range = written(way_ranges(way_nds.join(needed, "wid", "left_semi"), node_coord, compat), "way-ranges")
    rel_range = written(relation_ranges(r, way_range, compat), "relation-ranges")
    refs = [
        placed_points(n, "node", "nid"),
        placed_boxes(w.filter("selected").join(way_range, "wid"), "way", "wid"),
        placed_boxes(r.join(rel_range, "rid"), "rel", "rid"),
    ]
    return {
        "node_coord": node_coord,
        "node_info": n.select("nid", "class", "flags", "ele", "name"),
        "way_info": w.select("wid", "class", "flags", "layer", "name"),
        "way_nds": way_nds,
        "way_range": way_range,
        "rel_info": r.select("rid", "nid", "class", "flags", "type", "name"),
        "rel_members": kept_members(r, rel_range),
        "rel_range": rel_range,
        "tile_ref": reduce(DataFrame.unionByName, refs),
        "attr": greatest_changeset(raw_nodes, raw_ways, raw_rels),
    }
