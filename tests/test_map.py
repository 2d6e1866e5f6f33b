"""From map and boundary files to tiles, over small files made by hand."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera import schema as S
from tessera.dims import Classes
from tessera.functions import geo
from tessera.operators import encode, ingest, tiler
from tessera.plans import cli, jobs
from tessera.sources import kml, osm_xml, scratch
from tessera.sources.store import open_store
from tessera.style import Style

DATA = Path(__file__).parent / "data"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("store") / "map")
    jobs.import_osm(spark, str(DATA / "style.xml"), str(DATA / "map.osm"), out)
    return open_store(spark, out)


@pytest.fixture(scope="module")
def classes(spark):
    return Classes(Style.read(spark, str(DATA / "style.xml")).classes)


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_nodes(store, classes):
    info = rows(store["node_info"], "nid")
    assert set(info) == {1, 3, 4, 5, 6}  # 2, 7-10 have no class, 11 no name
    assert (info[1].name, info[1].ele, info[1]["class"]) == ("Boulder", 5328, classes["place:city"])
    assert (info[3].name, info[3].flags) == ("42", S.NAMEREF)
    assert (info[4].name, info[4].flags) == ("the Old Mill", S.BUILDING)
    assert (info[5].flags, info[5].ele) == (S.STATE_CAPITAL, 5280)
    assert info[6].name == "Green Mtn"
    assert store["node_coord"].count() == 11


def test_ways(store, classes):
    info = rows(store["way_info"], "wid")
    assert len(info) == 8
    assert info[100].name == "Pearl St" and info[101].flags == S.FORWARD
    assert (info[104].name, info[104].flags, info[104].layer) == ("US 36", S.NAMEREF | S.BRIDGE, 2)
    assert info[107]["class"] == classes["piste:downhill2"] and info[107].flags == 0
    ranges = rows(store["way_range"], "wid")
    # 105 has no resolvable node; 106 isn't selected (an unnamed line), but is a relation's member.
    assert set(ranges) == {100, 101, 102, 103, 104, 106, 107}
    assert (ranges[103].latT, ranges[103].lonL, ranges[103].latB, ranges[103].lonR) == (40.04, -105.3, 40.03, -105.29)
    placed = {r.ref for r in store["tile_ref"].filter("kind = 'way'").select("ref").distinct().collect()}
    assert placed == {100, 101, 102, 103, 104, 107}


def test_relations(store, classes):
    info = rows(store["rel_info"], "rid")
    assert set(info) == {200, 202}
    assert (info[200].type, info[200].nid, info[200].name) == (2, 1, None)
    assert info[202]["class"] == classes["boundary:national_park2"] and info[202].type == 1
    members = rows(store["rel_members"], "rid")
    assert [(m.wid, m.inner) for m in members[200].members] == [(103, 0), (106, 1)]
    assert store.changeset() == 99


def test_tile(store, classes):
    # The tile of zoom 15 that holds the farm's corner.
    t = store.spark.range(1).select(geo.tile_x(F.lit(-105.295), 15).cast("int").alias("x"), geo.tile_y(F.lit(40.035), 15).cast("int").alias("y")).first()
    tile = tiler.make_tile(store, 15, t.x, t.y).first()
    assert tile.changeset == 99
    rels = {r["class"]: r for r in tile.rels}
    farm = rels[classes["landuse:farm"]]
    assert farm.name == "Boulder"  # borrowed from its label
    assert [w.flags & S.INNER for w in farm.ways] in ([S.INNER, 0], [0, S.INNER], [0])
    # Its outer way has its class, so it isn't drawn again by itself.
    assert classes["landuse:farm"] not in [w["class"] for w in tile.ways]


def test_stitched_streets(store):
    t = store.spark.range(1).select(geo.tile_x(F.lit(-105.26), 9).cast("int").alias("x"), geo.tile_y(F.lit(40.021), 9).cast("int").alias("y")).first()
    tile = tiler.make_tile(store, 9, t.x, t.y).first()
    streets = [w for w in tile.ways if w.name == "Pearl St"]
    # 100 and 102 are stitched; 101 has another flag.
    assert sorted(w.flags for w in streets) == [0, S.FORWARD]


def test_all_tiles_and_bytes(store):
    tiles = tiler.make_tiles(store)
    assert tiles.count() == store["tile_ref"].select("zoom", "x", "y").distinct().count()
    blobs = encode.encode_tiles(tiles)
    back = encode.decode_tiles(blobs)
    assert back.filter("error is not null").count() == 0
    key = ["zoom", "x", "y"]
    assert back.drop("error").orderBy(*key).collect() == tiles.orderBy(*key).collect()
    assert tiler.summary(tiles).agg(F.sum("n_nodes")).first()[0] > 0
    assert tiler.text_dump(tiles).filter("line like 'N:%name=Boulder%'").count() > 0
    assert tiler.pixels(tiles).filter("px between 0 and 4095 and py between 0 and 4095").count() > 0


def test_requests(store):
    tile = jobs.serve(store, "/tiles/16/13600/24800").first()
    assert (tile.zoom, tile.x, tile.y) == (15, 6800, 12400)
    for wrong in ("tiles/3/1/1", "/tiles/3/1", "/tiles/a/1/1"):
        with pytest.raises(ValueError):
            jobs.serve(store, wrong)
    with pytest.raises(ValueError):
        tiler.make_tile(store, 4, 0, 0)


def test_boundaries(spark, store, tmp_path, classes):
    out = str(tmp_path / "both")
    store.write(out)
    both = jobs.import_kml(spark, str(DATA / "style.xml"), out, [str(DATA / "states.kml")])
    info = rows(both["way_info"].filter("wid < 0"), "wid")
    assert {(r["class"], r.name) for r in info.values()} == {(classes["boundary:state"], "Square"), (classes["core:wilderness"], None)}
    assert set(info) == {-2, -3, -4}
    labels = rows(both["node_info"].filter("nid < 0"), "nid")
    assert {r.name for r in labels.values()} == {"Square", "Two Parts"}
    nds = rows(both["way_nds"].filter("wid < 0"), "wid")
    square = next(r for r in info.values() if r.name == "Square")
    assert nds[square.wid].nds[0] == nds[square.wid].nds[-1]
    # Both rings that pass -105, 40 share its node.
    spots = both["node_coord"].filter("nid < 0 and lon = -105.0 and lat = 40.0").count()
    assert spots == 1
    again = jobs.import_kml(spark, str(DATA / "style.xml"), out, [str(DATA / "states.kml")])
    assert again["way_info"].filter("wid < 0").select("wid").distinct().count() == 6
    assert again["node_coord"].groupBy("nid").count().filter("count > 1").count() == 0


def test_prefetch(store, tmp_path):
    out = str(tmp_path / "cache")
    jobs.prefetch(store, out, "CO")
    blobs = store.spark.read.parquet(f"{out}/tiles")
    assert blobs.count() == store["tile_ref"].select("zoom", "x", "y").distinct().count()
    attrs = rows(store.spark.read.parquet(f"{out}/attr"), "key")
    assert attrs["changeset"].val == "99"
    assert jobs.region_tiles(store, (10.0, 10.0, 0.0, 20.0)).count() == 0


def test_prefetch_of_a_whole_box(store, tmp_path, monkeypatch):
    """Empty tiles are cached too, and a tile that can't be encoded doesn't stop the others."""
    box = (40.05, -105.35, 39.95, -105.2)
    grid = jobs.region_grid(store.spark, box)
    assert grid.count() == grid.distinct().count() and {r.zoom for r in grid.select("zoom").distinct().collect()} == set(S.ZOOMS)
    assert jobs.region_tiles(store, box).join(grid, ["zoom", "x", "y"], "left_anti").count() == 0
    jobs.prefetch(store, str(tmp_path / "cache"), box, empty=True)
    assert store.spark.read.parquet(str(tmp_path / "cache/tiles")).count() == grid.count()
    assert store.spark.read.parquet(str(tmp_path / "cache/failed")).count() == 0
    t = store.spark.createDataFrame([(3, 1, 1, 9, [], [], []), (99, 10**9, -1, 9, [], [], [])], S.TILE)
    kept = encode.encode_tiles(t.withColumn("x", F.when(F.col("zoom") == 99, None).otherwise(F.col("x"))), keep_failed=True).collect()
    assert [(r.zoom, r.error is None) for r in sorted(kept, key=lambda r: r.zoom)] == [(3, True), (99, False)]


def test_command_line(spark, tmp_path, capsys):
    style, store = str(DATA / "style.xml"), str(tmp_path / "store")
    assert cli.main(["import-osm", style, str(DATA / "map.osm"), store]) == 0
    assert cli.main(["import-kml", style, store, str(DATA / "states.kml")]) == 0
    assert cli.main(["select", store, "/tiles/15/6800/12400", str(tmp_path / "out")]) == 0
    assert (tmp_path / "out" / "tile-15-6800-12400.bin").exists()
    assert cli.main(["prefetch", "CO", store, str(tmp_path / "cache")]) == 0
    assert spark.read.parquet(str(tmp_path / "cache/tiles")).count() > 0
    with pytest.raises(SystemExit):
        cli.main(["prefetch", "nowhere", store, "x"])


def test_unknown_elements(spark, tmp_path):
    p = tmp_path / "odd.osm"
    p.write_text('<?xml version="1.0"?><osm><bounds/><node id="1" changeset="1" lat="1" lon="2"><tag k="a" v="x > y"/></node>\n<changeset id="4"/><gpx:trk /></osm>')
    assert osm_xml.unknown_elements(spark, str(p)) == ["changeset", "gpx:trk"]
    with pytest.raises(ValueError, match="unknown elements"):
        jobs.import_osm(spark, str(DATA / "style.xml"), str(p), str(tmp_path / "s"))
    assert osm_xml.unknown_elements(spark, str(DATA / "map.osm")) == []


def test_a_very_large_box(spark):
    """All zooms of a country's box: rows are unfolded, never held as one array."""
    box = spark.createDataFrame([(1, 50.0, -10.0, 45.0, 0.0, 13, False)], "id long, latT double, lonL double, latB double, lonR double, min_zoom int, center boolean")
    s = {r.zoom: r for r in ingest.spans(box, "id").collect()}
    counts = {r.zoom: r["count"] for r in ingest.placed_boxes(box, "way", "id").groupBy("zoom").count().collect()}
    assert counts == {z: (r.x1 - r.x0 + 1) * (r.y1 - r.y0 + 1) for z, r in s.items()} and counts[15] > 5 * 10**5


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        master = "spark://far:7077"
        _jsc = spark.sparkContext._jsc

    class Session:
        sparkContext = Elsewhere()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.shared_folder(Session())
    t = scratch.written(spark.range(3), "some")
    assert t.count() == 3
    scratch.discard(t, spark.range(1))
    with pytest.raises(Exception):  # noqa: B017
        t.count()


def test_bad_reference(spark, tmp_path):
    p = tmp_path / "bad.osm"
    p.write_text('<osm><way id="1" changeset="1"><nd ref="0"/><nd ref="5"/></way></osm>')
    with pytest.raises(Exception, match="without a node"):
        osm_xml.ways(spark, str(p)).collect()


def test_placemarks(spark):
    found = kml.placemarks(spark, str(DATA / "states.kml")).collect()
    assert [(r.folder, r.name, len(r.rings)) for r in sorted(found, key=lambda r: (r.folder, r.placemark_pos))] == [
        ("cb_2018_us_state_500k", "Square", 1), ("wild", "Two Parts", 2), ("wild", "no class", 1),
    ]


def test_compat_ranges(spark):
    nds = spark.createDataFrame([(1, [5]), (2, [7])], "wid bigint, nds array<bigint>")
    coord = spark.createDataFrame([(5, 1.0, 2.0)], "nid bigint, lat double, lon double")
    assert {r.wid for r in ingest.way_ranges(nds, coord).collect()} == {1}
    assert rows(ingest.way_ranges(nds, coord, compat=True), "wid")[2].latT == 0.0


def test_node_tables_are_not_broadcast(spark, store):
    """However small Spark takes them to be."""
    plan = tiler.gather_nodes(spark.createDataFrame([(9, 1, 1, 1)] * 9, "zoom int, x int, y int, ref long").repartition(2), store)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and plan.count("SortMergeJoin") == 2
