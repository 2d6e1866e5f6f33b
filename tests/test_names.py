"""Names, elevations, styles, dictionaries and geometry on single values."""

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera import dims, style
from tessera import schema as S
from tessera.functions import geo, names, tags
from tessera.operators import encode, geometry


@pytest.mark.parametrize(
    "text, name, abrev, numbered",
    [
        ("Pearl Street", "Pearl Street", "Pearl St", False),
        ("East Pearl Street", "East Pearl Street", "E Pearl St", False),
        ("Mountain Road", "Mountain Road", "Mountain Rd", False),  # two words: the second alone
        ("North Boulder", "North Boulder", "N Boulder", False),
        ("State Highway 93", "Hwy 93", "", True),
        ("State Route 2", "Rte 2", "", True),
        ("County Road 11D", "CR 11D", "", False),
        ("US Highway 6", "US 6", "", False),
        ("United States Highway 6", "US 6", "", False),
        ("Highway 119", "Highway 119", "", True),
        ("Mesa Trail Head", "Mesa TH", "", False),
        ("Creek Multi-Use Path", "Creek MUP", "", False),
        ("Creek Multiuse Path", "Creek MUP", "", False),
        ("Mt Meeker 13,870 ft", "Mt Meeker", "", False),
        ("church of the hills", "Church of the Hills", "", False),
        ('"Sky" scraper | Peak', "Sky Scraper   Peak", "", False),
        ("St. Vrain", "St Vrain", "", False),
        ("Café Zürich", "Cafe Zurich", "", False),
        ("  Boulder", "Boulder", "", False),
    ],
)
def test_names(text, name, abrev, numbered):
    assert names.parse_name(text) == (name, abrev, numbered)


def test_name_limits():
    assert names.parse_name("") is None and names.parse_name(None) is None and names.parse_name("漢字") is not None
    assert len(names.words(" ".join(["word"] * 40))) == 16
    assert len(names.parse_name("long" * 200)[0]) <= 255
    assert names.parse_name("Mt Meeker 13,870 ft", compat=True)[0] == "Mt "


@pytest.mark.parametrize("text, feet, want", [("1624", False, 5328), ("5280", True, 5280), ("14259 ft", False, 14259), ("100 m", True, 328), ("high", False, 0), (None, False, 0), ("-10", True, -9)])
def test_elevations(spark, text, feet, want):
    assert names.parse_elevation(text, feet) == want
    assert spark.createDataFrame([(text,)], "t string").select(names.elevation(F.col("t"), feet).alias("e")).first().e == want


def test_compat_elevation():
    assert names.parse_elevation("14259 ft", False, compat=True) == 0 and names.parse_elevation("10", True, compat=True) == 10


def test_strtol(spark):
    texts = ["2", "-1", " 3x", "x", "", None, "+4", "99999999999"]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tags.whole(F.col("t")).alias("v")).collect()]
    assert got == [2, -1, 3, 0, 0, 0, 4, 999999999]


def test_states_and_classes():
    assert dims.state_code("co") == 8 and dims.state_code("Colorado") == 8 and dims.state_code("XX") == 0
    assert dims.state_name(56) == "Wyoming" and dims.state_abbreviation(11) == "DC" and dims.state_name(3) is None
    c = dims.Classes(["place:city", "building:shed"])
    assert c.code("highway", "motorway") == 344 and c.code("no", "such") == 0 and c.name(0) == "class:none"
    assert c.is_building(c["building:shed"]) and c.is_boundary(183) and not c.is_core(183)
    listed = dims.Classes(listed=["class:none", "a:b"])
    assert listed["a:b"] == 1 and listed["highway:motorway"] >= 2 and len(listed) == len(dims.CLASS_CODES) + 1


@pytest.mark.parametrize(
    "text",
    [
        "<s><line name='a' mode='solid' layer='none'/></s>", "<s><color name='a' val='12345'/></s>", "<s><class name='a' line='none'/></s>", "<s><what/></s>", "<s><layer/></s>",
        "<s><layer name='a'/><layer name='a'/></s>", "<s><line name='a' mode='dotted'/></s>", "<s><point name='a' flags='ele:hide'/></s>", "<s>",
    ],
)
def test_bad_styles(text):
    with pytest.raises(style.StyleError):
        style.Style.parse(text)


def test_style_frame(spark):
    s = style.Style.parse("<s><layer name='l'/><line name='a' min_zoom='7' mode='striped,named' layer='l'/><poly name='p' min_zoom='5'/><class name='x:y' line='a' poly='p' abrev='1'/><class name='e:e'/></s>")
    assert s.min_zoom("x:y") == 5 and s.min_zoom("e:e") == style.NEVER == s.min_zoom("none")
    rows = {r.class_name: r for r in s.frame(spark).collect()}
    assert (rows["x:y"].line_mode, rows["x:y"].line_min_zoom, rows["e:e"].line_mode) == (6, 7, None)
    assert style.color("80FF0040") == (128 / 255, 1.0, 0.0, 64 / 255)


# ---- geometry -------------------------------------------------------------------------------------------------

BOX = (40.0, -106.0, 39.0, -105.0)
spots = st.tuples(st.floats(38, 41), st.floats(-107, -104))


def segment(at, nodes=None, wid=1, key=()):
    return geometry.Segment(wid, key, nodes or list(range(len(at))), list(at), BOX)


@settings(max_examples=200, deadline=None)
@given(st.lists(spots, min_size=1, max_size=30))
def test_clip_keeps_what_is_inside(at):
    s = segment(at)
    geometry.clip(s, BOX)
    inside = [k for k, (lat, lon) in enumerate(at) if 39 <= lat <= 40 and -106 <= lon <= -105]
    assert set(inside) <= set(s.nodes) and s.nodes == sorted(s.nodes)


def test_clip_thins_one_side():
    out = [(42.0, -105.5 + k / 100) for k in range(10)]
    s = segment([(39.5, -105.5), *out, (39.5, -105.4)])
    geometry.clip(s, BOX)
    assert s.nodes == [0, 1, 10, 11]  # of a run to one side its ends stay
    alone = segment(out)
    geometry.clip(alone, BOX)
    assert len(alone.nodes) < 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), spots), min_size=3, max_size=12), st.booleans())
def test_clip_node_by_node(at, loop):
    """Against the rule said of one node at a time."""
    nodes = list(range(len(at)))
    if loop:
        nodes[-1], at[-1] = nodes[0], at[0]
    s = segment(at, list(nodes))
    geometry.clip(s, BOX)
    way = [None if p is None else int(geometry.directions(np.array(p[0]), np.array(p[1]), BOX)) for p in at]
    if loop:
        way[0] = way[-1] = None if at[0] is None else geometry.INSIDE

    def neighbour(k, step):
        j = k + step
        while 0 <= j < len(at) and way[j] is None:
            j += step
        if 0 <= j < len(at):
            return way[j]
        return way[k] if k in (0, len(at) - 1) else geometry.INSIDE

    stays = [k for k in range(len(at)) if way[k] in (None, geometry.INSIDE) or not way[k] == neighbour(k, -1) == neighbour(k, 1)]
    assert s.nodes == [nodes[k] for k in stays]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), spots), min_size=1, max_size=30), st.floats(0, 300_000))
def test_sample_keeps_the_ends(at, least):
    s = segment(at)
    geometry.sample(s, least)
    known = [k for k, p in enumerate(at) if p is not None]
    assert s.nodes[-1] == len(at) - 1 and (not known or known[0] in s.nodes)
    assert all(k in s.nodes for k, p in enumerate(at) if p is None)
    kept = [p for p in s.at if p is not None]
    for p, q in zip(kept[:-2], kept[1:-1], strict=False):
        assert math.dist(geometry.xyz(*p), geometry.xyz(*q)) >= least


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.one_of(st.none(), spots), min_size=1, max_size=15), st.booleans(), st.sampled_from([(3, 1, 3), (7, 27, 48), (7, 26, 48), (9, 106, 194)])), max_size=8))
def test_many_ways_at_once(found):
    """Thinning and rounding many ways side by side against one at a time."""
    ways, tiles = [], []
    for at, loop, tile in found:
        nodes = list(range(len(at)))
        if loop:
            nodes[-1], at[-1] = nodes[0], at[0]
        ways.append(segment(at, nodes, key=(1, 0, 0, "")))
        tiles.append(tile)
    flat = [p or (math.nan, math.nan) for w in ways for p in w.at]
    lat, lon = np.array(flat, dtype=np.float64).reshape(-1, 2).T
    sizes, where = np.array([len(w.nodes) for w in ways], dtype=np.int64), np.array(tiles, dtype=np.int64).reshape(-1, 3)
    ids = np.array([n for w in ways for n in w.nodes], dtype=np.int64)
    stays, left, known = geometry.thin(ids, lat, lon, sizes, where)
    drawn = [geometry.draw([segment(list(w.at), list(w.nodes), key=w.key)], *t, False) for w, t in zip(ways, tiles, strict=True)]
    want = [d[0].nodes if d else [] for d in drawn]
    assert [p.tolist() for p in np.split(ids[stays], np.cumsum(left)[:-1])][: len(want)] == want
    rows = np.flatnonzero(left > 0)
    shown = stays & ~np.isnan(lat)
    got = geometry.export_points(lat[shown], lon[shown], known[rows], where[rows])
    one = geometry.export([d[0] for d in drawn if d], [t for d, t in zip(drawn, tiles, strict=True) if d])
    assert all((g == o).all() for g, o in zip(got, one, strict=True))


def edges(segments):
    return sorted(tuple(sorted(e)) for s in segments for e in zip(s.nodes, s.nodes[1:], strict=False))


def test_stitch_keeps_all_edges():
    rng = random.Random(6)
    where = {k: (39 + rng.random(), -106 + rng.random()) for k in range(40)}
    for members in (True, False):
        for _ in range(100):
            parts = []
            for w in range(rng.randint(1, 12)):
                nodes = rng.sample(range(40), rng.randint(2, 4))
                parts.append(segment([where[n] for n in nodes], nodes, w, (rng.randint(0, 1),)))
            before = edges(parts)
            done = geometry.stitch(parts, members)
            assert edges(done) == before and all(where[n] == p for s in done for n, p in zip(s.nodes, s.at, strict=True))


def test_stitch_rules():
    line = lambda wid, nodes, key=(): segment([(39.5, -106 + n / 10) for n in nodes], list(nodes), wid, key)
    assert [s.nodes for s in geometry.stitch([line(1, [0, 1]), line(2, [1, 2])])] == [[0, 1, 2]]
    assert [s.nodes for s in geometry.stitch([line(1, [0, 1]), line(2, [2, 1])])] == [[0, 1, 2]]
    assert [s.nodes for s in geometry.stitch([line(1, [1, 0]), line(2, [1, 2])])] == [[2, 1, 0]]
    assert len(geometry.stitch([line(1, [0, 1], (1,)), line(2, [1, 2], (2,))])) == 2  # other attributes
    assert len(geometry.stitch([line(1, [0, 1], (1,)), line(2, [1, 2], (2,))], members=True)) == 1
    turn = segment([(39.5, -105.9), (39.9, -105.9)], [1, 9], 2)
    assert len(geometry.stitch([line(1, [0, 1]), turn])) == 2  # a right angle
    loop = segment([(39.5, -106), (39.6, -106), (39.5, -106)], [0, 5, 0], 3)
    assert len(geometry.stitch([line(1, [0, 1]), loop], members=True)) == 2
    chain = geometry.stitch([line(1, [0, 1]), line(2, [2, 3]), line(3, [1, 2])])
    assert [sorted(s.nodes) for s in chain] == [[0, 1, 2, 3]]


def test_export_equals_the_column_form(spark):
    rng = random.Random(9)
    z, x, y = 11, 425, 776
    t, left, b, r = geometry.bounds(z, x, y)
    at = [(b - 1 + rng.random() * (t - b + 2), left - 1 + rng.random() * (r - left + 2)) for _ in range(40)]
    begin, xs, ys = geometry.export([segment(at[:5]), segment(at), segment([None])], [(z, x, y)] * 3)
    assert begin[0] == 0 and begin[2] == begin[3] == len(xs)
    xs, ys = xs[begin[1] : begin[2]], ys[begin[1] : begin[2]]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(at)], "k int, lat double, lon double")
    tile = [F.lit(v) for v in (z, x, y)]
    px, py = geo.local_xy(F.col("lat"), F.col("lon"), *tile)
    pts = df.groupBy().agg(F.sort_array(F.collect_list(F.struct("k", px.alias("x"), py.alias("y")))).alias("a")).select(F.transform("a", lambda p: F.struct(p["x"], p["y"])).alias("p"))
    dense = pts.select(geo.densify(F.col("p")).alias("p"))
    short = dense.select(F.transform("p", lambda p: F.struct(geo.to_short(p["x"]).alias("x"), geo.to_short(p["y"]).alias("y"))).alias("p"))
    got = [(p.x, p.y) for p in short.select(geo.drop_repeats(F.col("p")).alias("p")).first().p]
    assert len(got) == len(xs) and max(max(abs(a - c), abs(b - d)) for (a, b), c, d in zip(got, xs.tolist(), ys.tolist(), strict=True)) <= 1


def test_long_edges_are_held_one_at_a_time():
    """Ways that cross a thousand tiles become thousands of points, nearly all rounded to the same few."""
    rng, n = np.random.default_rng(4), 300
    lat, lon = 34 + rng.random(4 * n) * 9, -110 + rng.random(4 * n) * 10
    tracemalloc.start()
    begin, xs, _ = geometry.export_points(lat, lon, np.full(n, 4), np.tile([15, 6800, 12500], (n, 1)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(begin) == n + 1 and len(xs) < 100 * n and peak < 8 << 20


def test_bad_tiles():
    good = encode.encode({**encode.empty_tile(1, 3, 2, 1)})
    assert encode.decode(good)["x"] == 2
    for bad in (good[:10], good + b"\0", b"\0" * len(good), good[:16] + (99).to_bytes(4, "little") + good[20:]):
        with pytest.raises(encode.TileError):
            encode.decode(bad)
    assert S.ZOOMS == (15, 13, 11, 9, 7, 5, 3)


def test_tiles_become_objects_a_few_at_a_time(monkeypatch):
    """Of a batch of tiles, one at a time is unfolded to be encoded, and some are decoded before they go on."""

    class Frame:  # gives the function that Spark would run
        select = lambda self, *_: self
        mapInArrow = mapInPandas = lambda self, run, _: run

    tiles = [encode.empty_tile(1, 3, k, 1) for k in range(6)]
    seen = []
    monkeypatch.setattr(encode, "_plain", lambda v, real=encode._plain: seen.append("plain") or real(v) if isinstance(v, dict) and "zoom" in v else real(v))
    monkeypatch.setattr(encode, "encode", lambda v, real=encode.encode: seen.append("encode") or real(v))
    (coded,) = encode.encode_tiles(Frame())(iter([pa.RecordBatch.from_pylist(tiles)]))
    assert seen == ["plain", "encode"] * 6 and coded.schema.names == ["zoom", "x", "y", "blob"]
    monkeypatch.setattr(encode, "DECODED", 2 * len(coded["blob"][0].as_py()), raising=False)
    back = list(encode.decode_tiles(Frame())(iter([coded.to_pandas()])))
    assert [len(b) for b in back] == [2, 2, 2] and [x for b in back for x in b["x"]] == list(range(6))


def test_picture_is_a_png():
    data = encode.picture([("node", 5, 5), ("way", 0, 0), ("rel", 4095, 4095)])
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and data.endswith(b"IEND\xaeB`\x82")
