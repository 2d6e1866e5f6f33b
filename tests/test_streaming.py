"""Nodes that arrive as a stream are placed like those of a batch."""

from pyspark.sql import functions as F

from tessera import streaming
from tessera.dims import Classes
from tessera.operators import ingest
from tessera.plans import queries
from tessera.sources.store import last_write_wins, open_store
from tessera.style import Style


def raw(spark, low, high):
    tag = F.array(F.struct(F.lit("place").alias("k"), F.lit("economy").alias("v")), F.struct(F.lit("name").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("v")))
    return spark.range(low, high).select("id", F.lit(1).cast("long").alias("changeset"), (30 + F.col("id") / 10).alias("lat"), (-100 + F.col("id") / 10).alias("lon"), tag.alias("tags"))


def test_nodes_appended(spark, tmp_path):
    style = Style.parse(queries.STYLE)
    inbox, store = str(tmp_path / "in"), str(tmp_path / "store")
    raw(spark, 0, 20).write.parquet(inbox)
    streaming.append_nodes(spark, inbox, store, str(tmp_path / "cp"), style).awaitTermination()
    raw(spark, 20, 30).write.mode("append").parquet(inbox)
    streaming.append_nodes(spark, inbox, store, str(tmp_path / "cp"), style).awaitTermination()
    got = open_store(spark, store)
    want = ingest.placed_points(ingest.nodes(raw(spark, 0, 30), style, Classes(style.classes)), "node", "nid")
    key = ["kind", "zoom", "x", "y", "ref"]
    assert got["node_coord"].count() == 30
    assert sorted(map(tuple, got["tile_ref"].select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_activity_by_window(spark, tmp_path):
    rows = [("node", 3, 1, 1, f"2024-01-01 00:0{k}:00") for k in range(5)] + [("node", 3, 1, 1, "2024-01-01 00:20:00")]
    df = spark.createDataFrame(rows, "kind string, zoom int, x int, y int, at string").select("kind", "zoom", "x", "y", F.to_timestamp("at").alias("ts"))
    df.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    q = streaming.tile_activity(stream, late="1 minute").writeStream.format("memory").queryName("activity").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.refs for r in spark.table("activity").collect()) == [1, 5]


def test_last_write_wins(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, at int, v string")
    assert {(r.k, r.v) for r in last_write_wins(df, "k", "at").collect()} == {(1, "b"), (2, "c")}
