"""Incremental placement of features that arrive as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..dims import Classes
from ..operators import ingest
from ..style import Style


def raw_nodes(spark: SparkSession, folder: str, files_at_once: int = 64) -> DataFrame:
    """A stream of raw node files (Parquet with ``schema.RAW_NODE``) as they land in a folder."""
    return spark.readStream.schema(S.RAW_NODE).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def place_nodes(stream: DataFrame, style: Style, classes: Classes | None = None) -> DataFrame:
    """The selected nodes' tile references; a stateless transformation, so it appends as rows come."""
    return ingest.placed_points(ingest.nodes(stream, style, classes or Classes(style.classes)), "node", "nid")


def tile_activity(events: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """References by tile and window of event time ``ts``; rows later than ``late`` are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "kind", "zoom", "x", "y").agg(F.count("*").alias("refs"))


def append_nodes(spark: SparkSession, folder: str, store: str, checkpoint: str, style: Style, classes: Classes | None = None) -> StreamingQuery:
    """Adds arriving nodes to a store: positions, attributes and tile references. A batch that is repeated after a
    failure may add its rows again; ``sources.store.last_write_wins`` leaves one of each id."""
    classes = classes or Classes(style.classes)

    def batch(raw: DataFrame, epoch: int) -> None:
        raw = raw.persist()
        picked = ingest.nodes(raw, style, classes)
        raw.select(F.col("id").alias("nid"), "lat", "lon").write.mode("append").parquet(f"{store}/node_coord")
        picked.select("nid", "class", "flags", "ele", "name").write.mode("append").parquet(f"{store}/node_info")
        ingest.placed_points(picked, "node", "nid").write.mode("append").partitionBy("kind", "zoom").parquet(f"{store}/tile_ref")
        raw.unpersist()

    return raw_nodes(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
