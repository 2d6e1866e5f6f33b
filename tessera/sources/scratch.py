"""Tables that are written once between steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Removes a query's shuffle files at its end. On for the time of a write, whose plan nothing runs again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. A folder of our own only where the session names none and runs on one
    machine: on a cluster, executors would write to disks that nobody else reads."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="tessera-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: its lineage ends there, and a lost executor costs a read instead of a
    recomputation. Shuffle files go as soon as they are read, not when the driver happens to collect its garbage."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables that ``written`` gave and that nothing will read again; others stay."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
