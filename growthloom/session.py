"""Session settings and the shared folder for staged tables."""
from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL options the operators rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local-mode session (tests) may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    # This setting cannot be changed on a running session; the context remembers its own folder.
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="growthloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/growthloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and freezes results
    that must be the same for every reader (partition numbers, say).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # Nothing reads the shuffle files of this job once the table stands; else they stay until the driver collects garbage.
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def discard(*staged: DataFrame) -> None:
    """Remove tables that `stage` wrote, once nothing that is still to run reads them. Other frames are left alone.

    Spark removes the shuffle files of finished jobs when the driver's collector finds their plans unused; it is asked to look,
    as it may otherwise not do so for half an hour.
    """
    jvm = None
    for df in staged:
        path = getattr(df, "_staged", None)
        if path:
            context = df.sparkSession.sparkContext
            jvm = context._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    if jvm:
        gc.collect()  # Python's references to plans first
        jvm.java.lang.System.gc()
