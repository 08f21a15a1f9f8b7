"""Event streams over parquet folders, with event time as streaming needs it."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from growthloom.session import scratch_path
from growthloom.sources.fixtures import RAW

BATCHES = 6  # micro-batches of a replayed table


def read_stream(spark: SparkSession, path: str, schema: str, *times: str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table as a stream; the named time columns become zoned timestamps,
    which watermarks need."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.parquet(path + "*")
    return raw.withColumns({c: F.col(c).cast("timestamp") for c in times})


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.schema(RAW["events"]).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    raw = replay(stored, "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    return raw.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def replay(df: DataFrame, order: str, batches: int = BATCHES) -> DataFrame:
    """A stored table as a stream of about `batches` micro-batches that arrive in the given order.

    The rows go to as many files by ranges of `order`; a file source takes files by age, so the files' times follow the ranges.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "replay")
    df.repartitionByRange(batches, order).write.parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().toString() for f in files.listStatus(place) if f.getPath().getName().endswith(".parquet"))
    newest = files.getFileStatus(place).getModificationTime()
    for age, name in enumerate(names):
        files.setTimes(jvm.org.apache.hadoop.fs.Path(name), newest - 1000 * (len(names) - age), -1)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
