"""Run a stream to the end of its input and read back what it wrote."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from growthloom.plans.keyed import latest_by
from growthloom.session import scratch_path


def run_append(df: DataFrame, name: str) -> DataFrame:
    """Exactly-once parquet sink for rows that never change."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    query = df.writeStream.format("parquet").outputMode("append").option("path", path)
    query.option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def run_update(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key of an update-mode stream.

    Each micro-batch's changed rows go to a folder of their own; a replayed batch
    overwrites its folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}-checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    log = spark.read.schema(f"{columns}, batch_id long").parquet(path)
    return latest_by(log, list(keys), ["batch_id"]).drop("batch_id")


def as_ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
