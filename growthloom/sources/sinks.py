"""Writers."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def append(df: DataFrame, path: str, cols: Sequence[str]) -> None:
    """Append the listed columns."""
    df.select(*cols).write.mode("append").parquet(path)


def write_packages(df: DataFrame, path: str, batch: str = "batch", rows_per_file: int = 100_000) -> None:
    """Nested rows as JSON lines in batch order; a batch number is a field, not a folder,
    so small batches do not make as many files as rows."""
    ranged = df.repartitionByRange(F.col(batch)).sortWithinPartitions(batch)
    ranged.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that `df` holds; a rerun gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def run_log(df: DataFrame, workflow_id, status, inputs: Sequence[str], outputs: Sequence[str], related: dict[str, str],
            trigger: str) -> DataFrame:
    """One run record per row: input and output as JSON plus links to related rows."""
    links = ["related_video_id", "related_subscriber_id", "related_purchase_id"]
    return df.select(
        workflow_id.cast("string").alias("workflow_id"),
        status.alias("status"),
        F.to_json(F.struct(*inputs)).alias("input_data"),
        F.to_json(F.struct(*outputs)).alias("output_data"),
        F.lit(trigger).alias("trigger_source"),
        *[(F.col(related[c]) if c in related else F.lit(None)).cast("string").alias(c) for c in links],
    )
