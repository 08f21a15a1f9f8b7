"""Physical layout of the warehouse: what a row store does with indexes, parquet does
with day folders and sorted files whose min/max statistics prune scans."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from growthloom import schemas

# table -> time column whose day is the folder (or None), columns to sort by
LAYOUT: dict[str, tuple[str | None, list[str]]] = {
    "analytics_funnel_events": ("created_at", ["stage", "created_at"]),
    "analytics_page_views": ("viewed_at", ["path", "viewed_at"]),
    "analytics_content_events": ("event_date", ["platform", "video_id"]),
    "automation_execution_logs": ("started_at", ["status", "workflow_id"]),
    "email_campaign_logs": ("created_at", ["campaign_id", "subscriber_id"]),
    "purchases": ("created_at", ["status", "product_id"]),
    "membership_events": ("created_at", ["event_type", "membership_id"]),
    "user_sessions": ("started_at", ["profile_id", "started_at"]),
    "memberships": (None, ["status", "current_period_end"]),
    "email_subscribers": (None, ["status", "created_at"]),
    "affiliate_commissions": (None, ["status", "affiliate_id"]),
    "profiles": (None, ["id"]),
    "affiliates": (None, ["referral_code"]),
}


def write_table(df: DataFrame, table: str, path: str, rows_per_file: int = 5_000_000) -> None:
    """Write a table in its layout.

    Rows are range-partitioned by day and sort columns together, so a day with a
    third of all rows is written by many tasks; a rewrite replaces only its days.
    """
    day, order = LAYOUT.get(table, (None, []))
    order = [c for c in order if c in df.columns]
    keys = list(order)
    if day:
        df = df.withColumn("day", F.to_date(day))
        keys = ["day", *order]
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if day:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("day")
    writer.parquet(path)


def read_days(spark: SparkSession, table: str, path: str, first: str, last: str) -> DataFrame:
    """Rows of the days in [first, last]; other folders are not listed or read."""
    schema = schemas.schema_of(table).add("day", "date")
    days = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.read.schema(schema).parquet(path).where(days)
