"""The daily mart kept up by signed changes: only days that a change touches are read and written.

A change is a set of rows that came (sign +) and of rows that went (sign -): a late event, a refund or another status is the old
row with - and the new one with +.  Rows are summed per day with their sign, and the sums are added to the stored days.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from growthloom.plans.daily import ADDITIVE, Sources, day_parts
from growthloom.session import stage
from growthloom.sources.sinks import overwrite_partitions

SCHEMA = ", ".join(f"{c} long" for c in ADDITIVE) + ", last_batch long, metric_date date"


def changes(plus: Sources | None, minus: Sources | None = None) -> DataFrame:
    """(metric_date, ADDITIVE): what the given rows change, without days on which nothing remains."""
    signed = []
    for sign, src in ((1, plus), (-1, minus)):
        for part in day_parts(src) if src else []:
            signed.append(part.select("metric_date", *[(F.col(c) * sign).alias(c) for c in part.columns if c in ADDITIVE]))
    every = signed[0]
    for part in signed[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c) if c in every.columns else F.lit(0), F.lit(0)).cast("long").alias(c) for c in ADDITIVE]
    moved = " or ".join(f"{c} <> 0" for c in ADDITIVE)
    return every.groupBy("metric_date").agg(*sums).where(moved)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def apply(delta: DataFrame, path: str, batch_id: int) -> list:
    """Add changes to the mart; returns the days written.

    Every stored day knows the last batch added to it, so a batch that runs again, after a failure half-way too, adds nothing
    twice.  The touched days, one value each, come to the driver: the mart is partitioned by day, and only theirs are read.
    """
    spark = delta.sparkSession
    fixed = stage(delta.withColumn("last_batch", F.lit(batch_id).cast("long")).select(*[c.split(" ")[0] for c in SCHEMA.split(", ")]), "mart-delta")
    days = [r["metric_date"] for r in fixed.select("metric_date").collect()]
    if not days:
        return days
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    old = (read(spark, path) if there else fixed.where(F.lit(False))).where(F.col("metric_date").isin(days))
    done = old.where(F.col("last_batch") >= batch_id).select("metric_date")
    todo = fixed.join(done, "metric_date", "left_anti")
    sums = old.unionByName(todo).groupBy("metric_date").agg(*[F.sum(c).alias(c) for c in ADDITIVE], F.max("last_batch").alias("last_batch"))
    # Written aside first: the folders replaced are those read.
    overwrite_partitions(stage(sums, "mart-days"), path, "metric_date")
    return days
