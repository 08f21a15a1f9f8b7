"""Typed table scans with the computed columns of the data model."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from growthloom import schemas
from growthloom.functions import exprs as X


def gen_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_seconds", X.session_seconds("started_at", "ended_at"))


def gen_delta(df: DataFrame) -> DataFrame:
    gap = F.col("actual_performance") - F.col("estimated_performance")
    return df.withColumn("performance_delta", gap.cast("decimal(4,2)"))


def gen_net(df: DataFrame) -> DataFrame:
    return df.withColumn("net_revenue_cents", F.col("amount_cents") - F.col("fee_cents"))


def gen_total(df: DataFrame) -> DataFrame:
    return df.withColumn("total_cents", F.col("quantity") * F.col("unit_price_cents"))


COMPUTED = {
    "user_sessions": gen_duration,
    "viral_hooks": gen_delta,
    "purchases": gen_net,
    "purchase_items": gen_total,
}


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Scan a warehouse table with its declared schema; computed columns are added lazily."""
    df = spark.read.schema(schemas.schema_of(name)).parquet(path)
    return COMPUTED.get(name, lambda d: d)(df)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, ordered by name."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionAll(one)
    return out.orderBy("table_name")


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill declared column defaults where a value is missing."""
    types = {f.name: f.dataType for f in schemas.schema_of(table).fields}
    fills = {
        c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
        for c, v in schemas.DEFAULTS.get(table, {}).items()
        if c in df.columns
    }
    return df.withColumns(fills) if fills else df


def add_column(df: DataFrame, name: str, dtype: str, default) -> DataFrame:
    """Add a column, or fill its NULLs when it is already there."""
    base = F.col(name).cast(dtype) if name in df.columns else F.lit(None).cast(dtype)
    return df.withColumn(name, F.coalesce(base, F.lit(default).cast(dtype)))
