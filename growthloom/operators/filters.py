"""Predicates, time windows, named row sets and routing."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.functions import exprs as X


def lookback(df: DataFrame, ts: str, as_of: Column, span: str) -> DataFrame:
    """Rows in [as_of - span, as_of]."""
    return df.where((F.col(ts) >= as_of - F.expr(f"interval {span}")) & (F.col(ts) <= as_of))


def due_within(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    return df.where(F.col(ts).between(as_of, as_of + F.expr(f"interval {days} days")))


def on_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """One UTC day as a half-open range on the raw column, so that scans can prune."""
    start = F.lit(day).cast("timestamp_ntz")
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("interval 1 day")))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == value).limit(1)


def has_any(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.arrays_overlap(column, F.array(*[F.lit(v) for v in values])))


def search_catalog(df: DataFrame, equals: dict[str, str] | None = None, tools: Sequence[str] = (),
                   keyword: str | None = None, text: str = "name") -> DataFrame:
    """Catalog rows that match every given field, hold every tool and contain the keyword."""
    for col, value in (equals or {}).items():
        df = df.where(F.col(col) == value)
    for tool in tools:
        df = df.where(F.array_contains("tools_required", tool))
    return df.where(F.col(text).ilike(f"%{keyword}%")) if keyword else df


def viral(df: DataFrame, views: str = "total_views", more_than: int = X.VIRAL_VIEWS) -> DataFrame:
    """Strong call to action for videos above the view limit, else the soft one."""
    return df.withColumn("cta", F.when(F.col(views) > more_than, "hard").otherwise("soft"))


def gate(df: DataFrame, kind: str) -> DataFrame:
    """Mark messages of types nobody handles, with the reason."""
    known = F.coalesce(F.col(kind).isin(X.HANDLED_TYPES), F.lit(False))
    return df.withColumns({"skip": ~known, "reason": F.when(~known, "Unhandled event type")})


def route(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where `pred` holds, and all others (NULL counts as not)."""
    yes = F.coalesce(pred, F.lit(False))
    return df.where(yes), df.where(~yes)


def hot_set(df: DataFrame, name: str, as_of: Column | None = None) -> DataFrame:
    """The named row sets dashboards and jobs keep asking for."""
    col = F.col

    def since(ts: str, span: str) -> Column:
        return (col(ts) > as_of - F.expr(f"interval {span}")) & (col(ts) <= as_of)

    sets = {
        "active_subscribers": lambda: col("status") == "active",
        "active_affiliates": lambda: col("is_active"),
        "recent_videos": lambda: (col("status") == "published") & since("published_at", "30 days"),
        "queued_jobs": lambda: col("status") == "queued",
        "pending_commissions": lambda: col("status") == "pending",
        "failed_runs": lambda: col("status") == "failed",
        "renewing_members": lambda: col("status").isin("active", "trialing"),
        "members": lambda: col("is_member"),
        "refunded_purchases": lambda: col("status").isin("refunded", "partially_refunded"),
        "sendable_campaigns": lambda: (col("status") == "active") & col("send_at").isNotNull(),
        "anonymous_events": lambda: col("anonymous_id").isNotNull(),
        "top_buyers": lambda: (col("status") == "active") & col("has_purchased"),
        "active_products": lambda: col("is_active"),
        "active_workflows": lambda: col("is_active"),
        "cancelling_members": lambda: col("cancel_at_period_end"),
        "churned_members": lambda: col("ended_at").isNotNull(),
        "recent_metrics": lambda: since("metric_date", "90 days"),
    }
    return df.where(sets[name]())
