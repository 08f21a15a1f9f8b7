"""The weekly report as one long frame."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import content as C
from growthloom.operators import funnel, ops, revenue
from growthloom.operators.filters import lookback
from growthloom.plans.daily import Sources


def _rows(df: DataFrame, section: str, metric, dim, value) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), metric.alias("metric"), dim.cast("string").alias("dim"),
        value.cast("double").alias("value"),
    )


def _both(df: DataFrame, section: str, dim: str, metrics: list[str]) -> DataFrame:
    """Several metric columns as rows, from one evaluation of the frame."""
    wide = df.select(F.col(dim).cast("string").alias("dim"), *[F.col(m).cast("double").alias(m) for m in metrics])
    return _rows(wide.unpivot(["dim"], metrics, "metric", "value"), section, F.col("metric"), F.col("dim"), F.col("value"))


def weekly_report(src: Sources, workflows: DataFrame, as_of) -> DataFrame:
    """Content, funnel, revenue and operations of the last seven days."""
    lo, hi = F.to_date(as_of - F.expr("interval 7 days")), F.to_date(as_of)
    week = src.content.where(F.col("event_date").between(lo, hi))
    by_platform = week.groupBy("platform").agg(
        F.sum("views").alias("views"), F.sum("shares").alias("shares"), F.sum("saves").alias("saves"),
        F.sum("follower_gain").alias("followers"),
    ).unpivot(["platform"], ["views", "shares", "saves", "followers"], "metric", "value")
    out = _rows(by_platform, "content", F.col("metric"), F.col("platform"), F.col("value"))

    steps = funnel.funnel_table(lookback(src.funnel, "created_at", as_of, "7 days"))
    out = out.unionByName(_both(steps, "funnel", "stage", ["volume", "conversion_pct"]))

    money = revenue.revenue(lookback(src.purchases, "created_at", as_of, "7 days"), src.products)
    money = money.unpivot([], money.columns, "metric", "value")
    out = out.unionByName(_rows(money, "revenue", F.col("metric"), F.lit("all"), F.col("value")))

    paid = lookback(src.purchases, "created_at", as_of, "7 days")
    out = out.unionByName(_both(revenue.ltv_summary(paid).withColumn("dim", F.lit("all")), "revenue", "dim", ["mean_ltv_cents"]))

    hooks = C.hook_engagement(src.content, src.videos, as_of)
    out = out.unionByName(_both(hooks.withColumnRenamed("total_views", "hook_views"), "hooks", "hook_id", ["hook_views", "eng_rate_ls"]))
    top = week.groupBy("platform").agg(F.sum("views").alias("top_channel_views")).orderBy(
        F.desc_nulls_last("top_channel_views"), F.asc("platform")
    )
    out = out.unionByName(_both(top.limit(1), "summary", "platform", ["top_channel_views"]))

    runs = ops.health(workflows, src.logs, as_of, "7 days")
    return out.unionByName(_both(runs, "operations", "name", ["success_rate", "failures"]))
