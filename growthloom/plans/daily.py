"""The daily metrics mart: one row per day from every source, for any range of days."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from growthloom.functions import exprs as X
from growthloom.operators import content as C
from growthloom.operators import funnel, ops, revenue
from growthloom.sources.sinks import overwrite_partitions


@dataclass
class Sources:
    """Input tables of the mart; a part of them is enough for `day_parts`."""

    funnel: DataFrame | None = None
    purchases: DataFrame | None = None
    products: DataFrame | None = None
    subscribers: DataFrame | None = None
    videos: DataFrame | None = None
    content: DataFrame | None = None
    logs: DataFrame | None = None
    memberships: DataFrame | None = None
    commissions: DataFrame | None = None


def _between(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi + F.expr("interval 1 day")))


def _by_day(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    return _between(df, ts, start, end).withColumn("metric_date", F.to_date(ts))


def _spine(df: DataFrame, start: str, end: str) -> DataFrame:
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return df.sparkSession.range(1).select(F.explode(days).alias("metric_date"))


def retention(memberships: DataFrame, start: str, end: str) -> DataFrame:
    """Members at the end of each day, those who left on it, and the share that left.

    Starts and ends are counted per day; everything before the range folds into
    its first day, so the running sum covers one row per day of the range.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    rows = memberships.select(
        F.inline(
            F.array(
                F.struct(F.to_date("created_at").alias("day"), F.lit(1).alias("begun"), F.lit(0).alias("ended")),
                F.struct(F.to_date("ended_at").alias("day"), F.lit(0).alias("begun"), F.lit(1).alias("ended")),
            )
        )
    ).where(F.col("day") <= last)
    changes = rows.groupBy(F.greatest("day", F.date_sub(first, 1)).alias("metric_date")).agg(
        F.sum("begun").alias("begun"), F.sum("ended").alias("ended")
    )
    spine = memberships.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(first, 1), last)).alias("metric_date")
    )
    upto = Window.orderBy("metric_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = spine.join(changes, "metric_date", "left").select(
        "metric_date", F.coalesce("ended", F.lit(0)).alias("churned_members"),
        F.coalesce(F.sum("begun").over(upto), F.lit(0)).alias("_b"), F.coalesce(F.sum("ended").over(upto), F.lit(0)).alias("_e"),
    )
    active = F.col("_b") - F.col("_e")
    there = active + F.col("churned_members")
    return running.where(F.col("metric_date") >= first).select(
        "metric_date", active.alias("active_members"), "churned_members",
        X.ratio("churned_members", there).alias("churn_rate"),
    )


def payouts_by_day(commissions: DataFrame, start: str, end: str) -> DataFrame:
    paid = _by_day(commissions.where("status = 'paid'"), "created_at", start, end)
    return paid.groupBy("metric_date").agg(F.sum("amount_cents").alias("affiliate_payouts_cents"))


# Columns of the mart that are sums over a day's rows.
ADDITIVE = (
    "profile_visits", "landing_page_views", "lead_magnet_downloads", "tripwire_sales", "membership_new_sales", "automation_package_sales",
    "tripwire_revenue_cents", "membership_revenue_cents", "automation_revenue_cents", "total_revenue_cents", "new_subscribers",
    "videos_published", "total_content_views", "total_engagement", "new_followers", "workflows_run", "workflows_failed", "workflow_total",
)


def day_parts(src: Sources) -> list[DataFrame]:
    """Every source that is there, reduced to one row per day with its columns of ADDITIVE."""
    day, parts = ["metric_date"], []

    def dated(df: DataFrame, ts: str) -> DataFrame:
        return df.where(F.col(ts).isNotNull()).withColumn("metric_date", F.to_date(ts))

    if src.funnel is not None:
        steps = funnel.funnel_counts(dated(src.funnel, "created_at"), day)
        parts.append(steps.select(
            "metric_date", F.col("profile_visit").alias("profile_visits"), F.col("landing_page_view").alias("landing_page_views"),
            F.col("lead_magnet_download").alias("lead_magnet_downloads"), F.col("tripwire_purchase").alias("tripwire_sales"),
            F.col("membership_purchased").alias("membership_new_sales"), F.col("automation_package_purchase").alias("automation_package_sales")))
    if src.purchases is not None:
        parts.append(revenue.revenue(dated(src.purchases, "created_at"), src.products, day))
    if src.subscribers is not None:
        parts.append(dated(src.subscribers, "created_at").groupBy(*day).agg(F.count(F.lit(1)).alias("new_subscribers")))
    if src.videos is not None:
        parts.append(dated(src.videos.where("status = 'published'"), "published_at").groupBy(*day).agg(F.count(F.lit(1)).alias("videos_published")))
    if src.content is not None:
        parts.append(C.content_totals(src.content.withColumnRenamed("event_date", "metric_date"), day))
    if src.logs is not None:
        parts.append(ops.run_counts(dated(src.logs, "started_at"), day))
    return parts


def _so_far(rows: DataFrame, day: Column, amount: Column, start: str, name: str) -> DataFrame:
    """Running total of `amount` per day; days before the range, and rows without a day, fold into one row before its first."""
    first = F.date_sub(F.lit(start).cast("date"), 1)
    return rows.groupBy(F.coalesce(F.greatest(day, first), first).alias("metric_date")).agg(F.sum(amount).alias(name))


def daily_metrics(src: Sources, start: str, end: str) -> DataFrame:
    """Rows for every day in [start, end]; days without data hold zeros.

    Each source is reduced to one row per day before the day spine is joined, so
    a wider range costs no more shuffles than a single day.  Totals are as of the
    end of each day: active subscribers that were there by then, followers gained
    up to then.
    """
    inside = F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    limited = Sources(
        funnel=_between(src.funnel, "created_at", start, end), purchases=_between(src.purchases, "created_at", start, end), products=src.products,
        subscribers=_between(src.subscribers, "created_at", start, end), videos=_between(src.videos, "published_at", start, end),
        content=src.content.where(inside), logs=_between(src.logs, "started_at", start, end))
    last = F.lit(end).cast("date")
    there = src.subscribers.where("status = 'active'").where(F.col("created_at").isNull() | (F.to_date("created_at") <= last))
    followers = src.content.where(F.col("event_date") <= last)
    totals = [_so_far(there, F.to_date("created_at"), F.lit(1), start, "total_subscribers"),
              _so_far(followers, F.col("event_date"), F.col("follower_gain"), start, "total_followers")]
    extra = []
    if src.memberships is not None:
        extra.append(retention(src.memberships, start, end))
    if src.commissions is not None:
        extra.append(payouts_by_day(src.commissions, start, end))
    # Every part has one row per day, so their union is small and meets in one shuffle.
    parts = _spine(src.products, start, end)
    for part in (*day_parts(limited), *totals, *extra):
        parts = parts.unionByName(part, allowMissingColumns=True)
    out = parts.groupBy("metric_date").agg(*[F.max(c).alias(c) for c in parts.columns if c != "metric_date"])
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in out.columns if c not in ("metric_date", "churn_rate")}
    upto = Window.orderBy("metric_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per day of the range
    running = {c: F.sum(c).over(upto) for c in ("total_subscribers", "total_followers")}
    return out.withColumns(zero).withColumns(running).where(F.col("metric_date") >= F.lit(start).cast("date")).withColumn(
        "automation_uptime_pct", X.pct("workflows_run", "workflow_total"))


def daily_close(src: Sources, day: str, path: str) -> DataFrame:
    """Compute one day and replace its partition of the mart; returns the whole mart."""
    row = daily_metrics(src, day, day)
    overwrite_partitions(row, path, "metric_date")
    spark = row.sparkSession
    return spark.read.schema(row.schema).parquet(path)


def reprocess_late(src: Sources, late: DataFrame, at: str, path: str) -> DataFrame:
    """Rebuild the days that late events belong to; all other days stay as they are.

    Only the first and last late day come to the driver.
    """
    days = late.select(F.to_date(at).alias("metric_date")).distinct()
    lo, hi = days.agg(F.min("metric_date"), F.max("metric_date")).first()
    if lo is not None:
        rows = daily_metrics(src, str(lo), str(hi)).join(days, "metric_date", "left_semi")
        overwrite_partitions(rows, path, "metric_date")
    spark = src.products.sparkSession
    return spark.read.schema(daily_metrics(src, "2000-01-01", "2000-01-01").schema).parquet(path)


def snapshot(src: Sources, day: str) -> DataFrame:
    """Dashboard cards of one day."""
    row = daily_metrics(src, day, day)
    return row.select(
        "metric_date", "total_revenue_cents", "new_subscribers", "total_content_views",
        X.pct("lead_magnet_downloads", "landing_page_views").alias("opt_in_pct"),
        X.pct(F.col("tripwire_sales") + F.col("membership_new_sales") + F.col("automation_package_sales"),
              "landing_page_views").alias("sale_pct"),
    )


def revenue_dollars(daily: DataFrame) -> DataFrame:
    return daily.select(
        "metric_date", X.dollars("total_revenue_cents").alias("revenue_dollars"), "tripwire_sales",
        "membership_new_sales", "new_subscribers",
    )


def running(daily: DataFrame) -> DataFrame:
    return funnel.running_totals(
        daily.select("metric_date", "new_followers", "new_subscribers"), "metric_date",
        {"total_followers": "new_followers", "subscribers_so_far": "new_subscribers"},
    )


def kpis(daily: DataFrame) -> DataFrame:
    """(metric, value) rows for the scorecard."""
    sums = daily.agg(
        X.pct(F.sum("lead_magnet_downloads"), F.sum("landing_page_views")).alias("opt_in_pct"),
        X.pct(F.sum("tripwire_sales"), F.sum("lead_magnet_downloads")).alias("lead_to_tripwire_pct"),
        X.pct(F.sum("membership_new_sales"), F.sum("tripwire_sales")).alias("tripwire_to_member_pct"),
        X.pct(F.sum("workflows_run"), F.sum("workflow_total")).alias("workflow_success_pct"),
    )
    return sums.unpivot([], sums.columns, "metric", "value")


def growth_totals(daily: DataFrame) -> DataFrame:
    """One row with what the given days added."""
    return daily.agg(
        F.sum("new_followers").alias("followers"), F.sum("new_subscribers").alias("subscribers"),
        F.sum("total_revenue_cents").alias("revenue_cents"), F.sum("videos_published").alias("videos"),
        F.sum("membership_new_sales").alias("members"),
    )
