"""Workflow health, alerts, latency, scorecards, report text."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.functions import exprs as X
from growthloom.functions.sketches import SKETCH, quantile, sketch
from growthloom.operators.filters import lookback
from growthloom.plans import keyed

SUCCESS_FLOOR = 95.0
# Metric, comparison, target
TARGETS = [
    ("opt_in_pct", ">", 20.0),
    ("lead_to_tripwire_pct", ">", 3.0),
    ("tripwire_to_member_pct", ">", 10.0),
    ("churn_pct", "<", 8.0),
    ("workflow_success_pct", ">", 95.0),
]
# Growth targets at the end of each horizon; money in cents
GROWTH_TARGETS = {
    "30 days": [("followers", 2_000), ("subscribers", 500), ("revenue_cents", 50_000), ("videos", 30)],
    "90 days": [("followers", 20_000), ("subscribers", 5_000), ("revenue_cents", 500_000), ("videos", 90)],
    "month 1": [("followers", 10_000), ("subscribers", 2_000), ("members", 0), ("revenue_cents", 200_000)],
    "month 2": [("followers", 50_000), ("subscribers", 10_000), ("members", 150), ("revenue_cents", 500_000)],
    "month 3": [("followers", 100_000), ("subscribers", 25_000), ("members", 400), ("revenue_cents", 1_000_000)],
}

FAST_SECONDS = 30.0  # a run below this is fast


def run_counts(logs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return logs.groupBy(*by).agg(
        F.count_if(F.col("status") == "success").alias("workflows_run"),
        F.count_if(F.col("status") == "failed").alias("workflows_failed"),
        F.count(F.lit(1)).alias("workflow_total"),
    )


def health(workflows: DataFrame, logs: DataFrame, as_of: Column, span: str = "24 hours", keep_idle: bool = True) -> DataFrame:
    """Failures, successes and success share per workflow; logs are summed before the join."""
    sums = lookback(logs, "started_at", as_of, span).groupBy(F.col("workflow_id").alias("id")).agg(
        F.count_if(F.col("status") == "failed").alias("failures"),
        F.count_if(F.col("status") == "success").alias("successes"),
        F.count(F.lit(1)).alias("runs"),
    )
    joined = workflows.select("id", "name").join(sums, "id", "left" if keep_idle else "inner")
    return joined.select(
        "id", "name",
        F.coalesce("failures", F.lit(0)).alias("failures"), F.coalesce("successes", F.lit(0)).alias("successes"),
        X.pct("successes", "runs").alias("success_rate"),
    )


def health_gate(report: DataFrame, floor: float = SUCCESS_FLOOR) -> DataFrame:
    """Workflows with their verdict, plus whether all pass."""
    low = F.coalesce(F.col("success_rate") < floor, F.lit(False))
    failing = report.agg(F.count_if(low).alias("n")).scalar()
    return report.select(
        "id", "name", "success_rate", low.alias("below_floor"), X.health_band("success_rate").alias("band"),
        (failing == 0).alias("all_pass"),
    )


def failure_counts(logs: DataFrame, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Failures and runs per workflow and window; works on a stream with a watermark too."""
    span = F.window("started_at", window, slide) if slide else F.window("started_at", window)
    sums = logs.groupBy("workflow_id", span.alias("w")).agg(
        F.count_if(F.col("status") == "failed").alias("failures"), F.count(F.lit(1)).alias("runs")
    )
    return sums.select("workflow_id", F.col("w.start").alias("window_start"), "failures", "runs")


def alerts(counts: DataFrame, failures: int = 3, share: float = 0.5) -> DataFrame:
    """Windows with enough failures, or with at least that share of failed runs."""
    high = F.col("failures") >= failures
    half = F.col("failures") >= F.col("runs") * F.lit(share)
    reason = F.when(high, "failure_count").otherwise("failure_share")
    return counts.where((F.col("failures") > 0) & (high | half)).withColumn("reason", reason)


def failure_alerts(logs: DataFrame, window: str = "1 hour", slide: str | None = None, failures: int = 3,
                   share: float = 0.5) -> DataFrame:
    return alerts(failure_counts(logs, window, slide), failures, share)


def uptime(logs: DataFrame) -> DataFrame:
    sums = run_counts(logs, ["day"]) if "day" in logs.columns else run_counts(
        logs.withColumn("day", F.to_date("started_at")), ["day"]
    )
    rate = X.pct("workflows_run", "workflow_total")
    return sums.select("day", "workflow_total", rate.alias("uptime_pct"), (rate >= 99).alias("goal_met"))


def latency_by_day(logs: DataFrame, seconds: Column) -> DataFrame:
    """Run times per workflow and day: count, fast runs, greatest, and a sketch; what a store keeps and any range is made of."""
    return logs.withColumn("_s", seconds.cast("double")).groupBy("workflow_id", F.to_date("started_at").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("_s") < FAST_SECONDS).alias("fast"), F.max("_s").alias("max_s"),
        sketch("_s").alias("times"))


def latency(days: DataFrame) -> DataFrame:
    """Run time per workflow over the given days, from their sketches: memory does not grow with the distinct durations."""
    sums = days.groupBy("workflow_id").agg(
        F.sum("runs").alias("runs"), F.sum("fast").alias("fast"), F.max("max_s").alias("max_s"), F.kll_merge_agg_double("times", SKETCH).alias("_t"))
    return sums.select(
        "workflow_id", "runs", F.round(quantile("_t", 0.5), 3).alias("p50_s"), F.round(quantile("_t", 0.95), 3).alias("p95_s"),
        "max_s", X.ratio("fast", "runs").alias("fast_share"))


def latency_exact(logs: DataFrame, seconds: Column, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Run time per workflow with exact percentiles, interpolated between the two runs around a rank.

    Equal durations are counted first; a scan then ranks the distinct ones and cuts workflows with very many of them, so no task
    holds a workflow's durations.
    """
    counted = logs.select("workflow_id", seconds.cast("double").alias("_s")).groupBy("workflow_id", "_s").agg(F.count(F.lit(1)).alias("_runs"))
    sums = counted.groupBy(F.col("workflow_id").alias("_w")).agg(
        F.sum("_runs").alias("runs"), F.sum(F.when(F.col("_s") < FAST_SECONDS, F.col("_runs")).otherwise(0)).alias("fast"),
        F.max("_s").alias("max_s"), F.sum(F.when(F.col("_s").isNotNull(), F.col("_runs"))).alias("_timed"))
    ranked = keyed.scan_by_key(counted.where("_s is not null").withColumn("_whole", F.floor("_s")), ["workflow_id"], "_whole", ["_s"],
                               {"_upto": ("sum", "_runs")}, rows)
    marks = {"p50_s": 0.5, "p95_s": 0.95}
    place = {c: F.lit(share) * (F.col("_timed") - 1) for c, share in marks.items()}
    ends = [F.min(F.when(F.col("_upto") > end(at), F.col("_s"))).alias(f"_{c}_{end.__name__}") for c, at in place.items() for end in (F.floor, F.ceil)]
    kept = ["_w", "runs", "fast", "max_s", "_timed"]
    found = sums.join(ranked, F.col("_w").eqNullSafe(F.col("workflow_id")), "left").groupBy(*kept).agg(*ends)

    def between(c: str) -> Column:
        share = place[c] - F.floor(place[c])
        return F.round(F.col(f"_{c}_floor") * (1 - share) + F.col(f"_{c}_ceil") * share, 3).alias(c)

    return found.select(F.col("_w").alias("workflow_id"), "runs", between("p50_s"), between("p95_s"), "max_s", X.ratio("fast", "runs").alias("fast_share"))


def scorecard(kpis: DataFrame, targets: Sequence[tuple[str, str, float]] = tuple(TARGETS)) -> DataFrame:
    """(metric, value) rows against their targets."""
    rows = F.array(
        *[F.struct(F.lit(m).alias("m"), F.lit(op).alias("op"), F.lit(t).alias("target")) for m, op, t in targets]
    )
    goal = F.element_at(F.filter(rows, lambda r: r["m"] == F.col("metric")), 1)
    listed = kpis.where(F.col("metric").isin([m for m, _, _ in targets])).withColumn("_g", goal)
    met = F.when(F.col("_g.op") == ">", F.col("value") > F.col("_g.target")).otherwise(
        F.col("value") < F.col("_g.target")
    )
    return listed.select("metric", "value", F.col("_g.op").alias("comparison"), F.col("_g.target").alias("target"),
                         met.alias("met"))


def growth_scorecard(totals: DataFrame, targets: dict[str, list[tuple[str, int]]] = GROWTH_TARGETS) -> DataFrame:
    """One row of totals against the targets of every horizon that names them."""
    rows = [
        F.struct(
            F.lit(horizon).alias("horizon"), F.lit(metric).alias("metric"), F.col(metric).cast("long").alias("value"),
            F.lit(goal).cast("long").alias("target"), (F.col(metric) >= goal).alias("met"),
        )
        for horizon, goals in targets.items()
        for metric, goal in goals
        if metric in totals.columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def render_summary(daily: DataFrame) -> DataFrame:
    """One line of report text per day."""
    line = F.concat_ws(
        " | ",
        F.date_format("metric_date", "yyyy-MM-dd"),
        F.concat(F.lit("revenue $"), X.to_fixed("total_revenue_cents")),
        F.concat(F.lit("subscribers +"), F.col("new_subscribers").cast("string")),
        F.concat(F.lit("views "), F.col("total_content_views").cast("string")),
        F.concat(F.lit("runs "), F.col("workflows_run").cast("string"), F.lit(" ok, "),
                 F.col("workflows_failed").cast("string"), F.lit(" failed")),
    )
    return daily.select("metric_date", line.alias("line"))


def kpi_rates(daily: DataFrame) -> DataFrame:
    """View-to-lead and lead-to-tripwire per cent over the given days."""
    return daily.agg(
        X.pct(F.sum("new_subscribers"), F.sum("total_content_views")).alias("view_to_lead_cr"),
        X.pct(F.sum("tripwire_sales"), F.sum("new_subscribers")).alias("lead_to_tripwire_cr"),
    )
