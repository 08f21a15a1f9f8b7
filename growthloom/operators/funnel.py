"""Funnel volumes, conversion and time-ordered progress."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from growthloom.functions import exprs as X
from growthloom.plans import keyed
from growthloom.schemas import STAGES

FUNNEL_ROWS = 250_000  # events of one person that are folded at once

# Fixed values -----------------------------------------------------------------
# report stage, counted stages, stage its share is taken of, benchmark per cent
REPORT_STAGES = [
    ("content_views", ["content_view"], None, None),
    ("profile_visits", ["profile_visit"], "content_views", 5.0),
    ("lp_visits", ["landing_page_view"], "profile_visits", 60.0),
    ("email_optins", ["lead_magnet_download"], "lp_visits", 20.0),
    ("product_views", ["tripwire_view"], "email_optins", 15.0),
    ("total_sales", ["tripwire_purchase", "membership_purchased", "automation_package_purchase"], "lp_visits", 3.0),
]
# -----------------------------------------------------------------------------


def funnel_counts(events: DataFrame, by: Sequence[str] = (), stages: Sequence[str] = tuple(STAGES)) -> DataFrame:
    """One conditional count per stage in a single pass."""
    return events.groupBy(*by).agg(*[F.count_if(F.col("stage") == s).alias(s) for s in stages])


def funnel_table(events: DataFrame) -> DataFrame:
    """Stage volume, share of the stage before, benchmark and a health label."""
    wide = events.agg(*[F.count_if(F.col("stage").isin(s)).alias(n) for n, s, _, _ in REPORT_STAGES])
    rows = []
    for pos, (name, _, base, bench) in enumerate(REPORT_STAGES, 1):
        share = X.pct(F.col(name), F.col(base)) if base else F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(pos).cast("long").alias("position"), F.lit(name).alias("stage"), F.col(name).alias("volume"),
                share.alias("conversion_pct"), F.lit(bench).cast("double").alias("benchmark_pct"),
            )
        )
    long = wide.select(F.inline(F.array(*rows)))
    health = (
        F.when(F.col("benchmark_pct").isNull(), F.lit(None))
        .when(F.coalesce(F.col("conversion_pct"), F.lit(0.0)) == 0, "blocked")
        .when(F.col("conversion_pct") < F.col("benchmark_pct"), "leaking")
        .otherwise("optimal")
    )
    return long.withColumn("health", health)


def time_to_convert(events: DataFrame, conversions: Sequence[str], rows: int = keyed.HOT_ROWS) -> DataFrame:
    """For each conversion: seconds since the person's previous event and since the first touch."""
    scanned = keyed.scan_by_key(
        events.select("id", "person", "stage", "created_at"),
        ["person"], "created_at", ["id"],
        {"_prev": ("lag", "created_at"), "_prev_stage": ("lag", "stage"), "_first": ("min", "created_at")},
        rows,
    )
    return scanned.where(F.col("stage").isin(list(conversions))).select(
        "id", "person", "stage",
        F.col("_prev_stage").alias("previous_stage"),
        X.session_seconds("_prev", "created_at").alias("seconds_since_previous"),
        X.session_seconds("_first", "created_at").alias("seconds_since_first"),
    )


def _walk(names: Column, events: Column, start: Column) -> Column:
    """Stages reached and the time of the last one after the events in time order, from such a state on."""
    def step(state: Column, e: Column) -> Column:
        later = state["t"].isNull() | (e["at"] > state["t"])
        return F.when((e["stage"] == F.get(names, state["n"])) & later, F.struct((state["n"] + 1).alias("n"), e["at"].alias("t"))).otherwise(state)

    return F.aggregate(events, start, step)


def _state(n: Column, t: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), t.cast("long").alias("t"))


def strict_funnel(events: DataFrame, stages: Sequence[str], rows: int = FUNNEL_ROWS) -> DataFrame:
    """Persons who reach each stage after the one before, in time order; events of one instant do not follow each other.

    One scan; the events are shuffled once, by person and slice.  A slice of a hot person is folded into what it does to any
    state it may be entered in: stages held on entry, and whether the last of them was reached at the slice's first instant.
    These summaries are composed in order per person, like a prefix sum.  An ordinary person has one slice and needs the
    first entry only.  Events without a person or a time are not counted.
    """
    none, count = F.lit(None), len(stages)
    names = F.array(*[F.lit(s) for s in stages])
    only = events.where(F.col("stage").isin(list(stages)) & F.col("person").isNotNull() & F.col("created_at").isNotNull()).select(
        "person", "stage", keyed.micros(F.col("created_at")).alias("at"))
    cut = keyed.slice_hot_keys(only, ["person"], "at", rows, tie=["stage"])
    slices = cut.groupBy("person", "_hot", "_slice").agg(F.array_sort(F.collect_set(F.struct("at", "stage"))).alias("_e"))
    first = F.col("_e")[0]["at"]
    entered = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(2 * count + 1))).otherwise(F.array(F.lit(0)))
    effects = F.transform(entered, lambda k: _walk(names, F.col("_e"), _state(F.floor(k / 2), F.when(k % 2 == 1, first))))
    done = slices.select("person", F.struct(F.col("_slice").alias("no"), first.alias("first"), effects.alias("effects")).alias("_s"))
    whole = done.groupBy("person").agg(F.array_sort(F.collect_list("_s")).alias("_s"))  # one entry per slice

    def compose(state: Column, s: Column) -> Column:
        after = F.get(s["effects"], state["n"] * 2 + F.coalesce(state["t"] == s["first"], F.lit(False)).cast("int"))
        return _state(after["n"], F.coalesce(after["t"], state["t"]))

    reached = whole.select(F.aggregate("_s", _state(F.lit(0), none), compose)["n"].alias("n"))
    totals = reached.agg(*[F.count_if(F.col("n") >= pos).alias(f"_{pos}") for pos in range(1, count + 1)])
    out = [F.struct(F.lit(pos).cast("long").alias("position"), F.lit(name).alias("stage"), F.col(f"_{pos}").alias("persons"))
           for pos, name in enumerate(stages, 1)]
    return totals.select(F.inline(F.array(*out)))


def sessions(events: DataFrame, person: str, ts: str, page: str, event_id: str, gap_seconds: int = 1800) -> DataFrame:
    """Visits separated by more than `gap_seconds` of silence.

    Rows are first folded into (person, time bin) with bins no wider than the
    gap: two rows of one bin always share a visit, so only bins have to be put
    in order.  A person has at most span/gap bins however many rows there are.
    """
    at = keyed.micros(F.col(ts))
    width = gap_seconds * 1_000_000
    place = F.struct(at, F.col(event_id))
    bins = events.groupBy(F.col(person), F.floor(at / F.lit(width)).alias("_bin")).agg(
        F.min(at).alias("_lo"), F.max(at).alias("_hi"), F.count(F.lit(1)).alias("_n"),
        F.min_by(F.col(page), place).alias("_page"),
    )
    order = Window.partitionBy(person).orderBy("_bin")
    fresh = F.col("_lo") - F.lag("_hi").over(order) > width
    marked = bins.withColumn("_new", F.when(F.coalesce(fresh, F.lit(True)), 1).otherwise(0))
    numbered = marked.withColumn("session_no", F.sum("_new").over(order).cast("long"))
    out = numbered.groupBy(person, "session_no").agg(
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_n").alias("events"),
        F.min_by("_page", "_bin").alias("landing_page"),
    )
    return out.select(
        person, "session_no",
        F.timestamp_micros("_lo").cast("timestamp_ntz").alias("started_at"),
        F.timestamp_micros("_hi").cast("timestamp_ntz").alias("ended_at"),
        F.round((F.col("_hi") - F.col("_lo")) / F.lit(1e6)).cast("long").alias("duration_seconds"),
        "events", "landing_page",
    )


UTM = ("utm_source", "utm_medium", "utm_campaign")


def utm_report(events: DataFrame, purchases: DataFrame, by: Sequence[str] = UTM) -> DataFrame:
    """Visits, leads, purchases and revenue per source, medium and campaign, with subtotals.

    Both sides are reduced to the full key first; the subtotals are made from
    those sums, so events are neither joined nor expanded.
    """
    visits = events.groupBy(*by).agg(
        F.count_if(F.col("stage") == "landing_page_view").alias("visits"),
        F.count_if(F.col("stage") == "lead_magnet_download").alias("leads"),
    )
    bought = purchases.where("status = 'completed'").groupBy(*by).agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("amount_cents").alias("revenue_cents")
    )
    both = visits.unionByName(bought, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("visits", "leads", "purchases", "revenue_cents")]
    return both.rollup(*by).agg(*sums, F.grouping_id().cast("long").alias("level"))


def running_totals(daily: DataFrame, day: str, columns: dict[str, str]) -> DataFrame:
    """Cumulative sums over daily rows (one row per day, so the single window is small)."""
    upto = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("*", *[F.sum(c).over(upto).alias(n) for n, c in columns.items()])
