"""Membership state, churn, recurring revenue, lifecycle."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from growthloom.functions import exprs as X
from growthloom.operators import filters
from growthloom.operators.joins import members
from growthloom.plans import keyed


def churn(memberships: DataFrame, start: Column, end: Column) -> DataFrame:
    """Members at the start of [start, end), those who ended in it, and the rate."""
    there = (F.col("created_at") < start) & (F.col("ended_at").isNull() | (F.col("ended_at") >= start))
    left = there & (F.col("ended_at") < end)
    counts = memberships.agg(F.count_if(there).alias("members_at_start"), F.count_if(left).alias("churned"))
    return counts.withColumns(
        {
            "active_members": F.col("members_at_start") - F.col("churned"),
            "churn_rate": X.ratio("churned", "members_at_start", 4),
        }
    )


def churn_reasons(memberships: DataFrame, as_of: Column) -> DataFrame:
    gone = filters.lookback(memberships.where("status = 'canceled'"), "ended_at", as_of, "24 hours")
    return gone.groupBy("cancellation_reason").agg(F.count(F.lit(1)).alias("churned"))


def mrr(memberships: DataFrame, until: Column) -> DataFrame:
    """Monthly recurring revenue by month; yearly plans count a twelfth.

    Every membership adds its amount in its first month and takes it back in the
    month after its last one; the running sum of those changes is the revenue.
    """
    amount = F.when(F.col("plan") == "year", F.floor(F.col("price_cents") / 12)).otherwise(F.col("price_cents"))
    last = F.least(F.coalesce("ended_at", until), until)
    first_month = F.trunc(F.to_date("created_at"), "month")
    after = F.add_months(F.trunc(F.to_date(last), "month"), 1)
    rows = memberships.where(F.col("created_at") <= last).select(
        F.explode(
            F.array(
                F.struct(first_month.alias("month"), amount.alias("delta"), F.lit(1).alias("n")),
                F.struct(after.alias("month"), (-amount).alias("delta"), F.lit(-1).alias("n")),
            )
        ).alias("c")
    ).select("c.*")
    changes = rows.groupBy("month").agg(F.sum("delta").alias("delta"), F.sum("n").alias("n"))
    spine = changes.agg(F.min("month").alias("lo")).select(
        F.explode(F.sequence("lo", F.trunc(F.to_date(until), "month"), F.expr("interval 1 month"))).alias("month")
    )
    upto = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spine.join(changes, "month", "left").select(
        "month",
        F.coalesce(F.sum("delta").over(upto), F.lit(0)).cast("long").alias("mrr_cents"),
        F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("long").alias("members"),
    )


def transitions(payments: DataFrame, person: str, price: str, at: str, order_id: str, rows: int = keyed.HOT_ROWS,
                jump: float = 1.5, pause_days: int = 365) -> DataFrame:
    """Lifecycle event of each payment against the one before it."""
    scanned = keyed.scan_by_key(
        payments.select(person, price, at, order_id), [person], at, [order_id],
        {"previous_price": ("lag", price), "_before": ("lag", at)}, rows,
    )
    kind = _lifecycle(F.col(price), F.col("previous_price"), F.col(at), F.col("_before"), jump, pause_days)
    return scanned.withColumn("event_type", kind).drop("_before")


def _lifecycle(now: Column, prev: Column, at: Column, before: Column, jump: float, pause_days: int) -> Column:
    return (
        F.when(prev.isNull(), "created")
        .when(now > prev * F.lit(jump), "upgraded")
        .when(now * F.lit(jump) < prev, "downgraded")
        .when(F.datediff(at, before) > pause_days, "reactivated")
        .otherwise("renewed")
    )


def transition_changes(past: DataFrame, fresh: DataFrame, person: str, price: str, at: str, order_id: str, rows: int = keyed.HOT_ROWS,
                       jump: float = 1.5, pause_days: int = 365) -> DataFrame:
    """What fresh payments change in `transitions` of the past ones: rows with sign -1 that no longer hold, with sign 1 that do now.

    One scan over both: beside the payment before it, a past payment finds the one that was before it without the fresh ones.
    """
    cols = [person, price, at, order_id]
    both = past.select(*cols, F.lit(False).alias("_new")).unionByName(fresh.select(*cols, F.lit(True).alias("_new")))
    known = F.when(~F.col("_new"), F.struct(F.col(at).alias("at"), F.col(order_id).alias("tie"), F.col(price).alias("price")))
    scanned = keyed.scan_by_key(
        both, [person], at, [order_id],
        {"previous_price": ("lag", price), "_before": ("lag", at), "_known": ("max_before", known)}, rows,
    )

    def state(sign: int, prev: Column, before: Column) -> Column:
        kind = _lifecycle(F.col(price), prev, F.col(at), before, jump, pause_days)
        return F.struct(prev.alias("previous_price"), kind.alias("event_type"), F.lit(sign).alias("sign"))

    now, was = state(1, F.col("previous_price"), F.col("_before")), state(-1, F.col("_known.price"), F.col("_known.at"))
    same = now["previous_price"].eqNullSafe(was["previous_price"]) & (now["event_type"] == was["event_type"])
    return scanned.select(*cols, F.inline(F.when(F.col("_new"), F.array(now)).when(~same, F.array(now, was)).otherwise(F.slice(F.array(now), 1, 0))))


def churn_report(memberships: DataFrame, profiles: DataFrame, as_of: Column, days: int = 5) -> DataFrame:
    """Members renewing soon, cancelling, past due or just gone, in one scan and one join."""
    due = F.col("current_period_end").between(as_of, as_of + F.expr(f"interval {days} days"))
    live = F.col("status").isin("active", "trialing")
    gone = (F.col("status") == "canceled") & (F.col("ended_at") >= as_of - F.expr("interval 24 hours")) & (
        F.col("ended_at") <= as_of
    )
    kind = (
        F.when(live & due & ~F.col("cancel_at_period_end"), "renewing_soon")
        .when(live & due, "cancelling")
        .when(F.col("status").isin("past_due", "incomplete"), "past_due")
        .when(gone, "churned")
    )
    picked = memberships.withColumn("category", kind).where("category is not null")
    return members(picked, profiles)


def touchpoints(starts: DataFrame, key: str, at: str, as_of: Column, days: tuple[int, ...] = (1, 2, 7, 14, 30)) -> DataFrame:
    """Due date of every follow-up after a start, and whether it is due."""
    steps = F.explode(F.array(*[F.lit(d) for d in days])).alias("day")
    plan = starts.select(key, at, steps)
    due = F.date_add(F.to_date(at), F.col("day"))
    return plan.select(key, F.col("day").cast("long").alias("day"), due.alias("due_on"), (due <= F.to_date(as_of)).alias("is_due"))
