"""Streaming forms of the event rules, by Spark's own stateful operators.

Every input has a zoned event time.  Aggregates combine map-side before the
state store, so one very active key does not load one task with its raw rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import ops


def stream_funnel(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and revenue per stage and tumbling window."""
    return (
        events.withWatermark("created_at", late)
        .groupBy(F.window("created_at", window).alias("w"), "stage")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("revenue_cents").alias("revenue_cents"))
        .select(F.col("w.start").alias("window_start"), "stage", "events", "revenue_cents")
    )


def stream_failure_counts(logs: DataFrame, window: str = "1 hour", slide: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Run counts over sliding windows.

    The alert rule is applied to the newest counts when they are read: a window
    that was half failed can recover with later runs, and a filter inside the
    stream could not take such an alert back.
    """
    return ops.failure_counts(logs.withWatermark("started_at", late), window, slide)


def stream_dedup(messages: DataFrame, key: str, at: str, horizon: str = "3 days") -> DataFrame:
    """Drop redelivered messages; senders retry for three days."""
    return messages.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])


def stream_sessions(events: DataFrame, person: str, ts: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions, emitted once they are closed."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.session_window(ts, gap).alias("w"), person)
        .agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("ended_at"))
        .select(person, F.col("w.start").alias("started_at"), "ended_at", "events")
    )


def stream_members(rows: DataFrame) -> DataFrame:
    """Current state of every subscription: the newest message by (time, id) wins in
    whatever order messages arrive.  Run in update mode."""
    newest = F.max_by(F.struct("status", "price_cents", "current_period_start", "id"), F.struct("received_at", "id"))
    return rows.groupBy("stripe_subscription_id").agg(newest.alias("m"), F.count(F.lit(1)).alias("messages")).select(
        "stripe_subscription_id", "m.status", "m.price_cents", "m.current_period_start", F.col("m.id").alias("last_id"),
        "messages",
    )


def stream_daily_stages(events: DataFrame) -> DataFrame:
    """Running totals per day and stage, for the upsert sink.  Run in update mode."""
    return events.groupBy(F.to_date("created_at").alias("day"), "stage").agg(
        F.count(F.lit(1)).alias("events"), F.sum("revenue_cents").alias("revenue_cents")
    )
