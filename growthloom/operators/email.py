"""Subscribers, campaigns, drip schedules."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.functions import exprs as X

# Welcome mails by hours after the start
WELCOME_HOURS = [0, 24, 48, 72, 96]


def subscriber_counts(subs: DataFrame, day: str) -> DataFrame:
    start = F.lit(day).cast("timestamp_ntz")
    new = (F.col("created_at") >= start) & (F.col("created_at") < start + F.expr("interval 1 day"))
    return subs.agg(
        F.count_if(new).alias("new_subscribers"), F.count_if(F.col("status") == "active").alias("total_subscribers")
    )


def campaign_stats(logs: DataFrame) -> DataFrame:
    """Sends, opens, clicks, unsubscribes and their rates per campaign."""
    def n(c: str) -> Column:
        return F.count(F.col(c))

    sums = logs.groupBy("campaign_id").agg(
        n("sent_at").alias("sent"), n("delivered_at").alias("delivered"), n("opened_at").alias("opens"),
        n("clicked_at").alias("clicks"), n("unsubscribed_at").alias("unsubs"),
    )
    return sums.withColumns(
        {
            "open_rate": X.ratio("opens", "sent"),
            "click_rate": X.ratio("clicks", "sent"),
            "click_to_open": X.ratio("clicks", "opens"),
            "unsub_rate": X.ratio("unsubs", "sent"),
        }
    )


def subscriber_stats(logs: DataFrame, purchases: DataFrame) -> DataFrame:
    """Mail totals, last open and click, and spending per subscriber."""
    mails = logs.groupBy("subscriber_id").agg(
        F.count(F.lit(1)).alias("total_emails"), F.count("opened_at").alias("total_opens"),
        F.count("clicked_at").alias("total_clicks"), F.max("opened_at").alias("last_opened_at"),
        F.max("clicked_at").alias("last_clicked_at"),
    )
    money = purchases.where("status = 'completed'").groupBy(F.col("profile_id").alias("subscriber_id")).agg(
        F.sum("amount_cents").alias("ltv_cents")
    )
    return mails.join(money, "subscriber_id", "left").withColumn("ltv_cents", F.coalesce("ltv_cents", F.lit(0)))


def link_clicks(logs: DataFrame) -> DataFrame:
    links = logs.select(F.explode(F.from_json("clicked_links", "array<string>")).alias("link"))
    return links.groupBy("link").agg(F.count(F.lit(1)).alias("clicks"))


def drip_plan(starts: DataFrame, key: str, at: str, as_of: Column, hours: Sequence[int] = tuple(WELCOME_HOURS)) -> DataFrame:
    """Send time of each step of a sequence and its state at `as_of`."""
    steps = F.posexplode(F.array(*[F.lit(h) for h in hours])).alias("_p", "delay_hours")
    plan = starts.select(key, F.col(at).alias("started_at"), steps)
    send = F.col("started_at") + F.make_dt_interval(hours=F.col("delay_hours"))
    return plan.select(
        key, (F.col("_p") + 1).cast("long").alias("step"), F.col("delay_hours").cast("long").alias("delay_hours"),
        send.alias("send_at"), (send <= as_of).alias("is_due"),
    )


def next_step(starts: DataFrame, key: str, at: str, as_of: Column, hours: Sequence[int] = tuple(WELCOME_HOURS)) -> DataFrame:
    """Next step after `as_of`; NULL when the sequence is complete.  No step rows are formed."""
    elapsed = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col(at).cast("timestamp"))) / F.lit(3.6e9)
    sent = sum((F.when(elapsed >= h, 1).otherwise(0) for h in hours), F.lit(0))
    return starts.select(
        key, F.col(at).alias("started_at"), sent.cast("long").alias("sent_steps"),
        F.when(sent < len(hours), sent + 1).cast("long").alias("next_step"),
        (sent >= len(hours)).alias("completed"),
    )


def dormant(subs: DataFrame, as_of: Column, days: int = 30, removal_hours: int = 48) -> DataFrame:
    """Re-engagement step of silent subscribers: 1 after `days`, 2 a day later, 3 (removal) 48 h after that."""
    last = F.greatest("last_opened_at", "last_clicked_at")
    silent = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(last.cast("timestamp"))) / F.lit(3.6e9)
    base = days * 24
    step = (
        F.when(silent >= base + 24 + removal_hours, 3).when(silent >= base + 24, 2).when(silent >= base, 1).otherwise(0)
    )
    return subs.select("id", "email", last.alias("last_activity_at"), step.cast("long").alias("step")).where("step > 0")
