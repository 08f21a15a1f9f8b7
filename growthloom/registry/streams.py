"""Queries that run a stream over a whole table to the end of its input."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import ops
from growthloom.plans import delta_mart
from growthloom.plans.daily import Sources
from growthloom.plans.membership import subscription_rows
from growthloom.registry.aggregates import SLIDES, _ALERT
from growthloom.registry.composites import _BOOKED_SUBSCRIBERS, books, sent_twice
from growthloom.registry.core import op
from growthloom.session import scratch_path
from growthloom.sources.fixtures import Tables, checkout_view, funnel_view, lead_view, subscription_view
from growthloom.streaming import jobs, sinks
from growthloom.streaming.runner import as_ntz, run_append, run_update
from growthloom.streaming.sources import read_events, replay


def _events(t: Tables) -> DataFrame:
    return read_events(t.spark, t.dir)


def _funnel(t: Tables) -> DataFrame:
    return funnel_view(_events(t))


@op("stream_funnel_counts", """SELECT date_trunc('hour', created_at) AS window_start, stage, count(*) AS events, CAST(sum(revenue_cents) AS BIGINT) AS revenue_cents
    FROM fe GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    out = run_update(jobs.stream_funnel(_funnel(t)), "stream-funnel", ["window_start", "stage"])
    return as_ntz(out, "window_start")


@op("stream_failure_alerts", _ALERT.format(w="ws", src=SLIDES))
def _(t: Tables) -> DataFrame:
    logs = _events(t).select(
        (F.col("user_id") % 8).alias("workflow_id"), F.col("ts").alias("started_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
    )
    counts = run_update(jobs.stream_failure_counts(logs), "stream-alerts", ["workflow_id", "window_start"])
    return as_ntz(ops.alerts(counts), "window_start")


@op("stream_dedup", "SELECT event_id, event_type FROM events")
def _(t: Tables) -> DataFrame:
    first = _events(t).select("event_id", "event_type", "ts")
    again = first.withColumn("ts", F.col("ts") + F.expr("interval 2 days"))
    return run_append(jobs.stream_dedup(first.union(again), "event_id", "ts"), "stream-dedup").select("event_id", "event_type")


@op("stream_sessions", """SELECT user_id, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS events FROM
    (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM
      (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM ev
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id, session_no
    HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) FROM ev) - INTERVAL 10 MINUTE""")
def _(t: Tables) -> DataFrame:
    out = run_append(jobs.stream_sessions(_events(t), "user_id", "ts"), "stream-sessions")
    return as_ntz(out, "started_at", "ended_at")


@op("stream_attribution", """SELECT b.user_id, b.event_id AS id, b.ts AS at, c.event_id AS click_id, c.ts AS clicked_at FROM
    (SELECT * FROM ev WHERE event_type = 'purchase') b ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type = 'click') c
    ON c.user_id = b.user_id AND c.ts <= b.ts""")
def _(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", 0).otherwise(1)
    both = _events(t).where(F.col("event_type").isin("click", "purchase")).select(
        "user_id", F.col("event_id").alias("id"), F.col("ts").alias("at"), kind.alias("kind")
    )
    out = sinks.run_attribution(both, lambda p: sinks.AttributionSink(p, "user_id", 60), "stream-attribution")
    return as_ntz(out, "at", "clicked_at")


@op("stream_abandoned", """SELECT s.person, s.id, s.created_at AS at FROM fe s WHERE s.stage IN ('tripwire_view','membership_view')
    AND s.created_at + INTERVAL 1 HOUR <= (SELECT max(created_at) FROM fe) - INTERVAL 10 MINUTE
    AND NOT EXISTS (SELECT 1 FROM fe b WHERE b.person = s.person AND b.stage IN ('tripwire_purchase','membership_purchased')
      AND b.created_at >= s.created_at AND b.created_at <= s.created_at + INTERVAL 1 HOUR)""")
def _(t: Tables) -> DataFrame:
    kind = (
        F.when(F.col("stage").isin("tripwire_view", "membership_view"), 1)
        .when(F.col("stage").isin("tripwire_purchase", "membership_purchased"), 0)
        .otherwise(2)
    )
    rows = _funnel(t).select("person", "id", F.col("created_at").alias("at"), kind.alias("kind"))
    out = sinks.run_sink(rows, lambda p: sinks.AbandonedSink(p, "person"), "stream-abandoned", "abandoned")
    return as_ntz(out, "at")


@op("stream_membership_state", """SELECT 'sub_' || o_custkey AS stripe_subscription_id, arg_max(CASE WHEN o_orderkey % 11 = 1 THEN 'canceled'
      WHEN o_orderstatus = 'P' THEN 'past_due' ELSE 'active' END, (o_orderdate, o_orderkey)) AS status, arg_max(price_cents, (o_orderdate, o_orderkey)) AS price_cents,
      max(o_orderdate) AS current_period_start, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_id, count(*) AS messages FROM orr GROUP BY o_custkey""")
def _(t: Tables) -> DataFrame:
    orders = replay(t.raw("orders"), "o_orderdate")
    rows = subscription_rows(subscription_view(orders))
    return run_update(jobs.stream_members(rows), "stream-members", ["stripe_subscription_id"])


@op("stream_upsert", """SELECT CAST(created_at AS DATE) AS day, stage, count(*) AS events, CAST(sum(revenue_cents) AS BIGINT) AS revenue_cents FROM fe GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    return sinks.run_upsert(
        jobs.stream_daily_stages(_funnel(t)), "stream-upsert", ["day", "stage"], ["events", "revenue_cents"]
    )


@op("stream_drip", """SELECT user_id AS subscriber_id, CAST(i + 1 AS BIGINT) AS step, t0 + to_hours(CAST(i * 24 AS INTEGER)) AS send_at FROM
    (SELECT user_id, min(ts) AS t0 FROM ev WHERE event_type = 'signup' GROUP BY 1), (SELECT unnest(range(5)) AS i)
    WHERE t0 + to_hours(CAST(i * 24 AS INTEGER)) <= (SELECT max(ts) FROM ev) - INTERVAL 1 HOUR""")
def _(t: Tables) -> DataFrame:
    rows = _events(t).select(
        F.col("user_id").alias("subscriber_id"), F.col("ts").alias("at"), (F.col("event_type") == "signup").alias("is_start")
    )
    return as_ntz(sinks.run_sink(rows, sinks.DripSink, "stream-drip", "steps"), "send_at")


@op("late_events", """SELECT o_orderkey AS id, o_orderdate AS at FROM orders WHERE o_orderdate < (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 1800 DAY""")
def _(t: Tables) -> DataFrame:
    rows = t.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"))
    seen = t.raw("lineitem").agg(F.max("l_shipdate")).scalar()
    return sinks.split_late(rows, "at", seen, "1800 days")[1]


@op("stream_purchase_intake", """SELECT 'purchase' AS kind, ev.event_id AS id, CAST(k AS BIGINT) AS ref, val_cents AS amount_cents FROM ev JOIN dp ON dp.id = ev.k WHERE event_type = 'purchase'
    UNION ALL SELECT 'subscription', event_id, NULL, val_cents FROM ev WHERE event_type = 'signup'
    UNION ALL SELECT 'skipped', event_id, NULL, val_cents FROM ev WHERE event_type NOT IN ('purchase','signup')
    UNION ALL SELECT 'commission', id, affiliate_id, CASE tier WHEN 'premium' THEN CAST(floor(base * 1.1::DOUBLE + 0.5) AS BIGINT)
      WHEN 'elite' THEN CAST(floor(base * 1.25::DOUBLE + 0.5) AS BIGINT) ELSE CAST(base AS BIGINT) END FROM
      (SELECT ev.event_id AS id, af.id AS affiliate_id, af.tier,
         floor(CAST(val_cents AS DOUBLE) * (CASE dp.product_type WHEN 'membership' THEN 30 WHEN 'automation_package' THEN 20 ELSE 40 END / 100.0::DOUBLE) + 0.5) AS base
       FROM ev JOIN dp ON dp.id = ev.k JOIN af ON af.id = ev.k % 10 AND af.is_active WHERE event_type = 'purchase')""")
def _(t: Tables) -> DataFrame:
    events = _events(t)
    rows = checkout_view(events.withColumn("affiliate_id", (F.col("k") % 10).cast("long")), keep=("affiliate_id",))
    path = scratch_path(t.spark, "stream-intake")
    sink = sinks.IntakeSink(path, t.products, t.profiles, t.affiliates)
    sinks.run_batches(rows, sink, f"{path}-checkpoint")
    none = F.lit(None).cast("long")

    def table(name: str, kind: str, key: str, ref) -> DataFrame:
        df = t.spark.read.parquet(f"{path}/{name}")
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), ref.alias("ref"), "amount_cents")

    return (
        table("purchases", "purchase", "id", F.col("product_id")).unionAll(table("subscriptions", "subscription", "id", none))
        .unionAll(table("skipped", "skipped", "id", none))
        .unionAll(table("commissions", "commission", "purchase_id", F.col("affiliate_id")))
    )


@op("stream_lead_capture", """SELECT email, min(received_at) AS created_at FROM (SELECT ts AS received_at,
      'customer.' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.com' AS email FROM ev WHERE event_type = 'signup' AND event_id % 10 <> 7)
    WHERE email NOT IN (SELECT email FROM su WHERE ltv_cents >= 60000) GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    rows = lead_view(_events(t))
    known = t.subscribers.where("ltv_cents >= 60000")
    out = sinks.run_sink(rows, lambda p: sinks.LeadSink(p, known), "stream-leads", "new_subscribers")
    return as_ntz(out.select("email", "created_at"), "created_at")


@op("stream_booked_subscribers", _BOOKED_SUBSCRIBERS)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream-booking")
    sink = sinks.BookingSink(path, t.products, books(t))
    sinks.run_batches(replay(sent_twice(t), "received_at"), sink, f"{path}-checkpoint")
    return sink.read(t.spark).subscribers.drop("full_name")


@op("stream_late_mart", """SELECT CAST(ts AS DATE) AS metric_date, count(*) FILTER (event_type = 'view' AND k >= 50 AND k < 95) AS profile_visits,
    count(*) FILTER (event_type = 'click' AND k < 50) AS landing_page_views, count(*) FILTER (event_type = 'signup' AND k < 70) AS lead_magnet_downloads,
    count(*) FILTER (event_type = 'purchase' AND k < 60) AS tripwire_sales, count(*) FILTER (event_type <> 'error') AS workflows_run,
    count(*) FILTER (event_type = 'error') AS workflows_failed FROM ev GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    # Every fiftieth event arrives five days after it happened.
    held = F.when(F.col("event_id") % 50 == 0, F.expr("interval 5 days")).otherwise(F.expr("interval 0 days"))
    arriving = t.events.withColumns({"arrives": F.col("ts") + held, "at": F.col("ts")})
    path = scratch_path(t.spark, "stream-mart")
    sink = sinks.MartSink(path, "1 day", event_sources)
    sinks.run_batches(replay(arriving, "arrives"), sink, f"{path}-checkpoint")
    return delta_mart.read(t.spark, sink.mart).select(
        "metric_date", "profile_visits", "landing_page_views", "lead_magnet_downloads", "tripwire_sales", "workflows_run", "workflows_failed")


def event_sources(events: DataFrame) -> Sources:
    status = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    return Sources(funnel=funnel_view(events), logs=events.select(F.col("ts").alias("started_at"), status.alias("status")))


@op("stream_transitions", """SELECT o_custkey, o_orderkey, CASE WHEN pp IS NULL THEN 'created' WHEN price_cents > pp * 1.5::DOUBLE THEN 'upgraded'
      WHEN price_cents * 1.5::DOUBLE < pp THEN 'downgraded' WHEN date_diff('day', pd, o_orderdate) > 365 THEN 'reactivated' ELSE 'renewed' END AS event_type,
      pp AS previous_price FROM
    (SELECT *, lag(price_cents) OVER w AS pp, lag(o_orderdate) OVER w AS pd FROM orr WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))""")
def _(t: Tables) -> DataFrame:
    # Orders arrive by number, which has nothing to do with their dates.
    path = scratch_path(t.spark, "stream-transitions")
    sink = sinks.TransitionSink(path, "o_custkey", "price_cents", "o_orderdate", "o_orderkey")
    sinks.run_batches(replay(t.orders, "o_orderkey"), sink, f"{path}-checkpoint")
    return sink.read(t.spark).select("o_custkey", "o_orderkey", "event_type", "previous_price")
