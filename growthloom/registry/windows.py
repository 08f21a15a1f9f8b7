"""Queries for ordered and scheduled operators."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import affiliates as AF
from growthloom.operators import content as C
from growthloom.operators import email as E
from growthloom.operators import funnel, members
from growthloom.plans import daily
from growthloom.plans.keyed import latest_by
from growthloom.registry.core import op
from growthloom.registry.duck import EVENTS_AS_OF as EA, ORDERS_AS_OF as OA
from growthloom.registry.sources import mart
from growthloom.sources.fixtures import AS_OF_EVENTS, AS_OF_ORDERS, Tables, as_ts


def _now():
    return as_ts(AS_OF_EVENTS)


@op("line_timecodes", """SELECT id, line_no, words, round((before * 45) / 100.0::DOUBLE, 2) AS start_s, round(((before + words) * 45) / 100.0::DOUBLE, 2) AS end_s
    FROM (SELECT *, CAST(sum(words) OVER (PARTITION BY id ORDER BY line_no) AS BIGINT) - words AS before FROM wl)""")
def _(t: Tables) -> DataFrame:
    return C.timecodes(t.scripts, ["id"], "lines").select("id", "line_no", "words", "start_s", "end_s")


@op("production_order", """SELECT o_orderkey AS id, n AS order_no, CAST((n - 1) // 10 + 1 AS BIGINT) AS batch FROM
    (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)""")
def _(t: Tables) -> DataFrame:
    rows = t.raw("orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return C.production_order(rows, [F.desc_nulls_last("o_totalprice"), F.asc("id")]).select("id", "order_no", "batch")


@op("round_robin_assign", """SELECT id, i AS position, 'script-' || lpad(CAST(i + 41 AS VARCHAR), 3, '0') AS script_id, ['1','2','3','9'][i % 4 + 1] AS template_no,
    ['Adam (v2)','Antoni'][i % 2 + 1] AS voice FROM
    (SELECT id, row_number() OVER (ORDER BY estimated_performance DESC, id) - 1 AS i FROM ho ORDER BY estimated_performance DESC, id LIMIT 20)""")
def _(t: Tables) -> DataFrame:
    best = C.top_hooks(t.hooks, 20, "estimated_performance")
    return C.assign_templates(best, [F.desc_nulls_last("estimated_performance"), F.asc("id")]).select(
        "id", "position", "script_id", "template_no", "voice"
    )


@op("time_to_convert", """SELECT id, person, stage, ps AS previous_stage, CAST(round((epoch_us(created_at) - epoch_us(pt)) / 1e6::DOUBLE) AS BIGINT) AS seconds_since_previous,
    CAST(round((epoch_us(created_at) - epoch_us(ft)) / 1e6::DOUBLE) AS BIGINT) AS seconds_since_first FROM
    (SELECT *, lag(stage) OVER w AS ps, lag(created_at) OVER w AS pt, min(created_at) OVER (PARTITION BY person) AS ft FROM fe
     WINDOW w AS (PARTITION BY person ORDER BY created_at, id))
    WHERE stage IN ('tripwire_purchase','membership_purchased','automation_package_purchase')""")
def _(t: Tables) -> DataFrame:
    return funnel.time_to_convert(
        t.funnel_events, ["tripwire_purchase", "membership_purchased", "automation_package_purchase"]
    )


@op("ordered_funnel", """WITH a AS (SELECT person, min(created_at) AS t FROM fe WHERE stage = 'content_view' GROUP BY 1),
    b AS (SELECT fe.person, min(created_at) AS t FROM fe JOIN a ON a.person = fe.person AND fe.created_at > a.t WHERE stage = 'landing_page_view' GROUP BY 1),
    c AS (SELECT fe.person, min(created_at) AS t FROM fe JOIN b ON b.person = fe.person AND fe.created_at > b.t WHERE stage = 'lead_magnet_download' GROUP BY 1),
    d AS (SELECT fe.person, min(created_at) AS t FROM fe JOIN c ON c.person = fe.person AND fe.created_at > c.t WHERE stage = 'tripwire_purchase' GROUP BY 1),
    e AS (SELECT fe.person, min(created_at) AS t FROM fe JOIN d ON d.person = fe.person AND fe.created_at > d.t WHERE stage = 'membership_purchased' GROUP BY 1)
    SELECT CAST(1 AS BIGINT) AS position, 'content_view' AS stage, count(*) AS persons FROM a UNION ALL SELECT 2, 'landing_page_view', count(*) FROM b
    UNION ALL SELECT 3, 'lead_magnet_download', count(*) FROM c UNION ALL SELECT 4, 'tripwire_purchase', count(*) FROM d
    UNION ALL SELECT 5, 'membership_purchased', count(*) FROM e""")
def _(t: Tables) -> DataFrame:
    return funnel.strict_funnel(
        t.funnel_events,
        ["content_view", "landing_page_view", "lead_magnet_download", "tripwire_purchase", "membership_purchased"],
    )


@op("latest_state", """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def _(t: Tables) -> DataFrame:
    rows = t.raw("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return latest_by(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@op("recurrence_number", """SELECT pu.id AS purchase_id, pu.profile_id, row_number() OVER (PARTITION BY pu.profile_id ORDER BY pu.created_at, pu.id) AS recurrence_number
    FROM pu JOIN dp ON dp.id = pu.product_id JOIN af ON af.id = pu.affiliate_id WHERE af.is_active AND dp.product_type = 'membership'""")
def _(t: Tables) -> DataFrame:
    made = AF.affiliate_run(t.purchases, t.affiliates, t.products)
    return AF.recurrence(made, "profile_id").select("purchase_id", "profile_id", "recurrence_number")


@op("lifecycle_transitions", """SELECT o_custkey, o_orderkey, CASE WHEN pp IS NULL THEN 'created' WHEN price_cents > pp * 1.5::DOUBLE THEN 'upgraded'
      WHEN price_cents * 1.5::DOUBLE < pp THEN 'downgraded' WHEN date_diff('day', pd, o_orderdate) > 365 THEN 'reactivated' ELSE 'renewed' END AS event_type,
      pp AS previous_price FROM
    (SELECT *, lag(price_cents) OVER w AS pp, lag(o_orderdate) OVER w AS pd FROM orr WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))""")
def _(t: Tables) -> DataFrame:
    return members.transitions(t.orders, "o_custkey", "price_cents", "o_orderdate", "o_orderkey").select(
        "o_custkey", "o_orderkey", "event_type", "previous_price"
    )


@op("session_build", """SELECT user_id, session_no, min(ts) AS started_at, max(ts) AS ended_at,
      CAST(round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE) AS BIGINT) AS duration_seconds, count(*) AS events,
      arg_min(k, (ts, event_id)) AS landing_page FROM
    (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM
      (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM ev
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    return funnel.sessions(t.events, "user_id", "ts", "k", "event_id")


@op("drip_schedule", f"""SELECT user_id AS subscriber_id, s.step, (s.step - 1) * 24 AS delay_hours, started_at + to_hours(CAST((s.step - 1) * 24 AS INTEGER)) AS send_at,
    started_at + to_hours(CAST((s.step - 1) * 24 AS INTEGER)) <= {EA} AS is_due
    FROM (SELECT user_id, min(ts) AS started_at FROM ev WHERE event_type = 'signup' GROUP BY 1), (SELECT unnest(range(1, 6)) AS step) s""")
def _(t: Tables) -> DataFrame:
    starts = t.subscribers.where("created_at is not null").select(F.col("id").alias("subscriber_id"), "created_at")
    return E.drip_plan(starts, "subscriber_id", "created_at", _now())


@op("drip_next_step", f"""SELECT subscriber_id, started_at, least(5, CAST(floor(h / 24) AS BIGINT) + 1) AS sent_steps,
    CASE WHEN floor(h / 24) + 1 < 5 THEN CAST(floor(h / 24) AS BIGINT) + 2 END AS next_step, floor(h / 24) + 1 >= 5 AS completed
    FROM (SELECT id AS subscriber_id, last_opened_at AS started_at, (epoch_us({EA}) - epoch_us(last_opened_at)) / 3.6e9::DOUBLE AS h FROM su WHERE last_opened_at IS NOT NULL)""")
def _(t: Tables) -> DataFrame:
    starts = t.subscribers.where("last_opened_at is not null").select(F.col("id").alias("subscriber_id"), "last_opened_at")
    return E.next_step(starts, "subscriber_id", "last_opened_at", _now())


@op("membership_touchpoints", f"""SELECT me.id, d.day, CAST(CAST(current_period_start AS DATE) + CAST(d.day AS INTEGER) AS DATE) AS due_on,
    CAST(current_period_start AS DATE) + CAST(d.day AS INTEGER) <= CAST({OA} AS DATE) AS is_due
    FROM me, (SELECT unnest([1, 2, 7, 14, 30]::BIGINT[]) AS day) d""")
def _(t: Tables) -> DataFrame:
    return members.touchpoints(t.memberships, "id", "current_period_start", as_ts(AS_OF_ORDERS))


@op("engagement_segment", f"""SELECT id, email, last_activity_at, CAST(CASE WHEN h >= 1 * 24 + 24 + 48 THEN 3 WHEN h >= 1 * 24 + 24 THEN 2 ELSE 1 END AS BIGINT) AS step FROM
    (SELECT id, email, greatest(last_opened_at, last_clicked_at) AS last_activity_at,
     (epoch_us({EA}) - epoch_us(greatest(last_opened_at, last_clicked_at))) / 3.6e9::DOUBLE AS h FROM su) WHERE h >= 24""")
def _(t: Tables) -> DataFrame:
    return E.dormant(t.subscribers, _now(), days=1)


@op("publish_retry", f"""SELECT id, platform, scheduled_for, row_number() OVER (PARTITION BY platform ORDER BY scheduled_for, id) AS run_order FROM pq
    WHERE status IN ('queued','failed') AND retry_count < max_retries AND scheduled_for <= {EA}""")
def _(t: Tables) -> DataFrame:
    return C.retry_queue(t.publishing_queue, _now()).select("id", "platform", "scheduled_for", "run_order")


@op("posting_slots", """SELECT id, platform, CAST(d AS TIMESTAMP) + to_hours(CASE platform WHEN 'tiktok' THEN CASE WHEN w THEN 21 ELSE 19 END
      WHEN 'instagram' THEN CASE WHEN w THEN 10 ELSE 12 END ELSE CASE WHEN w THEN 11 ELSE 18 END END) AS post_at
    FROM (SELECT id, platform, CAST(scheduled_for AS DATE) + 1 AS d, dayofweek(CAST(scheduled_for AS DATE) + 1) IN (0, 6) AS w FROM pq)""")
def _(t: Tables) -> DataFrame:
    return C.schedule_posts(t.publishing_queue, "scheduled_for", "platform").select("id", "platform", "post_at")


@op("running_totals", """SELECT metric_date, new_followers, new_subscribers, CAST(sum(new_followers) OVER (ORDER BY metric_date) AS BIGINT) AS total_followers,
    CAST(sum(new_subscribers) OVER (ORDER BY metric_date) AS BIGINT) AS subscribers_so_far FROM dm""")
def _(t: Tables) -> DataFrame:
    return daily.running(mart(t))
