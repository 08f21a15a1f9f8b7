"""Queries for aggregations."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.functions import exprs as X
from growthloom.operators import affiliates as AF
from growthloom.operators import content as C
from growthloom.operators import email as E
from growthloom.operators import filters, funnel, members, ops, revenue
from growthloom.plans import daily
from growthloom.registry.core import op
from growthloom.registry.duck import EVENTS_AS_OF as EA, ORDERS_AS_OF as OA
from growthloom.registry.sources import mart, sources
from growthloom.schemas import STAGES
from growthloom.sources.documents import page_view_columns
from growthloom.sources.fixtures import AS_OF_EVENTS, AS_OF_ORDERS, LAST_DAY, Tables, as_ts

_COUNTS = ", ".join(f"count(*) FILTER (stage = '{s}') AS {s}" for s in STAGES)


def _now():
    return as_ts(AS_OF_EVENTS)


@op("funnel_stage_counts", f"SELECT {_COUNTS} FROM fe WHERE created_at >= {EA} - INTERVAL 7 DAY AND created_at <= {EA}")
def _(t: Tables) -> DataFrame:
    return funnel.funnel_counts(filters.lookback(t.funnel_events, "created_at", _now(), "7 days"))


_REV = """CAST(coalesce(sum(amount_cents) FILTER (product_type = 'tripwire'), 0) AS BIGINT) AS tripwire_revenue_cents,
    CAST(coalesce(sum(amount_cents) FILTER (product_type = 'membership'), 0) AS BIGINT) AS membership_revenue_cents,
    CAST(coalesce(sum(amount_cents) FILTER (product_type = 'automation_package'), 0) AS BIGINT) AS automation_revenue_cents,
    CAST(coalesce(sum(amount_cents), 0) AS BIGINT) AS total_revenue_cents"""


@op("revenue_by_type", f"""SELECT {_REV} FROM pu JOIN dp ON dp.id = pu.product_id WHERE pu.status = 'completed'
    AND CAST(pu.created_at AS DATE) = DATE '2024-01-30'""")
def _(t: Tables) -> DataFrame:
    return revenue.revenue(filters.on_day(t.purchases, "created_at", LAST_DAY), t.products)


@op("subscriber_totals", """SELECT count(*) FILTER (CAST(created_at AS DATE) = DATE '2024-01-05') AS new_subscribers,
    count(*) FILTER (status = 'active') AS total_subscribers FROM su""")
def _(t: Tables) -> DataFrame:
    return E.subscriber_counts(t.subscribers, "2024-01-05")


@op("videos_published", """SELECT CAST(published_at AS DATE) AS day, count(*) AS videos_published FROM vi WHERE status = 'published' GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    done = t.videos.where("status = 'published'")
    return done.groupBy(F.to_date("published_at").alias("day")).agg(F.count(F.lit(1)).alias("videos_published"))


@op("content_daily_totals", """SELECT event_date, CAST(sum(views) AS BIGINT) AS total_content_views,
    CAST(sum(likes + shares + comments + saves) AS BIGINT) AS total_engagement, CAST(sum(follower_gain) AS BIGINT) AS new_followers FROM ce GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return C.content_totals(t.content_events, ["event_date"])


@op("workflow_daily_counts", """SELECT CAST(started_at AS DATE) AS day, count(*) FILTER (status = 'success') AS workflows_run,
    count(*) FILTER (status = 'failed') AS workflows_failed, count(*) AS workflow_total FROM lg GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return ops.run_counts(t.execution_logs.withColumn("day", F.to_date("started_at")), ["day"])


@op("daily_metrics_rollup", "SELECT * FROM dm")
def _(t: Tables) -> DataFrame:
    return mart(t)


@op("video_daily_sums", """SELECT video_id, event_date, CAST(sum(views) AS BIGINT) AS views, CAST(sum(likes) AS BIGINT) AS likes,
    CAST(sum(shares) AS BIGINT) AS shares, CAST(sum(comments) AS BIGINT) AS comments, CAST(sum(saves) AS BIGINT) AS saves FROM ce GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    return C.video_daily_sums(t.content_events)


@op("video_totals_rebuild", """SELECT id AS video_id, total_views, total_likes, total_shares, total_comments, total_saves FROM vi""")
def _(t: Tables) -> DataFrame:
    return C.rebuild_video_totals(t.content_events)


@op("funnel_conversion", f"""WITH c AS (SELECT count(*) FILTER (stage = 'content_view') AS s1, count(*) FILTER (stage = 'profile_visit') AS s2,
      count(*) FILTER (stage = 'landing_page_view') AS s3, count(*) FILTER (stage = 'lead_magnet_download') AS s4,
      count(*) FILTER (stage = 'tripwire_view') AS s5,
      count(*) FILTER (stage IN ('tripwire_purchase','membership_purchased','automation_package_purchase')) AS s6
      FROM fe WHERE created_at >= {EA} - INTERVAL 30 DAY AND created_at <= {EA}),
    r AS (SELECT 1 AS position, 'content_views' AS stage, s1 AS volume, NULL AS base, NULL AS bench FROM c
      UNION ALL SELECT 2, 'profile_visits', s2, s1, 5 FROM c UNION ALL SELECT 3, 'lp_visits', s3, s2, 60 FROM c
      UNION ALL SELECT 4, 'email_optins', s4, s3, 20 FROM c UNION ALL SELECT 5, 'product_views', s5, s4, 15 FROM c
      UNION ALL SELECT 6, 'total_sales', s6, s3, 3 FROM c)
    SELECT CAST(position AS BIGINT) AS position, stage, volume, round(volume * 100.0::DOUBLE / nullif(base, 0), 2) AS conversion_pct,
      CAST(bench AS DOUBLE) AS benchmark_pct, CASE WHEN bench IS NULL THEN NULL WHEN coalesce(volume * 100.0 / nullif(base, 0), 0) = 0 THEN 'blocked'
      WHEN round(volume * 100.0::DOUBLE / nullif(base, 0), 2) < bench THEN 'leaking' ELSE 'optimal' END AS health FROM r""")
def _(t: Tables) -> DataFrame:
    return funnel.funnel_table(filters.lookback(t.funnel_events, "created_at", _now(), "30 days"))


@op("conversion_rates", """SELECT round(CAST(sum(new_subscribers) AS BIGINT) * 100.0::DOUBLE / nullif(CAST(sum(total_content_views) AS BIGINT), 0), 2) AS view_to_lead_cr,
    round(CAST(sum(tripwire_sales) AS BIGINT) * 100.0::DOUBLE / nullif(CAST(sum(new_subscribers) AS BIGINT), 0), 2) AS lead_to_tripwire_cr FROM dm""")
def _(t: Tables) -> DataFrame:
    return ops.kpi_rates(mart(t))


_HEALTH = f"""SELECT wf.id, wf.name, coalesce(l.failures, 0) AS failures, coalesce(l.successes, 0) AS successes,
    round(l.successes * 100.0::DOUBLE / l.runs, 2) AS success_rate FROM wf LEFT JOIN (SELECT workflow_id, count(*) FILTER (status = 'failed') AS failures,
      count(*) FILTER (status = 'success') AS successes, count(*) AS runs FROM lg
      WHERE started_at >= {EA} - INTERVAL 24 HOUR AND started_at <= {EA} GROUP BY 1) l ON l.workflow_id = wf.id"""


@op("automation_health", _HEALTH)
def _(t: Tables) -> DataFrame:
    return ops.health(t.workflows, t.execution_logs, _now())


@op("automation_health_active", _HEALTH + " WHERE l.runs > 0")
def _(t: Tables) -> DataFrame:
    return ops.health(t.workflows, t.execution_logs, _now(), keep_idle=False)


@op("health_gate", f"""SELECT id, name, success_rate, coalesce(success_rate < 95, false) AS below_floor,
    CASE WHEN success_rate < 95 THEN 'critical' WHEN success_rate <= 98 THEN 'warning' WHEN success_rate IS NOT NULL THEN 'ok' END AS band,
    (SELECT count(*) FILTER (success_rate < 95) = 0 FROM ({_HEALTH})) AS all_pass FROM ({_HEALTH})""")
def _(t: Tables) -> DataFrame:
    return ops.health_gate(ops.health(t.workflows, t.execution_logs, _now()))


@op("hook_performance", """SELECT ho.id, ho.hook_text, CAST(sum(total_views) AS BIGINT) AS total_views, CAST(sum(total_likes) AS BIGINT) AS total_likes,
    round(avg(round((total_likes + total_shares + total_comments + total_saves) / nullif(total_views, 0)::DOUBLE, 6)), 4) AS avg_engagement
    FROM vi JOIN ho ON ho.id = vi.hook_id GROUP BY 1, 2 ORDER BY total_views DESC, ho.id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    return C.hook_stats(t.videos, t.hooks)


@op("hook_engagement_week", f"""SELECT vi.hook_id, CAST(sum(ce.views) AS BIGINT) AS total_views, round(CAST(sum(ce.likes + ce.shares) AS BIGINT) / nullif(CAST(sum(ce.views) AS BIGINT), 0)::DOUBLE, 4) AS eng_rate_ls
    FROM ce JOIN vi ON vi.id = ce.video_id WHERE event_date >= CAST({EA} - INTERVAL 7 DAY AS DATE) AND event_date <= CAST({EA} AS DATE)
    GROUP BY 1 ORDER BY total_views DESC, vi.hook_id LIMIT 3""")
def _(t: Tables) -> DataFrame:
    return C.hook_engagement(t.content_events, t.videos, _now())


@op("platform_matrix", """WITH s AS (SELECT coalesce(platform, 'total') AS p, CAST(sum(views) AS DOUBLE) AS views, CAST(sum(shares) AS DOUBLE) AS shares,
      round(CAST(sum(saves) AS DOUBLE) / nullif(CAST(sum(views) AS DOUBLE), 0), 4) AS save_rate, CAST(sum(follower_gain) AS DOUBLE) AS followers FROM ce GROUP BY ROLLUP (platform)),
    l AS (SELECT p, 'views' AS metric, views AS v FROM s UNION ALL SELECT p, 'shares', shares FROM s UNION ALL SELECT p, 'save_rate', save_rate FROM s
      UNION ALL SELECT p, 'followers', followers FROM s)
    SELECT metric, max(v) FILTER (p = 'tiktok') AS tiktok, max(v) FILTER (p = 'instagram') AS instagram, max(v) FILTER (p = 'youtube') AS youtube,
      max(v) FILTER (p = 'total') AS total FROM l GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return C.platform_report(t.content_events)


def _trend(grain: str) -> str:
    return f"""SELECT period, revenue_cents, previous_cents, round((revenue_cents - previous_cents) * 100.0::DOUBLE / nullif(previous_cents, 0), 2) AS change_pct
    FROM (SELECT *, lag(revenue_cents) OVER (ORDER BY period) AS previous_cents FROM (SELECT CAST(date_trunc('{grain}', created_at) AS DATE) AS period,
      CAST(sum(amount_cents) AS BIGINT) AS revenue_cents FROM pu WHERE status = 'completed' GROUP BY 1))"""


@op("revenue_trend", _trend("day"))
def _(t: Tables) -> DataFrame:
    return revenue.revenue_trend(t.purchases, "day")


@op("revenue_trend_week", _trend("week"))
def _(t: Tables) -> DataFrame:
    return revenue.revenue_trend(t.purchases, "week")


@op("revenue_snapshot", "SELECT metric_date, total_revenue_cents / 100.0::DOUBLE AS revenue_dollars, tripwire_sales, membership_new_sales, new_subscribers FROM dm")
def _(t: Tables) -> DataFrame:
    return daily.revenue_dollars(mart(t))


@op("dashboard_snapshot", """SELECT metric_date, total_revenue_cents, new_subscribers, total_content_views,
    round(lead_magnet_downloads * 100.0::DOUBLE / nullif(landing_page_views, 0), 2) AS opt_in_pct,
    round((tripwire_sales + membership_new_sales + automation_package_sales) * 100.0::DOUBLE / nullif(landing_page_views, 0), 2) AS sale_pct
    FROM dm WHERE metric_date = DATE '2024-01-30'""")
def _(t: Tables) -> DataFrame:
    return daily.snapshot(sources(t), LAST_DAY)


@op("utm_performance", """SELECT utm_source, utm_medium, utm_campaign, CAST(coalesce(sum(visits), 0) AS BIGINT) AS visits, CAST(coalesce(sum(leads), 0) AS BIGINT) AS leads,
    CAST(coalesce(sum(purchases), 0) AS BIGINT) AS purchases, CAST(coalesce(sum(revenue_cents), 0) AS BIGINT) AS revenue_cents,
    CAST(grouping(utm_source, utm_medium, utm_campaign) AS BIGINT) AS level FROM
    (SELECT utm_source, utm_medium, utm_campaign, count(*) FILTER (stage = 'landing_page_view') AS visits, count(*) FILTER (stage = 'lead_magnet_download') AS leads,
       0 AS purchases, 0 AS revenue_cents FROM fe GROUP BY ALL
     UNION ALL SELECT utm_source, utm_medium, utm_campaign, 0, 0, count(*), sum(amount_cents) FROM pu WHERE status = 'completed' GROUP BY ALL)
    GROUP BY ROLLUP (utm_source, utm_medium, utm_campaign)""")
def _(t: Tables) -> DataFrame:
    return funnel.utm_report(t.funnel_events, t.purchases)


@op("utm_performance_daily", """SELECT utm_source, day, CAST(coalesce(sum(visits), 0) AS BIGINT) AS visits, CAST(coalesce(sum(purchases), 0) AS BIGINT) AS purchases FROM
    (SELECT utm_source, CAST(created_at AS DATE) AS day, count(*) FILTER (stage = 'landing_page_view') AS visits, 0 AS purchases FROM fe GROUP BY ALL
     UNION ALL SELECT utm_source, CAST(created_at AS DATE), 0, count(*) FROM pu WHERE status = 'completed' GROUP BY ALL)
    GROUP BY ROLLUP (utm_source, day)""")
def _(t: Tables) -> DataFrame:
    day = F.to_date("created_at")
    both = t.funnel_events.withColumn("day", day), t.purchases.withColumn("day", day)
    return funnel.utm_report(*both, by=("utm_source", "day")).select("utm_source", "day", "visits", "purchases")


@op("campaign_metrics", """SELECT *, round(opens / sent::DOUBLE, 4) AS open_rate, round(clicks / sent::DOUBLE, 4) AS click_rate,
    round(clicks / nullif(opens, 0)::DOUBLE, 4) AS click_to_open, round(unsubs / sent::DOUBLE, 4) AS unsub_rate FROM
    (SELECT campaign_id, count(sent_at) AS sent, count(delivered_at) AS delivered, count(opened_at) AS opens, count(clicked_at) AS clicks,
     count(unsubscribed_at) AS unsubs FROM cl GROUP BY 1)""")
def _(t: Tables) -> DataFrame:
    return E.campaign_stats(t.campaign_logs)


@op("subscriber_engagement", """SELECT m.*, coalesce(p.ltv_cents, 0) AS ltv_cents FROM (SELECT subscriber_id, count(*) AS total_emails, count(opened_at) AS total_opens,
    count(clicked_at) AS total_clicks, max(opened_at) AS last_opened_at, max(clicked_at) AS last_clicked_at FROM cl GROUP BY 1) m
    LEFT JOIN (SELECT profile_id, CAST(sum(amount_cents) AS BIGINT) AS ltv_cents FROM pu WHERE status = 'completed' GROUP BY 1) p ON p.profile_id = m.subscriber_id""")
def _(t: Tables) -> DataFrame:
    return E.subscriber_stats(t.campaign_logs, t.purchases)


@op("churn_rate", f"""SELECT members_at_start, churned, members_at_start - churned AS active_members, round(churned / nullif(members_at_start, 0)::DOUBLE, 4) AS churn_rate FROM
    (SELECT count(*) FILTER (created_at < {OA} - INTERVAL 30 DAY AND (ended_at IS NULL OR ended_at >= {OA} - INTERVAL 30 DAY)) AS members_at_start,
     count(*) FILTER (created_at < {OA} - INTERVAL 30 DAY AND ended_at >= {OA} - INTERVAL 30 DAY AND ended_at < {OA}) AS churned FROM me)""")
def _(t: Tables) -> DataFrame:
    end = as_ts(AS_OF_ORDERS)
    return members.churn(t.memberships, end - F.expr("interval 30 days"), end)


@op("mrr", f"""SELECT m.month, CAST(coalesce(sum(CASE plan WHEN 'year' THEN price_cents // 12 ELSE price_cents END), 0) AS BIGINT) AS mrr_cents, count(me.id) AS members
    FROM (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(created_at)) FROM me), date_trunc('month', {OA}), INTERVAL 1 MONTH)) AS DATE) AS month) m
    LEFT JOIN me ON date_trunc('month', me.created_at) <= m.month AND date_trunc('month', least(coalesce(ended_at, {OA}), {OA})) >= m.month
      AND created_at <= least(coalesce(ended_at, {OA}), {OA}) GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return members.mrr(t.memberships, as_ts(AS_OF_ORDERS))


@op("member_ltv", """SELECT profile_id, CAST(sum(amount_cents) AS BIGINT) AS ltv_cents, count(*) AS orders, round(CAST(sum(amount_cents) AS BIGINT) / count(*)::DOUBLE, 2) AS avg_order_cents
    FROM ph WHERE status = 'completed' GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return revenue.ltv(t.purchases_hist)


@op("member_ltv_mean", """SELECT count(*) AS customers, CAST(sum(s) AS BIGINT) AS revenue_cents, round(CAST(sum(s) AS BIGINT) / count(*)::DOUBLE, 2) AS mean_ltv_cents
    FROM (SELECT sum(amount_cents) AS s FROM ph WHERE status = 'completed' GROUP BY profile_id)""")
def _(t: Tables) -> DataFrame:
    return revenue.ltv_summary(t.purchases_hist)


@op("affiliate_balances", """SELECT affiliate_id, CAST(coalesce(sum(amount_cents) FILTER (status IN ('pending','approved','paid')), 0) AS BIGINT) AS total_earned_cents,
    CAST(coalesce(sum(amount_cents) FILTER (status = 'paid'), 0) AS BIGINT) AS total_paid_cents,
    CAST(coalesce(sum(amount_cents) FILTER (status IN ('pending','approved')), 0) AS BIGINT) AS pending_cents FROM cm GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return AF.affiliate_balances(t.commissions)


@op("payout_batch", """SELECT affiliate_id, CAST(sum(amount_cents) AS BIGINT) AS payout_cents, count(*) AS commissions, DATE '2000-01-01' AS paid_on
    FROM cm WHERE status = 'approved' AND created_at < TIMESTAMP '2000-01-01' GROUP BY 1 HAVING sum(amount_cents) >= 5000""")
def _(t: Tables) -> DataFrame:
    return AF.payouts(t.commissions, "2000-01-01")


_ALERT = """SELECT workflow_id, window_start, failures, runs, CASE WHEN failures >= 3 THEN 'failure_count' ELSE 'failure_share' END AS reason FROM
    (SELECT workflow_id, {w} AS window_start, count(*) FILTER (status = 'failed') AS failures, count(*) AS runs FROM {src} GROUP BY 1, 2)
    WHERE failures > 0 AND (failures >= 3 OR failures >= runs * 0.5)"""


@op("failure_alerts", _ALERT.format(w="date_trunc('hour', started_at)", src="lg"))
def _(t: Tables) -> DataFrame:
    return ops.failure_alerts(t.execution_logs)


SLIDES = "(SELECT lg.*, time_bucket(INTERVAL 5 MINUTE, started_at) - to_minutes(5 * CAST(j AS INTEGER)) AS ws FROM lg, (SELECT unnest(range(12)) AS j))"


@op("failure_alerts_sliding", _ALERT.format(w="ws", src=SLIDES))
def _(t: Tables) -> DataFrame:
    return ops.failure_alerts(t.execution_logs, "1 hour", "5 minutes")


@op("uptime_pct", """SELECT *, uptime_pct >= 99 AS goal_met FROM (SELECT CAST(started_at AS DATE) AS day, count(*) AS workflow_total,
    round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 2) AS uptime_pct FROM lg GROUP BY 1)""")
def _(t: Tables) -> DataFrame:
    return ops.uptime(t.execution_logs)


@op("latency_stats", """SELECT workflow_id, count(*) AS runs, round(quantile_cont(run_cs / 100.0::DOUBLE, 0.5), 3) AS p50_s, round(quantile_cont(run_cs / 100.0::DOUBLE, 0.95), 3) AS p95_s,
    max(run_cs / 100.0::DOUBLE) AS max_s, round(count(*) FILTER (run_cs / 100.0 < 30) / count(*)::DOUBLE, 4) AS fast_share FROM lg GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return ops.latency_exact(t.execution_logs, F.col("run_cs") / F.lit(100.0))


@op("churn_breakdown", f"""SELECT cancellation_reason, count(*) AS churned FROM me WHERE status = 'canceled' AND ended_at >= {OA} - INTERVAL 24 HOUR
    AND ended_at <= {OA} GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return members.churn_reasons(t.memberships, as_ts(AS_OF_ORDERS))


@op("hook_catalog_stats", """SELECT category, trigger_type, count(*) AS hooks, round(CAST(sum(CAST(estimated_performance * 10 AS BIGINT)) AS BIGINT) / (count(*) * 10)::DOUBLE, 4) AS mean_score,
    CAST(max(estimated_performance) AS DOUBLE) AS max_score FROM ho GROUP BY CUBE (category, trigger_type)""")
def _(t: Tables) -> DataFrame:
    return C.hook_catalog(t.hooks)


@op("pillar_ranking", f"""SELECT category, views, watch_cs, mean_watch_cs, rank() OVER (ORDER BY mean_watch_cs DESC NULLS LAST) AS place FROM
    (SELECT vi.category, CAST(sum(views) AS BIGINT) AS views, CAST(sum(watch_cs) AS BIGINT) AS watch_cs,
     round(CAST(sum(watch_cs) AS BIGINT) / nullif(CAST(sum(views) AS BIGINT), 0)::DOUBLE, 4) AS mean_watch_cs
     FROM ce JOIN vi ON vi.id = ce.video_id WHERE event_date BETWEEN CAST({EA} - INTERVAL 7 DAY AS DATE) AND CAST({EA} AS DATE) GROUP BY 1)""")
def _(t: Tables) -> DataFrame:
    return C.pillar_rank(t.content_events, t.videos, _now())


@op("traffic_mix", """WITH s AS (SELECT CAST(sum(from_fyp) AS BIGINT) AS a, CAST(sum(from_profile) AS BIGINT) AS b, CAST(sum(from_search) AS BIGINT) AS c,
      CAST(sum(from_hashtags) AS BIGINT) AS d FROM ce),
    l AS (SELECT 'from_fyp' AS origin, a AS views, a + b + c + d AS total FROM s UNION ALL SELECT 'from_profile', b, a + b + c + d FROM s
      UNION ALL SELECT 'from_search', c, a + b + c + d FROM s UNION ALL SELECT 'from_hashtags', d, a + b + c + d FROM s)
    SELECT origin, views, round(views / nullif(total, 0)::DOUBLE, 4) AS share FROM l""")
def _(t: Tables) -> DataFrame:
    return C.traffic_mix(t.content_events)


@op("kpi_scorecard", f"""WITH k AS (SELECT round(CAST(sum(lead_magnet_downloads) AS BIGINT) * 100.0::DOUBLE / nullif(CAST(sum(landing_page_views) AS BIGINT), 0), 2) AS a,
      round(CAST(sum(tripwire_sales) AS BIGINT) * 100.0::DOUBLE / nullif(CAST(sum(lead_magnet_downloads) AS BIGINT), 0), 2) AS b,
      round(CAST(sum(membership_new_sales) AS BIGINT) * 100.0::DOUBLE / nullif(CAST(sum(tripwire_sales) AS BIGINT), 0), 2) AS c,
      round(CAST(sum(workflows_run) AS BIGINT) * 100.0::DOUBLE / nullif(CAST(sum(workflow_total) AS BIGINT), 0), 2) AS d FROM dm),
    h AS (SELECT round(count(*) FILTER (created_at < {OA} - INTERVAL 30 DAY AND ended_at >= {OA} - INTERVAL 30 DAY AND ended_at < {OA}) * 100.0::DOUBLE
       / nullif(count(*) FILTER (created_at < {OA} - INTERVAL 30 DAY AND (ended_at IS NULL OR ended_at >= {OA} - INTERVAL 30 DAY)), 0), 2) AS e FROM me)
    SELECT 'opt_in_pct' AS metric, a AS value, '>' AS comparison, 20.0::DOUBLE AS target, a > 20 AS met FROM k
    UNION ALL SELECT 'lead_to_tripwire_pct', b, '>', 3.0, b > 3 FROM k UNION ALL SELECT 'tripwire_to_member_pct', c, '>', 10.0, c > 10 FROM k
    UNION ALL SELECT 'workflow_success_pct', d, '>', 95.0, d > 95 FROM k UNION ALL SELECT 'churn_pct', e, '<', 8.0, e < 8 FROM h""")
def _(t: Tables) -> DataFrame:
    end = as_ts(AS_OF_ORDERS)
    lost = members.churn(t.memberships, end - F.expr("interval 30 days"), end).select(
        F.lit("churn_pct").alias("metric"), X.pct("churned", "members_at_start").alias("value")
    )
    return ops.scorecard(daily.kpis(mart(t)).unionByName(lost))


@op("page_performance", """SELECT section, device, country, count(*) AS views, round(CAST(sum(page_load_ms) AS BIGINT) / count(*)::DOUBLE, 2) AS mean_load,
    quantile_disc(page_load_ms::DOUBLE, 0.95) AS p95_load, max(page_load_ms) AS max_load, round(CAST(sum(stay) AS BIGINT) / nullif(count(stay), 0)::DOUBLE, 2) AS mean_stay,
    quantile_disc(stay::DOUBLE, 0.5) AS median_stay FROM
    (SELECT string_split(path, '/')[2] AS section, CASE WHEN host LIKE 'm.%' THEN 'mobile' WHEN host LIKE 'blog.%' THEN 'tablet' ELSE 'desktop' END AS device, page_load_ms, country, stay FROM pv)
    GROUP BY ROLLUP (section, device, country)""")
def _(t: Tables) -> DataFrame:
    views = page_view_columns(t.page_views).select(
        F.split_part("path", F.lit("/"), F.lit(2)).alias("section"), X.device_class("user_agent").alias("device"), "country", "page_load_ms",
        "time_on_page_seconds", "viewed_at")
    return C.page_stats(C.page_stats_by_day(views))


@op("queue_status", """SELECT platform, count(*) FILTER (status = 'queued') AS queued, count(*) FILTER (status = 'processing') AS processing,
    count(*) FILTER (status = 'published') AS published, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
    count(*) FILTER (status = 'failed' AND retry_count >= max_retries) AS exhausted FROM pq GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return C.queue_stats(t.publishing_queue)


@op("link_clicks", """SELECT 'https://example.com/l/' || n AS link, count(*) AS clicks FROM
    (SELECT k % 7 AS n FROM ev WHERE event_type = 'click' UNION ALL SELECT k % 11 FROM ev WHERE event_type = 'click') GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return E.link_clicks(t.campaign_logs)


_REFUND = """SELECT {by}, count(*) AS purchases, count(*) FILTER (status = 'refunded') AS refunded, count(*) FILTER (status = 'partially_refunded') AS partly_refunded,
    CAST(coalesce(sum(amount_cents) FILTER (status IN ('refunded','partially_refunded')), 0) AS BIGINT) AS touched_cents,
    round(count(*) FILTER (status IN ('refunded','partially_refunded')) / count(*)::DOUBLE, 4) AS refund_rate FROM {src} GROUP BY 1"""


@op("refund_rate", _REFUND.format(by="product_id", src="pu"))
def _(t: Tables) -> DataFrame:
    return revenue.refunds(t.purchases)


@op("refund_rate_medium", _REFUND.format(by="utm_medium", src="ph"))
def _(t: Tables) -> DataFrame:
    return revenue.refunds(t.purchases_hist, "utm_medium")


@op("product_sales", """SELECT dp.id, dp.product_type, coalesce(s.units, 0) AS units, coalesce(s.cents, 0) AS revenue_cents, dp.inventory_count - coalesce(s.units, 0) AS remaining
    FROM dp LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(line_cents) AS BIGINT) AS cents FROM it GROUP BY 1) s ON s.product_id = dp.id""")
def _(t: Tables) -> DataFrame:
    return revenue.product_sales(t.purchase_items, t.products)


@op("daily_retention", """SELECT d.metric_date, count(*) FILTER (CAST(created_at AS DATE) <= d.metric_date AND (ended_at IS NULL OR CAST(ended_at AS DATE) > d.metric_date)) AS active_members,
    count(*) FILTER (CAST(ended_at AS DATE) = d.metric_date) AS churned_members,
    round(count(*) FILTER (CAST(ended_at AS DATE) = d.metric_date) / nullif(count(*) FILTER (CAST(created_at AS DATE) <= d.metric_date AND (ended_at IS NULL OR CAST(ended_at AS DATE) >= d.metric_date)), 0)::DOUBLE, 4) AS churn_rate
    FROM (SELECT CAST(unnest(generate_series(DATE '2001-07-01', DATE '2001-08-02', INTERVAL 1 DAY)) AS DATE) AS metric_date) d, me GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return daily.retention(t.memberships, "2001-07-01", "2001-08-02")


@op("daily_payouts", """SELECT CAST(created_at AS DATE) AS metric_date, CAST(sum(amount_cents) AS BIGINT) AS affiliate_payouts_cents FROM cm
    WHERE status = 'paid' AND CAST(created_at AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1999-12-31' GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return daily.payouts_by_day(t.commissions, "1998-01-01", "1999-12-31")


@op("daily_metrics_complete", """SELECT dm.*, coalesce(m.active_members, 0) AS active_members, CAST(0 AS BIGINT) AS churned_members,
    CASE WHEN m.active_members > 0 THEN 0.0::DOUBLE END AS churn_rate,
    CAST(coalesce(c.cents, 0) AS BIGINT) AS affiliate_payouts_cents FROM dm
    CROSS JOIN (SELECT count(*) FILTER (ended_at IS NULL) AS active_members FROM me) m
    LEFT JOIN (SELECT CAST(created_at AS DATE) AS dd, sum(amount_cents) AS cents FROM cm WHERE status = 'paid' GROUP BY 1) c ON c.dd = dm.metric_date""")
def _(t: Tables) -> DataFrame:
    src = sources(t)
    src.memberships, src.commissions = t.memberships, t.commissions
    return daily.daily_metrics(src, "2024-01-01", LAST_DAY)


@op("growth_scorecard", """WITH s AS (SELECT CAST(sum(new_followers) AS BIGINT) AS followers, CAST(sum(new_subscribers) AS BIGINT) AS subscribers,
      CAST(sum(total_revenue_cents) AS BIGINT) AS revenue_cents, CAST(sum(videos_published) AS BIGINT) AS videos, CAST(sum(membership_new_sales) AS BIGINT) AS members FROM dm),
    g(horizon, metric, target) AS (VALUES ('30 days', 'followers', 2000), ('30 days', 'subscribers', 500), ('30 days', 'revenue_cents', 50000), ('30 days', 'videos', 30),
      ('90 days', 'followers', 20000), ('90 days', 'subscribers', 5000), ('90 days', 'revenue_cents', 500000), ('90 days', 'videos', 90),
      ('month 1', 'followers', 10000), ('month 1', 'subscribers', 2000), ('month 1', 'members', 0), ('month 1', 'revenue_cents', 200000),
      ('month 2', 'followers', 50000), ('month 2', 'subscribers', 10000), ('month 2', 'members', 150), ('month 2', 'revenue_cents', 500000),
      ('month 3', 'followers', 100000), ('month 3', 'subscribers', 25000), ('month 3', 'members', 400), ('month 3', 'revenue_cents', 1000000))
    SELECT horizon, metric, v AS value, CAST(target AS BIGINT) AS target, v >= target AS met FROM
      (SELECT g.*, CASE metric WHEN 'followers' THEN followers WHEN 'subscribers' THEN subscribers WHEN 'revenue_cents' THEN revenue_cents
         WHEN 'videos' THEN videos ELSE members END AS v FROM g, s)""")
def _(t: Tables) -> DataFrame:
    return ops.growth_scorecard(daily.growth_totals(mart(t)))
