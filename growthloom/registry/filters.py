"""Queries for filters, visibility and routing."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.functions import exprs as X
from growthloom.operators import access, filters
from growthloom.registry.core import op
from growthloom.registry.duck import EVENTS_AS_OF as EA, ORDERS_AS_OF as OA
from growthloom.sources.fixtures import AS_OF_EVENTS, AS_OF_ORDERS, LAST_DAY, Tables, as_ts


def ev_now():
    return as_ts(AS_OF_EVENTS)


def ord_now():
    return as_ts(AS_OF_ORDERS)


@op("cents_to_dollars", "SELECT id, amount_cents / 100.0::DOUBLE AS amount_dollars FROM ph")
def _(t: Tables) -> DataFrame:
    return t.purchases_hist.select("id", X.dollars("amount_cents").alias("amount_dollars"))


@op("lookback_filter", f"""SELECT id, person, stage, created_at FROM fe
    WHERE created_at >= {EA} - INTERVAL 7 DAY AND created_at <= {EA}""")
def _(t: Tables) -> DataFrame:
    return filters.lookback(t.funnel_events, "created_at", ev_now(), "7 days").select("id", "person", "stage", "created_at")


@op("forward_window_filter", f"SELECT id, current_period_end FROM me WHERE current_period_end BETWEEN {OA} AND {OA} + INTERVAL 5 DAY")
def _(t: Tables) -> DataFrame:
    return filters.due_within(t.memberships, "current_period_end", ord_now(), 5).select("id", "current_period_end")


@op("day_slice", "SELECT id, stage, created_at FROM fe WHERE CAST(created_at AS DATE) = DATE '2024-01-30'")
def _(t: Tables) -> DataFrame:
    return filters.on_day(t.funnel_events, "created_at", LAST_DAY).select("id", "stage", "created_at")


@op("status_in", "SELECT id, status FROM me WHERE status IN ('past_due', 'incomplete')")
def _(t: Tables) -> DataFrame:
    return t.memberships.where(F.col("status").isin("past_due", "incomplete")).select("id", "status")


@op("not_null_filter", "SELECT id, CAST(actual_performance AS DOUBLE) AS actual FROM ho WHERE actual_performance IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return t.hooks.where(F.col("actual_performance").isNotNull()).select(
        "id", F.col("actual_performance").cast("double").alias("actual")
    )


@op("point_lookup", "SELECT id, email, full_name FROM pr WHERE email = 'customer.000000042@example.com'")
def _(t: Tables) -> DataFrame:
    return filters.lookup(t.profiles, "email", "customer.000000042@example.com").select("id", "email", "full_name")


@op("array_filter", "SELECT id, len(platforms) AS n FROM vi WHERE list_has_any(platforms, ['instagram', 'youtube'])")
def _(t: Tables) -> DataFrame:
    return filters.has_any(t.videos, "platforms", ["instagram", "youtube"]).select("id", F.size("platforms").cast("long").alias("n"))


def _hot(key: str, sql: str, frame, name: str, cols: list[str], now=None) -> None:
    @op(key, sql)
    def _(t: Tables) -> DataFrame:
        return filters.hot_set(frame(t), name, now() if now else None).select(*cols)


_hot("hot_active_subscribers", "SELECT id, email, created_at FROM su WHERE status = 'active'",
     lambda t: t.subscribers, "active_subscribers", ["id", "email", "created_at"])
_hot("hot_active_affiliates", "SELECT id, referral_code FROM af WHERE is_active",
     lambda t: t.affiliates, "active_affiliates", ["id", "referral_code"])
_hot("hot_recent_videos", f"SELECT id, published_at FROM vi WHERE status = 'published' AND published_at > {EA} - INTERVAL 30 DAY AND published_at <= {EA}",
     lambda t: t.videos, "recent_videos", ["id", "published_at"], ev_now)
_hot("hot_queued_jobs", "SELECT id, platform, scheduled_for FROM pq WHERE status = 'queued'",
     lambda t: t.publishing_queue, "queued_jobs", ["id", "platform", "scheduled_for"])
_hot("hot_pending_commissions", "SELECT affiliate_id, purchase_id, amount_cents FROM cm WHERE status = 'pending'",
     lambda t: t.commissions, "pending_commissions", ["affiliate_id", "purchase_id", "amount_cents"])
_hot("hot_failed_runs", "SELECT id, workflow_id, started_at FROM lg WHERE status = 'failed'",
     lambda t: t.execution_logs, "failed_runs", ["id", "workflow_id", "started_at"])
_hot("hot_renewing_members", "SELECT id, current_period_end FROM me WHERE status IN ('active','trialing')",
     lambda t: t.memberships, "renewing_members", ["id", "current_period_end"])
_hot("hot_members", "SELECT id FROM pr WHERE acct_cents >= 500000",
     lambda t: t.profiles.withColumn("is_member", F.col("acct_cents") >= 500_000), "members", ["id"])
_hot("hot_refunded_purchases", "SELECT id, status, amount_cents FROM ph WHERE status IN ('refunded','partially_refunded')",
     lambda t: t.purchases_hist, "refunded_purchases", ["id", "status", "amount_cents"])
_hot("hot_sendable_campaigns", "SELECT id, send_at FROM (SELECT id, status, last_opened_at AS send_at FROM su) WHERE status = 'active' AND send_at IS NOT NULL",
     lambda t: t.subscribers.withColumnRenamed("last_opened_at", "send_at"), "sendable_campaigns", ["id", "send_at"])
_hot("hot_anonymous_events", "SELECT id, anonymous_id, stage FROM fe WHERE anonymous_id IS NOT NULL",
     lambda t: t.funnel_events, "anonymous_events", ["id", "anonymous_id", "stage"])
_hot("hot_top_buyers", "SELECT id, ltv_cents FROM su WHERE status = 'active' AND has_purchased",
     lambda t: t.subscribers, "top_buyers", ["id", "ltv_cents"])
_hot("hot_active_products", "SELECT id, price_cents FROM dp WHERE is_active",
     lambda t: t.products, "active_products", ["id", "price_cents"])
_hot("hot_active_workflows", "SELECT id FROM (SELECT workflow_id AS id, count(*) AS n FROM lg GROUP BY 1) WHERE n > 0",
     lambda t: t.execution_logs.groupBy(F.col("workflow_id").alias("id")).agg((F.count(F.lit(1)) > 0).alias("is_active")),
     "active_workflows", ["id"])
_hot("hot_cancelling_members", "SELECT id, current_period_end FROM me WHERE cancel_at_period_end",
     lambda t: t.memberships, "cancelling_members", ["id", "current_period_end"])
_hot("hot_churned_members", "SELECT id, ended_at FROM me WHERE ended_at IS NOT NULL",
     lambda t: t.memberships, "churned_members", ["id", "ended_at"])
_hot("hot_recent_metrics", f"""SELECT metric_date, CAST(count(*) AS BIGINT) AS orders FROM (SELECT CAST(o_orderdate AS DATE) AS metric_date FROM orders)
     WHERE metric_date > {OA} - INTERVAL 90 DAY AND metric_date <= {OA} GROUP BY 1""",
     lambda t: t.orders.groupBy(F.to_date("o_orderdate").alias("metric_date")).agg(F.count(F.lit(1)).alias("orders")),
     "recent_metrics", ["metric_date", "orders"], ord_now)


def _visible(t: Tables, table: str, role: str, uid: str | None = None) -> DataFrame:
    frames = {
        "profiles": "profiles", "purchases": "purchases_hist", "memberships": "memberships", "affiliates": "affiliates",
        "purchase_items": "purchase_items", "affiliate_referrals": "referrals", "affiliate_commissions": "commissions",
        "content_videos": "videos", "digital_products": "products", "viral_hooks": "hooks",
        "membership_events": "purchases", "user_sessions": "funnel_events", "content_scripts": "scripts",
    }
    parents = {"purchase_items": ["purchases"], "affiliate_referrals": ["affiliates"], "affiliate_commissions": ["affiliates"]}
    names = {table, "profiles", *parents.get(table, [])}
    return access.visible({n: getattr(t, frames[n]) for n in names}, table, role, uid)


@op("rls_public", """SELECT 'content_videos' AS tbl, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM vi WHERE status = 'published'
    UNION ALL SELECT 'digital_products', count(*), CAST(sum(id) AS BIGINT) FROM dp WHERE is_active
    UNION ALL SELECT 'viral_hooks', count(*), CAST(sum(id) AS BIGINT) FROM ho
    UNION ALL SELECT 'profiles', 0, NULL UNION ALL SELECT 'purchases', 0, NULL UNION ALL SELECT 'content_scripts', 0, NULL""")
def _(t: Tables) -> DataFrame:
    out = None
    for name in ("content_videos", "digital_products", "viral_hooks", "profiles", "purchases", "content_scripts"):
        one = _visible(t, name, "anon").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")).select(
            F.lit(name).alias("tbl"), "n", F.col("ids").cast("long").alias("ids")
        )
        out = one if out is None else out.unionAll(one)
    return out


@op("rls_own_rows", """SELECT 'purchases' AS tbl, id FROM ph WHERE profile_id = 7
    UNION ALL SELECT 'memberships', id FROM me WHERE profile_id = 7
    UNION ALL SELECT 'affiliates', id FROM af WHERE profile_id = 7
    UNION ALL SELECT 'profiles', id FROM pr WHERE id = 7
    UNION ALL SELECT 'membership_events', id FROM pu WHERE profile_id = 7
    UNION ALL SELECT 'user_sessions', id FROM fe WHERE profile_id = 7""")
def _(t: Tables) -> DataFrame:
    out = None
    for name in ("purchases", "memberships", "affiliates", "profiles", "membership_events", "user_sessions"):
        one = _visible(t, name, "authenticated", "auth-7").select(F.lit(name).alias("tbl"), "id")
        out = one if out is None else out.unionAll(one)
    return out


@op("rls_two_hop", """SELECT 'purchase_items' AS tbl, purchase_id FROM it WHERE purchase_id IN (SELECT id FROM ph WHERE profile_id = 7)
    UNION ALL SELECT 'affiliate_referrals', purchase_id FROM rf WHERE affiliate_id IN (SELECT id FROM af WHERE profile_id = 7)
    UNION ALL SELECT 'affiliate_commissions', purchase_id FROM cm WHERE affiliate_id IN (SELECT id FROM af WHERE profile_id = 7)""")
def _(t: Tables) -> DataFrame:
    out = None
    for name in ("purchase_items", "affiliate_referrals", "affiliate_commissions"):
        one = _visible(t, name, "authenticated", "auth-7").select(F.lit(name).alias("tbl"), "purchase_id")
        out = one if out is None else out.unionAll(one)
    return out


@op("rls_service", "SELECT id, email FROM pr")
def _(t: Tables) -> DataFrame:
    return _visible(t, "profiles", "service_role").select("id", "email")


@op("rls_write_check", """WITH r AS (SELECT * FROM (VALUES ('anon'), ('authenticated'), ('service_role')) v(role)),
    t AS (SELECT * FROM (VALUES ('analytics_funnel_events'), ('analytics_page_views'), ('purchases')) v(tbl))
    SELECT id, tbl, role, role = 'service_role' OR (tbl <> 'purchases' AND (profile_id IS NULL OR (role = 'authenticated' AND profile_id = 7))) AS accepted
    FROM fe, r, t
    UNION ALL SELECT id, 'profiles', role, role = 'service_role' OR (role = 'authenticated' AND id = 7) FROM pr, r""")
def _(t: Tables) -> DataFrame:
    rows = t.funnel_events.select("id", "profile_id")
    out = None
    for table in ("analytics_funnel_events", "analytics_page_views", "purchases", "profiles"):
        written = t.profiles.select("id", "auth_id") if table == "profiles" else rows
        for role in ("anon", "authenticated", "service_role"):
            uid = "auth-7" if role == "authenticated" else None
            one = access.check_writes(written, t.profiles, table, role, uid)
            one = one.select("id", F.lit(table).alias("tbl"), F.lit(role).alias("role"), "accepted")
            out = one if out is None else out.unionAll(one)
    return out


@op("event_type_gate", """SELECT event_id AS id, event_type NOT IN ('purchase','signup') AS skip,
    CASE WHEN event_type NOT IN ('purchase','signup') THEN 'Unhandled event type' END AS reason FROM ev""")
def _(t: Tables) -> DataFrame:
    from growthloom.plans.purchases import checkouts

    return checkouts(t.checkout_messages).select("id", "skip", "reason")


@op("route", """SELECT event_id AS id, CASE WHEN event_type = 'signup' THEN 'subscription' ELSE 'payment' END AS branch FROM ev
    WHERE event_type IN ('purchase','signup')""")
def _(t: Tables) -> DataFrame:
    from growthloom.plans.purchases import checkouts

    handled = checkouts(t.checkout_messages).where("not skip")
    subs, pays = filters.route(handled, F.col("mode") == "subscription")
    return subs.select("id", F.lit("subscription").alias("branch")).unionAll(pays.select("id", F.lit("payment").alias("branch")))


@op("catalog_search", """SELECT p_partkey AS id, p_name AS name FROM part WHERE p_brand = 'Brand#13' AND p_type IN ('LARGE')
    AND lower(p_name) LIKE '%bolt%'""")
def _(t: Tables) -> DataFrame:
    shelf = t.raw("part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("platform"),
        F.array("p_type").alias("tools_required"),
    )
    return filters.search_catalog(shelf, {"platform": "Brand#13"}, ["LARGE"], "BOLT").select("id", "name")


@op("viral_flag", """SELECT id, total_views * 500 AS total_views, CASE WHEN total_views * 500 > 10000 THEN 'hard' ELSE 'soft' END AS cta
    FROM vi""")
def _(t: Tables) -> DataFrame:
    return filters.viral(t.videos.withColumn("total_views", F.col("total_views") * 500)).select("id", "total_views", "cta")
