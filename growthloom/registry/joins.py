"""Queries for joins."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import joins as J
from growthloom.plans import affiliate as AP
from growthloom.operators.revenue import with_product_type
from growthloom.registry.core import op
from growthloom.registry.duck import EVENTS_AS_OF as EA
from growthloom.sources.fixtures import AS_OF_EVENTS, Tables, as_ts


@op("join_members_profiles", "SELECT me.id, me.status, pr.email, pr.full_name FROM me JOIN pr ON pr.id = me.profile_id")
def _(t: Tables) -> DataFrame:
    return J.members(t.memberships, t.profiles).select("id", "status", "email", "full_name")


@op("join_purchase_product", "SELECT pu.id, dp.product_type, pu.amount_cents FROM pu JOIN dp ON dp.id = pu.product_id")
def _(t: Tables) -> DataFrame:
    return with_product_type(t.purchases, t.products).select("id", "product_type", "amount_cents")


@op("join_video_hook", "SELECT vi.id, ho.hook_text, vi.total_views FROM vi JOIN ho ON ho.id = vi.hook_id")
def _(t: Tables) -> DataFrame:
    hooks = t.hooks.select(F.col("id").alias("hook_id"), "hook_text")
    return t.videos.join(hooks, "hook_id").select("id", "hook_text", "total_views")


@op("workflow_left_join", f"""SELECT wf.id, wf.name, lg.id AS run_id, lg.status FROM wf LEFT JOIN lg ON lg.workflow_id = wf.id
    AND lg.started_at >= {EA} - INTERVAL 24 HOUR AND lg.started_at <= {EA}""")
def _(t: Tables) -> DataFrame:
    now = as_ts(AS_OF_EVENTS)
    recent = (F.col("started_at") >= now - F.expr("interval 24 hours")) & (F.col("started_at") <= now)
    return J.workflow_logs(t.workflows, t.execution_logs, recent).select("id", "name", "run_id", "status")


@op("workflow_inner_join", f"""SELECT wf.id, wf.name, lg.id AS run_id, lg.status FROM wf JOIN lg ON lg.workflow_id = wf.id
    WHERE lg.started_at >= {EA} - INTERVAL 24 HOUR AND lg.started_at <= {EA}""")
def _(t: Tables) -> DataFrame:
    now = as_ts(AS_OF_EVENTS)
    recent = (F.col("started_at") >= now - F.expr("interval 24 hours")) & (F.col("started_at") <= now)
    return J.workflow_logs(t.workflows, t.execution_logs, recent, keep_idle=False).select("id", "name", "run_id", "status")


@op("combine_aggregates", """SELECT (SELECT count(*) FROM fe) AS funnel_events, (SELECT CAST(sum(amount_cents) AS BIGINT) FROM pu WHERE status = 'completed') AS revenue_cents,
    (SELECT count(*) FROM su WHERE status = 'active') AS total_subscribers, (SELECT count(*) FROM lg WHERE status = 'failed') AS failed""")
def _(t: Tables) -> DataFrame:
    # One pass per table; the one-row results meet as scalar subqueries.
    money = t.purchases.where("status = 'completed'").agg(F.sum("amount_cents")).scalar()
    subs = t.subscribers.where("status = 'active'").agg(F.count(F.lit(1))).scalar()
    failed = t.execution_logs.where("status = 'failed'").agg(F.count(F.lit(1))).scalar()
    base = t.funnel_events.agg(F.count(F.lit(1)).alias("funnel_events"))
    return base.select("funnel_events", money.alias("revenue_cents"), subs.alias("total_subscribers"), failed.alias("failed"))


@op("tag_cross_lookup", """SELECT su.id AS subscriber_id, 'churn-risk-expiring' AS tag FROM su WHERE su.email IN
    (SELECT pr.email FROM me JOIN pr ON pr.id = me.profile_id WHERE me.status = 'past_due')""")
def _(t: Tables) -> DataFrame:
    # A constant tag needs no join: it is a column on the matched subscribers.
    risky = J.members(t.memberships.where("status = 'past_due'"), t.profiles).select("email")
    return t.subscribers.join(risky, "email", "left_semi").select(
        F.col("id").alias("subscriber_id"), F.lit("churn-risk-expiring").alias("tag")
    )


@op("or_key_lookup", """SELECT m.id, coalesce(a.id, b.id) AS product_id, CASE WHEN a.id IS NOT NULL THEN 'product_key'
      WHEN b.id IS NOT NULL THEN 'price_key' END AS matched_on
    FROM (SELECT event_id AS id, CASE WHEN k < 60 THEN CAST(k AS VARCHAR) END AS pk, CASE WHEN k >= 40 THEN 'price_' || k END AS rk FROM ev) m
    LEFT JOIN dp a ON CAST(a.id AS VARCHAR) = m.pk
    LEFT JOIN (SELECT min(id) AS id, 'price_' || (id % 70) AS price FROM dp GROUP BY 2) b ON b.price = m.rk""")
def _(t: Tables) -> DataFrame:
    asked = t.events.select(
        F.col("event_id").alias("id"), F.when(F.col("k") < 60, F.col("k").cast("string")).alias("product_key"),
        F.when(F.col("k") >= 40, F.concat(F.lit("price_"), F.col("k"))).alias("price_key"),
    )
    shelf = t.products.select(F.col("id").alias("product_id"), F.col("id").cast("string").alias("_pid"),
                              F.concat(F.lit("price_"), F.col("id") % 70).alias("stripe_price_id"))  # prices that products share
    found = J.or_lookup(asked, shelf, [("product_key", "_pid"), ("price_key", "stripe_price_id")], ["product_id"])
    return found.select("id", "product_id", "matched_on")


@op("anti_used", "SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def _(t: Tables) -> DataFrame:
    used = t.purchase_items.where("quantity >= 49").select(F.col("product_id").alias("id"))
    return J.unused(t.products.select("id"), used, "id")


@op("semi_owned", "SELECT id, amount_cents FROM ph WHERE profile_id IN (SELECT id FROM pr WHERE acct_cents < 0)")
def _(t: Tables) -> DataFrame:
    owners = t.profiles.where("acct_cents < 0").select(F.col("id").alias("profile_id"))
    return t.purchases_hist.join(owners, "profile_id", "left_semi").select("id", "amount_cents")


@op("zip_by_position", """SELECT a.position, a.o_orderkey AS order_id, b.event_id FROM
    (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders) a
    JOIN (SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS position FROM events) b USING (position)""")
def _(t: Tables) -> DataFrame:
    orders = t.raw("orders").select(F.col("o_orderkey").alias("order_id"), "o_totalprice")
    events = t.raw("events").select("event_id", "value")
    zipped = J.zip_rows(
        orders, events, [F.desc_nulls_last("o_totalprice"), F.asc("order_id")], [F.desc_nulls_last("value"), F.asc("event_id")]
    )
    return zipped.select("position", "order_id", "event_id")


@op("line_visual_align", """SELECT id, CAST(line_no AS BIGINT) AS line_no, line, seen[least(line_no, len(seen))] AS visual
    FROM (SELECT id, list_filter(lines, lambda x, i: i % 2 = 1) AS seen, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM sc)""")
def _(t: Tables) -> DataFrame:
    # Every second line is a visual.
    seen = t.scripts.withColumn("visuals", F.filter("lines", lambda x, i: i % 2 == 0))
    return J.align(seen, ["id"], "lines", "visuals")


@op("update_from_join", """SELECT vi.id, coalesce(s.views, vi.total_views) AS total_views, CASE WHEN s.views IS NOT NULL THEN s.likes END AS day_likes
    FROM vi LEFT JOIN (SELECT video_id, CAST(sum(views) AS BIGINT) AS views, CAST(sum(likes) AS BIGINT) AS likes FROM ce
      WHERE event_date = DATE '2024-01-30' GROUP BY 1) s ON s.video_id = vi.id""")
def _(t: Tables) -> DataFrame:
    from growthloom.operators.upsert import update_from

    day = t.content_events.where("event_date = date'2024-01-30'").groupBy(F.col("video_id").alias("id")).agg(
        F.sum("views").alias("views"), F.sum("likes").alias("likes")
    )
    return update_from(t.videos.select("id", "total_views"), day, ["id"],
                       {"total_views": F.col("views"), "day_likes": F.col("likes")})


# A click (order) lasts the cookie days of its affiliate; every line of the order may be another affiliate's.
CLICKS = """(SELECT DISTINCT rf.affiliate_id, rf.profile_id, rf.clicked_at AS at, rf.purchase_id AS id, af.cookie_days AS days FROM rf JOIN af ON af.id = rf.affiliate_id{active})"""
SALES = """(SELECT DISTINCT profile_id, converted_at AS at, CAST(purchase_id * 10 + line_no AS BIGINT) AS id FROM rf)"""


def clicks(t: Tables) -> DataFrame:
    return t.referrals.select("affiliate_id", "profile_id", F.col("clicked_at").alias("at"), F.col("purchase_id").alias("id")).distinct()


@op("cookie_window_join", f"""SELECT b.id, b.profile_id, b.at, max((c.at, c.id, c.affiliate_id))[3] AS affiliate_id, max((c.at, c.id, c.affiliate_id))[2] AS click_id
    FROM {SALES} b JOIN {CLICKS.format(active='')} c ON c.profile_id = b.profile_id AND c.at <= b.at AND c.at + to_days(c.days) >= b.at GROUP BY 1, 2, 3""")
def _(t: Tables) -> DataFrame:
    lasting = clicks(t).join(t.affiliates.select(F.col("id").alias("affiliate_id"), F.col("cookie_days").alias("days")), "affiliate_id")
    buys = t.referrals.select(
        "profile_id", F.col("converted_at").alias("at"), (F.col("purchase_id") * 10 + F.col("line_no")).alias("id")).distinct()
    done = J.attribute_each(lasting.withColumnRenamed("affiliate_id", "by"), buys, ["profile_id"])
    return done.where("click_id is not null").select("id", "profile_id", "at", F.col("by").alias("affiliate_id"), "click_id")


@op("attributed_commissions", f"""WITH won AS (SELECT b.id, b.profile_id, b.at, max((c.at, c.id, c.affiliate_id))[3] AS affiliate_id, max((c.at, c.id, c.affiliate_id))[2] AS click_id
      FROM (SELECT s.profile_id, s.id, min(s."at") AS "at" FROM {SALES} s GROUP BY 1, 2) b JOIN {CLICKS.format(active=' AND af.is_active')} c ON c.profile_id = b.profile_id AND c.at <= b.at AND c.at + to_days(c.days) >= b.at GROUP BY 1, 2, 3),
    sold AS (SELECT CAST(it.purchase_id * 10 + it.line_no AS BIGINT) AS id, max((it.line_cents, it.product_id)) AS s FROM it GROUP BY 1)
    SELECT won.id, won.affiliate_id, won.click_id, CASE tier WHEN 'premium' THEN CAST(floor(base * 1.1::DOUBLE + 0.5) AS BIGINT)
      WHEN 'elite' THEN CAST(floor(base * 1.25::DOUBLE + 0.5) AS BIGINT) ELSE CAST(base AS BIGINT) END AS amount_cents
    FROM (SELECT won.*, floor(CAST(s[1] AS DOUBLE) * (CASE dp.product_type WHEN 'membership' THEN 30 WHEN 'automation_package' THEN 20 ELSE 40 END / 100.0::DOUBLE) + 0.5) AS base
          FROM won JOIN sold USING (id) JOIN dp ON dp.id = s[2]) won JOIN af ON af.id = won.affiliate_id""")
def _(t: Tables) -> DataFrame:
    # Line numbers repeat within some orders: the dearest of the lines is what was sold, the first one says when.
    line = (F.col("purchase_id") * 10 + F.col("line_no")).alias("id")
    sold = t.purchase_items.groupBy(line).agg(F.max(F.struct("line_cents", "product_id")).alias("s"))
    kinds = t.products.select(F.col("id").alias("product_id"), "product_type")
    sold = sold.select("id", F.col("s.line_cents").alias("amount_cents"), F.col("s.product_id").alias("product_id")).join(kinds, "product_id")
    sales = t.referrals.groupBy("profile_id", line).agg(F.min("converted_at").alias("at")).join(sold, "id")
    return AP.attributed_commissions(clicks(t), sales, t.affiliates).select("id", "affiliate_id", "click_id", "amount_cents")


@op("referral_conversion", """SELECT affiliate_id, count(*) AS conversions, CAST(sum(amount_cents) AS BIGINT) AS amount_cents FROM rf
    WHERE converted_at >= clicked_at AND converted_at <= clicked_at + INTERVAL 60 DAY GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    reach = F.col("converted_at").between(F.col("clicked_at"), F.col("clicked_at") + F.expr("interval 60 days"))
    return t.referrals.where(reach).groupBy("affiliate_id").agg(
        F.count(F.lit(1)).alias("conversions"), F.sum("amount_cents").alias("amount_cents")
    )


@op("content_to_conversion", """SELECT vi.id, vi.hook_id, coalesce(f.views, 0) AS views, coalesce(f.leads, 0) AS leads, coalesce(f.sales, 0) AS sales,
    coalesce(p.revenue_cents, 0) AS revenue_cents FROM vi
    LEFT JOIN (SELECT source_video_id, count(*) FILTER (stage = 'content_view') AS views, count(*) FILTER (stage = 'lead_magnet_download') AS leads,
      count(*) FILTER (stage IN ('tripwire_purchase','membership_purchased','automation_package_purchase')) AS sales FROM fe GROUP BY 1) f ON f.source_video_id = vi.id
    LEFT JOIN (SELECT source_video_id, CAST(sum(amount_cents) AS BIGINT) AS revenue_cents FROM pu WHERE status = 'completed' GROUP BY 1) p
      ON p.source_video_id = vi.id""")
def _(t: Tables) -> DataFrame:
    return J.video_attribution(t.funnel_events, t.purchases, t.videos)


@op("self_join_referrer", """SELECT p.id, p.email, r.n AS referrals, r.n >= 3 AS free_membership FROM pr p JOIN
    (SELECT referred_by, count(*) AS n FROM pr WHERE referred_by IS NOT NULL GROUP BY 1) r ON r.referred_by = p.id""")
def _(t: Tables) -> DataFrame:
    return J.referral_counts(t.profiles)


@op("version_chain", """SELECT * FROM (WITH RECURSIVE up AS (SELECT doc_id AS id, doc_id AS root, CAST(0 AS BIGINT) AS depth FROM documents
      UNION ALL SELECT up.id, up.root // 3, up.depth + 1 FROM up WHERE up.root > 0)
    SELECT id, root, depth FROM up WHERE root = 0)""")
def _(t: Tables) -> DataFrame:
    return J.version_lineage(t.scripts.select("id", "previous_version_id"))


@op("campaign_audience", """SELECT c.campaign_id, s.subscriber_id FROM (SELECT unnest(range(5)) AS campaign_id) c
    JOIN (SELECT DISTINCT subscriber_id FROM st) s ON true
    WHERE EXISTS (SELECT 1 FROM st x WHERE x.subscriber_id = s.subscriber_id AND x.tag IN ('purchase-' || c.campaign_id, 'signup-' || (c.campaign_id + 5)))
      AND NOT EXISTS (SELECT 1 FROM st x WHERE x.subscriber_id = s.subscriber_id AND x.tag = 'error-' || (c.campaign_id * 2))""")
def _(t: Tables) -> DataFrame:
    i = F.col("campaign_id")
    campaigns = t.campaign_logs.select("campaign_id").distinct().select(
        "campaign_id",
        F.array(F.concat(F.lit("purchase-"), i), F.concat(F.lit("signup-"), i + 5)).alias("target_tags"),
        F.array(F.concat(F.lit("error-"), i * 2)).alias("exclude_tags"),
    )
    return J.audience(campaigns, t.subscriber_tags)


@op("abandoned_checkout", f"""SELECT s.id, s.person, s.created_at AS at, CASE WHEN {EA} - s.created_at >= INTERVAL 48 HOUR THEN 3
      WHEN {EA} - s.created_at >= INTERVAL 24 HOUR THEN 2 WHEN {EA} - s.created_at >= INTERVAL 1 HOUR THEN 1 ELSE 0 END AS step
    FROM fe s WHERE s.stage IN ('tripwire_view','membership_view') AND NOT EXISTS (SELECT 1 FROM fe b WHERE b.person = s.person
      AND b.stage IN ('tripwire_purchase','membership_purchased') AND b.created_at >= s.created_at AND b.created_at <= s.created_at + INTERVAL 48 HOUR)""")
def _(t: Tables) -> DataFrame:
    ev = t.funnel_events.select("person", "id", F.col("created_at").alias("at"), "stage")
    starts = ev.where(F.col("stage").isin("tripwire_view", "membership_view"))
    buys = ev.where(F.col("stage").isin("tripwire_purchase", "membership_purchased"))
    return J.abandoned(starts, buys, "person", as_ts(AS_OF_EVENTS))


@op("hook_winner", """SELECT h.id, h.variant_group, w.id AS winning_variant_id FROM ho h LEFT JOIN
    (SELECT variant_group, id FROM ho WHERE actual_performance IS NOT NULL
     QUALIFY row_number() OVER (PARTITION BY variant_group ORDER BY actual_performance DESC, id) = 1) w USING (variant_group)""")
def _(t: Tables) -> DataFrame:
    return J.pick_winner(t.hooks).select("id", "variant_group", "winning_variant_id")
