"""Queries for the composite jobs."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import affiliates as AF
from growthloom.operators import content as C
from growthloom.operators import members, upsert as U
from growthloom.plans import affiliate as AP
from growthloom.plans import booking, daily, delta_mart, drafts, leads, membership, packages, purchases as P, weekly, welcome
from growthloom.registry.core import op
from growthloom.registry.duck import EVENTS_AS_OF as EA, ORDERS_AS_OF as OA
from growthloom.registry.sources import mart, sources
from growthloom.session import scratch_path
from growthloom.sources.fixtures import AS_OF_EVENTS, AS_OF_ORDERS, LAST_DAY, Tables, as_ts
from growthloom.sources.sinks import overwrite_partitions

_LEAD = """(SELECT event_id AS id, ts AS received_at, event_id % 10 <> 7 AS valid,
    'customer.' || lpad(CAST(user_id AS VARCHAR), 9, '0') || CASE WHEN event_id % 10 = 7 THEN '(at)' ELSE '@' END || 'example.com' AS email,
    CASE WHEN k < 50 THEN 'Lead' WHEN event_id % 10 = 7 THEN 'customer.(at)example.com' ELSE 'customer.' END AS full_name,
    CASE WHEN k % 2 = 0 THEN 'referral' ELSE 'landing_page' END AS source, k % 3 = 0 AS double_opt_in_confirmed,
    CASE WHEN k % 4 = 0 THEN 'https://example.com/p/' || k ELSE '' END AS source_url, CASE WHEN k % 5 = 0 THEN 'v' || k END AS source_video_id,
    CASE WHEN k % 3 = 0 THEN '10.0.0.' || k ELSE '' END AS consent_ip, ts AS consent_timestamp FROM ev WHERE event_type = 'signup')"""


def _known(t: Tables) -> DataFrame:
    """Subscribers there before the leads: those who already bought for 600 or more."""
    return t.subscribers.where("ltv_cents >= 60000")


@op("lead_rows", f"SELECT * FROM {_LEAD}")
def _(t: Tables) -> DataFrame:
    return leads.clean_leads(t.lead_messages)


@op("lead_capture", f"""SELECT email, full_name, source, source_url, source_video_id, double_opt_in_confirmed, consent_ip, consent_timestamp, received_at AS created_at, 'active' AS status FROM {_LEAD} l
    WHERE valid AND email NOT IN (SELECT email FROM su WHERE ltv_cents >= 60000)
    QUALIFY row_number() OVER (PARTITION BY email ORDER BY received_at, id) = 1""")
def _(t: Tables) -> DataFrame:
    return leads.lead_capture(t.lead_messages, _known(t)).new_subscribers


@op("lead_capture_tags", f"""SELECT DISTINCT email, unnest(['source-' || source, 'lead-magnet']) AS tag FROM {_LEAD} l WHERE valid""")
def _(t: Tables) -> DataFrame:
    return leads.lead_capture(t.lead_messages, _known(t)).tags


@op("lead_capture_invalid", f"SELECT id, email FROM {_LEAD} l WHERE NOT valid")
def _(t: Tables) -> DataFrame:
    return leads.lead_capture(t.lead_messages, _known(t)).invalid.select("id", "email")


@op("purchase_intake", """SELECT ev.event_id AS id, 'cs_' || event_id AS processor_charge_id, CAST(k AS BIGINT) AS product_id, dp.product_type,
    CASE WHEN k < 50 THEN 'meta_product_id' ELSE 'meta_price_id' END AS matched_on, user_id AS profile_id,
    'customer.' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.com' AS customer_email, val_cents AS amount_cents, 'usd' AS currency,
    'completed' AS status, ts AS created_at FROM ev JOIN dp ON dp.id = ev.k WHERE event_type = 'purchase'""")
def _(t: Tables) -> DataFrame:
    return P.purchases_from(t.checkout_messages, t.products, t.profiles).purchases


@op("purchase_intake_skipped", "SELECT event_id AS id, 'page.' || event_type AS event_type, 'Unhandled event type' AS reason FROM ev WHERE event_type NOT IN ('purchase','signup')")
def _(t: Tables) -> DataFrame:
    return P.purchases_from(t.checkout_messages, t.products, t.profiles).skipped.select("id", "event_type", "reason")


@op("purchase_intake_ltv", """SELECT su.id, su.ltv_cents + coalesce(p.s, 0) AS ltv_cents FROM su LEFT JOIN
    (SELECT user_id, CAST(sum(val_cents) AS BIGINT) AS s FROM ev WHERE event_type = 'purchase' GROUP BY 1) p ON p.user_id = su.id""")
def _(t: Tables) -> DataFrame:
    bought = P.purchases_from(t.checkout_messages, t.products, t.profiles).purchases
    return P.buyer_ltv(t.subscribers.select("id", "ltv_cents"), bought)


# Messages of every seventh event come again two days later; every third subscriber and profile is there before.
_SOLD = """(SELECT event_id, user_id, val_cents, ts, k, dp.id AS product_id, dp.product_type, dp.first_file, 'customer.' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.com' AS email
    FROM ev JOIN dp ON dp.id = ev.k WHERE event_type = 'purchase')"""
_KNOWN = "(SELECT * FROM su WHERE id % 3 = 0)"


def sent_twice(t: Tables) -> DataFrame:
    again = t.checkout_messages.where("id % 7 = 0").withColumn("received_at", F.col("received_at") + F.expr("interval 2 days"))
    return t.checkout_messages.unionByName(again)


def books(t: Tables) -> booking.Books:
    never = F.lit(None).cast("timestamp_ntz")
    subs = t.subscribers.where("id % 3 = 0").select(
        F.col("id").cast("string"), "email", "full_name", "source", "status", F.lit(False).alias("has_purchased"), "ltv_cents", never.alias("updated_at"))
    profs = t.profiles.where("id % 3 = 0").select(
        F.col("id").cast("string"), "email", "full_name", F.concat(F.lit("old_"), "id").alias("stripe_customer_id"), never.alias("updated_at"))
    return booking.Books(subs, profs, t.subscriber_tags.where("subscriber_id % 3 = 0").select(F.col("subscriber_id").cast("string"), "tag"))


_BOOKED_SUBSCRIBERS = f"""SELECT coalesce(CAST(s.id AS VARCHAR), sha256(p.email)) AS id, coalesce(s.email, p.email) AS email, coalesce(s.source, 'purchase') AS source,
    coalesce(s.status, 'active') AS status, p.email IS NOT NULL AS has_purchased, CAST(coalesce(s.ltv_cents, 0) + coalesce(p.cents, 0) AS BIGINT) AS ltv_cents, p.seen AS updated_at
    FROM {_KNOWN} s FULL JOIN (SELECT email, sum(val_cents) AS cents, max(ts) AS seen FROM {_SOLD} GROUP BY 1) p ON p.email = s.email"""


@op("booked_subscribers", _BOOKED_SUBSCRIBERS)
def _(t: Tables) -> DataFrame:
    return booking.book_messages(sent_twice(t), t.products, books(t))[1].subscribers.drop("full_name")


@op("booked_profiles", f"""SELECT coalesce(CAST(s.id AS VARCHAR), sha256(p.email)) AS id, coalesce(s.email, p.email) AS email, coalesce(s.full_name, p.full_name) AS full_name,
    coalesce(p.customer, 'old_' || s.id) AS stripe_customer_id FROM (SELECT * FROM pr WHERE id % 3 = 0) s FULL JOIN
    (SELECT email, any_value('cus_' || user_id) AS customer, any_value('Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')) AS full_name FROM {_SOLD} GROUP BY 1) p ON p.email = s.email""")
def _(t: Tables) -> DataFrame:
    return booking.book_messages(sent_twice(t), t.products, books(t))[1].profiles.drop("updated_at")


@op("booked_items", f"""SELECT event_id AS purchase_id, product_id, CAST(1 AS BIGINT) AS quantity, val_cents AS unit_price_cents, true AS access_granted, ts AS access_granted_at,
    first_file AS download_url FROM {_SOLD}""")
def _(t: Tables) -> DataFrame:
    return booking.book_messages(sent_twice(t), t.products, books(t))[0]["items"]


@op("booked_purchases", f"""SELECT event_id AS id, 'cs_' || event_id AS processor_charge_id, product_id, CASE WHEN user_id % 3 = 0 AND user_id IN (SELECT id FROM su) THEN CAST(user_id AS VARCHAR)
    ELSE sha256(email) END AS subscriber_id, val_cents AS amount_cents, ts AS created_at FROM {_SOLD}""")
def _(t: Tables) -> DataFrame:
    made = booking.book_messages(sent_twice(t), t.products, books(t))[0]["purchases"]
    return made.select("id", "processor_charge_id", "product_id", "subscriber_id", "amount_cents", "created_at")


@op("booked_tags", f"""SELECT CAST(subscriber_id AS VARCHAR) AS subscriber_id, tag FROM st WHERE subscriber_id % 3 = 0 UNION
    SELECT CASE WHEN user_id % 3 = 0 AND user_id IN (SELECT id FROM su) THEN CAST(user_id AS VARCHAR) ELSE sha256(email) END, 'purchased-' || replace(product_type, '_', '-') FROM {_SOLD}""")
def _(t: Tables) -> DataFrame:
    return booking.book_messages(sent_twice(t), t.products, books(t))[1].tags


@op("membership_sync", """WITH msg AS (SELECT o_orderkey, o_custkey, o_orderdate, price_cents, o_orderkey % 11 AS m, o_orderkey % 17 = 0 AS flag, o_orderstatus FROM orr
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT 'sub_' || o_custkey AS stripe_subscription_id, CASE WHEN m = 1 THEN 'canceled' WHEN o_orderstatus = 'P' THEN 'past_due' ELSE 'active' END AS status,
      o_orderdate AS current_period_start, o_orderdate + INTERVAL 30 DAY AS current_period_end, flag AS cancel_at_period_end,
      CASE WHEN m = 1 THEN o_orderdate END AS ended_at, CASE WHEN m = 1 OR flag THEN o_orderdate END AS canceled_at,
      CASE WHEN me.profile_id IS NULL AND o_orderkey % 13 = 0 THEN o_orderdate END AS trial_start,
      CASE WHEN me.profile_id IS NULL AND o_orderkey % 13 = 0 THEN o_orderdate + INTERVAL 14 DAY END AS trial_end,
      CASE WHEN me.profile_id IS NULL THEN 'plan_' || (o_orderkey % 3) ELSE 'plan_kept' END AS plan_id, coalesce(me.price_cents, msg.price_cents) AS price_cents
    FROM msg LEFT JOIN (SELECT * FROM me WHERE status <> 'past_due') me ON me.profile_id = msg.o_custkey""")
def _(t: Tables) -> DataFrame:
    cols = ["stripe_subscription_id", *[c for c in membership.SYNCED if c != "canceled_at"], "price_cents"]
    never = F.lit(None).cast("timestamp_ntz")
    there = t.memberships.where("status <> 'past_due'").select(
        *cols, *[never.alias(c) for c in ("canceled_at", "trial_start", "trial_end")], F.lit("plan_kept").alias("plan_id"))
    return membership.membership_sync(there, t.subscription_messages)


@op("purchase_intake_tags", """SELECT subscriber_id, tag FROM st UNION SELECT user_id, 'purchased-' || replace(dp.product_type, '_', '-') FROM ev JOIN dp ON dp.id = ev.k
    WHERE event_type = 'purchase'""")
def _(t: Tables) -> DataFrame:
    return P.purchase_tags(t.subscriber_tags, P.purchases_from(t.checkout_messages, t.products, t.profiles).purchases)


@op("membership_profiles", """SELECT 'cus_' || o_custkey AS stripe_customer_id, CASE WHEN m = 1 THEN 'canceled' WHEN st = 'P' THEN 'past_due' ELSE 'active' END AS status,
    coalesce(CAST(p.id AS VARCHAR), sha256('cus_' || o_custkey)) AS profile_id, p.id IS NULL AS needs_creation, m <> 1 AND st <> 'P' AS is_member
    FROM (SELECT o_custkey, o_orderkey % 11 AS m, o_orderstatus AS st FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    LEFT JOIN (SELECT id FROM pr WHERE acct_cents >= 0) p ON p.id = o_custkey""")
def _(t: Tables) -> DataFrame:
    rows = membership.subscription_rows(t.subscription_messages)
    return membership.resolve_profiles(rows, t.profiles.where("acct_cents >= 0"))


@op("affiliate_run", """SELECT purchase_id, affiliate_id, purchase_cents, CASE tier WHEN 'premium' THEN CAST(floor(base * 1.1::DOUBLE + 0.5) AS BIGINT)
      WHEN 'elite' THEN CAST(floor(base * 1.25::DOUBLE + 0.5) AS BIGINT) ELSE CAST(base AS BIGINT) END AS amount_cents, commission_type, status FROM
    (SELECT pu.id AS purchase_id, pu.affiliate_id, af.tier, pu.amount_cents AS purchase_cents,
       floor(CAST(pu.amount_cents AS DOUBLE) * (CASE dp.product_type WHEN 'membership' THEN 30 WHEN 'automation_package' THEN 20 ELSE 40 END / 100.0::DOUBLE) + 0.5) AS base,
       CASE WHEN dp.product_type = 'membership' THEN 'recurring' ELSE 'one_time' END AS commission_type, 'pending' AS status
     FROM pu JOIN af ON af.id = pu.affiliate_id AND af.is_active JOIN dp ON dp.id = pu.product_id)""")
def _(t: Tables) -> DataFrame:
    return AF.affiliate_run(t.purchases, t.affiliates, t.products).select(
        "purchase_id", "affiliate_id", "purchase_cents", "amount_cents", "commission_type", "status"
    )


@op("affiliate_commissions", """SELECT purchase_id, affiliate_id, sha2 AS referral_id, commission_cents AS amount_cents, CASE WHEN is_recurring THEN 'recurring' ELSE 'one_time' END AS commission_type,
      rate AS rate_pct, CASE WHEN is_recurring THEN 'sub_' || user_id END AS source_membership_id, received_at AS created_at, 'pending' AS status
    FROM (SELECT *, sha256('referral/' || purchase_id || '/' || affiliate_id) AS sha2 FROM ac WHERE is_active)""")
def _(t: Tables) -> DataFrame:
    return AP.affiliate_sync(t.affiliate_messages, t.affiliates).commissions.select(
        F.col("source_purchase_id").alias("purchase_id"), "affiliate_id", "referral_id", "amount_cents", "commission_type", "rate_pct",
        "source_membership_id", "created_at", "status")


@op("affiliate_referrals", """SELECT purchase_id, affiliate_id, email AS referred_email, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS referred_profile_id,
      amount_cents AS purchase_amount_cents, commission_cents, true AS converted, received_at AS converted_at FROM ac WHERE is_active""")
def _(t: Tables) -> DataFrame:
    return AP.affiliate_sync(t.affiliate_messages, t.affiliates).referrals.drop("id")


@op("affiliate_totals", """SELECT af.id, CAST(af.total_earned_cents + coalesce(c.s, 0) AS BIGINT) AS total_earned_cents, af.total_paid_cents,
      CAST(af.pending_cents + coalesce(c.s, 0) AS BIGINT) AS pending_cents FROM af LEFT JOIN
      (SELECT affiliate_id, sum(commission_cents) AS s FROM ac WHERE is_active GROUP BY 1) c ON c.affiliate_id = af.id""")
def _(t: Tables) -> DataFrame:
    return AP.affiliate_sync(t.affiliate_messages, t.affiliates).affiliates.select("id", "total_earned_cents", "total_paid_cents", "pending_cents")


@op("affiliate_rejected", """SELECT purchase_id, CASE WHEN am.affiliate_id IS NULL THEN 'unknown' ELSE 'inactive' END AS reason
    FROM am LEFT JOIN af ON af.id = am.affiliate_id WHERE am.affiliate_id IS NULL OR NOT af.is_active""")
def _(t: Tables) -> DataFrame:
    return AP.affiliate_sync(t.affiliate_messages, t.affiliates).rejected.select("purchase_id", "reason")


@op("affiliate_recurrence", """SELECT purchase_id, 'sub_' || user_id AS source_membership_id, row_number() OVER (PARTITION BY user_id ORDER BY received_at, purchase_id) AS recurrence_number
    FROM ac WHERE is_active AND is_recurring""")
def _(t: Tables) -> DataFrame:
    made = AP.affiliate_sync(t.affiliate_messages, t.affiliates).commissions
    return AP.number_recurring(made).select(F.col("source_purchase_id").alias("purchase_id"), "source_membership_id", "recurrence_number")


@op("churn_alerts", f"""SELECT id, email, category FROM (SELECT me.id, pr.email, CASE
      WHEN status IN ('active','trialing') AND current_period_end BETWEEN {OA} AND {OA} + INTERVAL 5 DAY THEN
        CASE WHEN cancel_at_period_end THEN 'cancelling' ELSE 'renewing_soon' END
      WHEN status IN ('past_due','incomplete') THEN 'past_due'
      WHEN status = 'canceled' AND ended_at BETWEEN {OA} - INTERVAL 24 HOUR AND {OA} THEN 'churned' END AS category
    FROM me JOIN pr ON pr.id = me.profile_id) WHERE category IS NOT NULL""")
def _(t: Tables) -> DataFrame:
    return members.churn_report(t.memberships, t.profiles, as_ts(AS_OF_ORDERS)).select("id", "email", "category")


@op("churn_risk_tags", f"""SELECT subscriber_id, tag FROM st UNION SELECT id, 'churn-risk-expiring' FROM su WHERE email IN (SELECT pr.email FROM me JOIN pr ON pr.id = me.profile_id
    WHERE status = 'past_due' OR (status IN ('active','trialing') AND NOT cancel_at_period_end AND current_period_end BETWEEN {OA} AND {OA} + INTERVAL 5 DAY))""")
def _(t: Tables) -> DataFrame:
    report = members.churn_report(t.memberships, t.profiles, as_ts(AS_OF_ORDERS))
    risky = report.where("category in ('renewing_soon', 'past_due')").select("email")
    who = t.subscribers.join(risky, "email", "left_semi").select(F.col("id").alias("subscriber_id"))
    return U.tag(t.subscriber_tags, who, "churn-risk-expiring")


def _welcome(t: Tables) -> welcome.WelcomeResult:
    starts = t.subscribers.where("last_opened_at is not null").select(
        F.col("id").alias("subscriber_id"), F.col("last_opened_at").alias("started_at")
    )
    now = as_ts(AS_OF_EVENTS)
    return welcome.welcome_run(starts, t.subscriber_tags, now - F.expr("interval 24 hours"), now)


@op("welcome_run", f"""SELECT subscriber_id, CAST(i + 1 AS BIGINT) AS step, send_at FROM (SELECT id AS subscriber_id, i, last_opened_at + to_hours(CAST(i * 24 AS INTEGER)) AS send_at
    FROM su, (SELECT unnest(range(5)) AS i)) WHERE send_at > {EA} - INTERVAL 24 HOUR AND send_at <= {EA}""")
def _(t: Tables) -> DataFrame:
    return _welcome(t).due.select("subscriber_id", "step", "send_at")


@op("welcome_run_tags", f"""SELECT subscriber_id, tag FROM st UNION SELECT id, CASE WHEN last_opened_at + INTERVAL 96 HOUR <= {EA} THEN 'welcome-completed'
    ELSE 'welcome-started' END FROM su WHERE last_opened_at IS NOT NULL""")
def _(t: Tables) -> DataFrame:
    return _welcome(t).tags


def _scored(t: Tables) -> DataFrame:
    return t.scripts.select(
        "id", "category", "lines", (F.lit(7.0) + (F.col("id") * 7 % 30) / F.lit(10.0)).alias("score"),
        F.element_at("lines", 1).alias("hook_text"),
    )


@op("production_packages", """SELECT p.id, category, p.n_lines, p.total_s, p.last_overlay, CASE WHEN 7 + (p.id * 7 % 30) / 10.0::DOUBLE > 9.2 THEN 'High' ELSE 'Medium' END AS priority FROM
    (SELECT id, category, count(*) AS n_lines, round(CAST(sum(words) AS BIGINT) * 45 / 100.0::DOUBLE, 2) AS total_s,
       arg_max(upper(replace(array_to_string(list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')[1:2], ' '), 'ß', 'SS')), line_no) AS last_overlay FROM wl GROUP BY 1, 2) p""")
def _(t: Tables) -> DataFrame:
    made = packages.packages(_scored(t))
    return made.select(
        "id", "category", F.size("lines").cast("long").alias("n_lines"), "total_s",
        F.element_at("lines", -1)["text_overlay"].alias("last_overlay"), "priority",
    )


@op("production_shots", """SELECT id, line_no, round((before * 45) / 100.0::DOUBLE, 2) AS start_s, lower(ov) AS term, lower(category) AS pillar FROM
    (SELECT wl.*, CAST(sum(words) OVER (PARTITION BY wl.id ORDER BY line_no) AS BIGINT) - words AS before,
       upper(replace(array_to_string(list_filter(regexp_split_to_array(coalesce(list_filter(sc.lines, lambda x, i: i % 2 = 1)[least(line_no, len(list_filter(sc.lines, lambda x, i: i % 2 = 1)))], ''), '\\s+'), lambda x: x <> '')[1:2], ' '), 'ß', 'SS')) AS ov
     FROM wl JOIN sc ON sc.id = wl.id)""")
def _(t: Tables) -> DataFrame:
    rows = t.scripts.withColumn("visuals", F.filter("lines", lambda x, i: i % 2 == 0))
    return packages.shot_list(rows).select(
        "id", "line_no", "start_s", F.col("search_terms")[0].alias("term"), F.col("search_terms")[1].alias("pillar")
    )


@op("production_manifest", """SELECT id, CASE WHEN score > 9.2 THEN 'High' ELSE 'Medium' END AS priority, n AS order_no, CAST((n - 1) // 10 + 1 AS BIGINT) AS batch FROM
    (SELECT id, 7 + (id * 7 % 30) / 10.0::DOUBLE AS score, row_number() OVER (ORDER BY id) AS n FROM sc)""")
def _(t: Tables) -> DataFrame:
    rows = _scored(t).withColumn("priority", packages.X.priority("score"))
    return packages.manifest(rows, [F.asc("id")]).select("id", "priority", "order_no", "batch")


@op("production_manifest_text", """SELECT n AS order_no, '| ' || id || ' | ' || hook_text || ' | ' || category || ' | ' || estimated_performance || ' | ' ||
    CASE WHEN estimated_performance > 9.2 THEN 'High' ELSE 'Medium' END || ' | ' || n || ' |' AS line
    FROM (SELECT *, row_number() OVER (ORDER BY estimated_performance DESC, id) AS n FROM ho)""")
def _(t: Tables) -> DataFrame:
    rows = t.hooks.withColumn("score", F.col("estimated_performance")).withColumn("priority", packages.X.priority(F.col("score").cast("double")))
    return packages.manifest_lines(packages.manifest(rows, [F.desc_nulls_last("score"), F.asc("id")]))


@op("script_drafts", r"""SELECT id, i AS position, 'script-' || lpad(CAST(i + 41 AS VARCHAR), 3, '0') AS script_id, ['1','2','3','9'][i % 4 + 1] AS template_no,
    hook_text || chr(10) || 'Audit ' || trim(list_filter(regexp_split_to_array(hook_text, '\s+'), lambda x: x <> '')[-1], '.') || ' with Acme.' AS body_text
    FROM (SELECT id, hook_text, row_number() OVER (ORDER BY estimated_performance DESC, id) - 1 AS i FROM ho
      WHERE hook_text NOT IN (SELECT hook_text FROM ho JOIN vi ON vi.hook_id = ho.id AND vi.status = 'draft') ORDER BY estimated_performance DESC, id LIMIT 20)""")
def _(t: Tables) -> DataFrame:
    used = t.hooks.join(t.videos.where("status = 'draft'").select(F.col("hook_id").alias("id")), "id", "left_semi")
    order = [F.desc_nulls_last("estimated_performance"), F.asc("id")]
    picked = C.assign_templates(C.next_hooks(t.hooks, used, 20), order)
    return drafts.fill_script(picked, "Audit {topic} with {brand}.", "Acme").select(
        "id", "position", "script_id", "template_no", "body_text"
    )


@op("daily_close", "SELECT * FROM dm WHERE metric_date IN (DATE '2024-01-29', DATE '2024-01-30')")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "daily-mart")
    src = sources(t)
    for day in ("2024-01-29", LAST_DAY, LAST_DAY):  # the repeat must change nothing
        out = daily.daily_close(src, day, path)
    return out


@op("daily_mart_backfill", "SELECT * FROM dm")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "daily-mart")
    rows = mart(t)
    overwrite_partitions(rows, path, "metric_date")
    return t.spark.read.schema(rows.schema).parquet(path)


@op("late_day_rebuild", "SELECT * FROM dm")
def _(t: Tables) -> DataFrame:
    # The mart misses its last two days until their events turn up late.
    path = scratch_path(t.spark, "daily-mart")
    src = sources(t)
    overwrite_partitions(daily.daily_metrics(src, "2024-01-01", "2024-01-28"), path, "metric_date")
    late = t.events.where(F.col("ts") >= as_ts("2024-01-29 00:00:00"))
    return daily.reprocess_late(src, late, "ts", path)


@op("mart_by_changes", "SELECT metric_date, profile_visits, tripwire_sales, tripwire_revenue_cents, total_revenue_cents, new_subscribers, videos_published, total_content_views, new_followers, workflow_total FROM dm")
def _(t: Tables) -> DataFrame:
    # First every purchase counts as completed and the even events of the automation are missing; then both are put right.
    path = scratch_path(t.spark, "mart")
    src = sources(t)
    wrong = t.purchases.where("status <> 'completed'")
    delta_mart.apply(delta_mart.changes(daily.Sources(
        funnel=src.funnel, purchases=t.purchases.withColumn("status", F.lit("completed")), products=src.products, subscribers=src.subscribers,
        videos=src.videos, content=src.content, logs=src.logs.where("id % 2 = 1"))), path, 0)
    as_booked = daily.Sources(purchases=wrong.withColumn("status", F.lit("completed")), products=src.products)
    as_they_are = daily.Sources(purchases=wrong, products=src.products, logs=src.logs.where("id % 2 = 0"))
    for _ in range(2):  # the repeat must change nothing
        delta_mart.apply(delta_mart.changes(as_they_are, as_booked), path, 1)
    return delta_mart.read(t.spark, path).select(
        "metric_date", "profile_visits", "tripwire_sales", "tripwire_revenue_cents", "total_revenue_cents", "new_subscribers", "videos_published",
        "total_content_views", "new_followers", "workflow_total")


@op("weekly_report", f"""WITH w AS (SELECT * FROM ce WHERE event_date BETWEEN CAST({EA} - INTERVAL 7 DAY AS DATE) AND CAST({EA} AS DATE)),
    p AS (SELECT platform, sum(views) AS a, sum(shares) AS b, sum(saves) AS c, sum(follower_gain) AS d FROM w GROUP BY 1),
    hk AS (SELECT vi.hook_id, CAST(sum(w.views) AS BIGINT) AS v, CAST(sum(w.likes + w.shares) AS BIGINT) AS e FROM w JOIN vi ON vi.id = w.video_id GROUP BY 1 ORDER BY v DESC, vi.hook_id LIMIT 3),
    f AS (SELECT * FROM fe WHERE created_at >= {EA} - INTERVAL 7 DAY AND created_at <= {EA}),
    c AS (SELECT count(*) FILTER (stage = 'content_view') AS s1, count(*) FILTER (stage = 'profile_visit') AS s2, count(*) FILTER (stage = 'landing_page_view') AS s3,
      count(*) FILTER (stage = 'lead_magnet_download') AS s4, count(*) FILTER (stage = 'tripwire_view') AS s5,
      count(*) FILTER (stage IN ('tripwire_purchase','membership_purchased','automation_package_purchase')) AS s6 FROM f),
    r AS (SELECT 'content_views' AS stage, s1 AS v, NULL AS b FROM c UNION ALL SELECT 'profile_visits', s2, s1 FROM c UNION ALL SELECT 'lp_visits', s3, s2 FROM c
      UNION ALL SELECT 'email_optins', s4, s3 FROM c UNION ALL SELECT 'product_views', s5, s4 FROM c UNION ALL SELECT 'total_sales', s6, s3 FROM c),
    m AS (SELECT coalesce(sum(amount_cents) FILTER (product_type = 'tripwire'), 0) AS a, coalesce(sum(amount_cents) FILTER (product_type = 'membership'), 0) AS b,
      coalesce(sum(amount_cents) FILTER (product_type = 'automation_package'), 0) AS c, coalesce(sum(amount_cents), 0) AS d
      FROM pu JOIN dp ON dp.id = pu.product_id WHERE pu.status = 'completed' AND created_at >= {EA} - INTERVAL 7 DAY AND created_at <= {EA}),
    h AS (SELECT wf.name, coalesce(l.failures, 0) AS failures, round(l.successes * 100.0::DOUBLE / l.runs, 2) AS rate FROM wf LEFT JOIN
      (SELECT workflow_id, count(*) FILTER (status = 'failed') AS failures, count(*) FILTER (status = 'success') AS successes, count(*) AS runs FROM lg
       WHERE started_at >= {EA} - INTERVAL 7 DAY AND started_at <= {EA} GROUP BY 1) l ON l.workflow_id = wf.id)
    SELECT 'content' AS section, 'views' AS metric, platform AS dim, CAST(a AS DOUBLE) AS value FROM p UNION ALL SELECT 'content', 'shares', platform, b FROM p
    UNION ALL SELECT 'content', 'saves', platform, c FROM p UNION ALL SELECT 'content', 'followers', platform, d FROM p
    UNION ALL SELECT 'funnel', 'volume', stage, v FROM r UNION ALL SELECT 'funnel', 'conversion_pct', stage, round(v * 100.0::DOUBLE / nullif(b, 0), 2) FROM r
    UNION ALL SELECT 'revenue', 'tripwire_revenue_cents', 'all', a FROM m UNION ALL SELECT 'revenue', 'membership_revenue_cents', 'all', b FROM m
    UNION ALL SELECT 'revenue', 'automation_revenue_cents', 'all', c FROM m UNION ALL SELECT 'revenue', 'total_revenue_cents', 'all', d FROM m
    UNION ALL (SELECT 'revenue', 'mean_ltv_cents', 'all', round(sum(s) / count(*)::DOUBLE, 2) FROM (SELECT CAST(sum(amount_cents) AS BIGINT) AS s FROM pu
      WHERE status = 'completed' AND created_at >= {EA} - INTERVAL 7 DAY AND created_at <= {EA} GROUP BY profile_id))
    UNION ALL SELECT 'hooks', 'hook_views', CAST(hook_id AS VARCHAR), v FROM hk UNION ALL SELECT 'hooks', 'eng_rate_ls', CAST(hook_id AS VARCHAR), round(e / nullif(v, 0)::DOUBLE, 4) FROM hk
    UNION ALL (SELECT 'summary', 'top_channel_views', platform, a FROM p ORDER BY a DESC, platform LIMIT 1)
    UNION ALL SELECT 'operations', 'success_rate', name, rate FROM h UNION ALL SELECT 'operations', 'failures', name, failures FROM h""")
def _(t: Tables) -> DataFrame:
    return weekly.weekly_report(sources(t), t.workflows, as_ts(AS_OF_EVENTS))
