"""Queries for upserts and other mutations."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import upsert as U
from growthloom.plans import drafts, purchases as P
from growthloom.registry.core import op
from growthloom.registry.duck import EVENTS_AS_OF as EA, ORDERS_AS_OF as OA
from growthloom.sources.fixtures import AS_OF_EVENTS, AS_OF_ORDERS, Tables, as_ts


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders before and since 1999 as (customer, price, status, at, order)."""
    rows = t.orders.select(
        F.col("o_custkey").alias("cust"), F.col("price_cents").alias("price"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("oid"),
    )
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return rows.where(F.col("at") < cut), rows.where(F.col("at") >= cut)


_OLD = """(SELECT o_custkey AS cust, price_cents AS price, o_orderstatus AS status, o_orderdate AS at, o_orderkey AS oid FROM orr WHERE o_orderdate < TIMESTAMP '1999-01-01'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
_NEW = """(SELECT o_custkey AS cust, price_cents AS price, o_orderstatus AS status, o_orderdate AS at, o_orderkey AS oid FROM orr WHERE o_orderdate >= TIMESTAMP '1999-01-01'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate {d}, o_orderkey {d}) = 1)"""


@op("insert_ignore", f"""SELECT * FROM {_OLD} UNION ALL SELECT * FROM {_NEW.format(d='ASC')} WHERE cust NOT IN (SELECT cust FROM {_OLD})""")
def _(t: Tables) -> DataFrame:
    old, new = _halves(t)
    target = U.latest_by(old, ["cust"], ["at", "oid"])
    return U.insert_ignore(target, new, ["cust"], ["at", "oid"])


@op("upsert", f"""SELECT coalesce(o.cust, n.cust) AS cust, CASE WHEN o.cust IS NULL THEN n.price ELSE o.price END AS price,
    coalesce(n.status, o.status) AS status, coalesce(n.at, o.at) AS at, CASE WHEN o.cust IS NULL THEN n.oid ELSE o.oid END AS oid
    FROM {_OLD} o FULL JOIN {_NEW.format(d='DESC')} n ON n.cust = o.cust""")
def _(t: Tables) -> DataFrame:
    old, new = _halves(t)
    target = U.latest_by(old, ["cust"], ["at", "oid"])
    return U.upsert(target, new, ["cust"], ["status", "at"], ["at", "oid"])


@op("find_or_create_person", """SELECT email, m.stripe_customer_id, coalesce(CAST(s.id AS VARCHAR), sha256(email)) AS subscriber_id,
    coalesce(CAST(p.id AS VARCHAR), sha256(email)) AS profile_id, s.id IS NULL AS new_subscriber, p.id IS NULL AS new_profile
    FROM (SELECT DISTINCT 'customer.' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.com' AS email, 'cus_' || user_id AS stripe_customer_id FROM ev
          WHERE event_type IN ('purchase','signup')) m
    LEFT JOIN (SELECT * FROM su WHERE status = 'active') s USING (email) LEFT JOIN (SELECT * FROM pr WHERE acct_cents < 500000) p USING (email)""")
def _(t: Tables) -> DataFrame:
    rows = P.checkouts(t.checkout_messages).where("not skip")
    return P.resolve_person(rows, t.subscribers.where("status = 'active'"), t.profiles.where("acct_cents < 500000"))


@op("apply_tag", "SELECT subscriber_id, tag FROM st UNION SELECT id, 'vip' FROM su WHERE ltv_cents >= 50000")
def _(t: Tables) -> DataFrame:
    vips = t.subscribers.where("ltv_cents >= 50000").select(F.col("id").alias("subscriber_id"))
    return U.tag(t.subscriber_tags, vips, "vip")


@op("swap_tag", """SELECT subscriber_id, tag FROM st WHERE NOT (tag = 'signup-3' AND subscriber_id IN (SELECT id FROM su WHERE has_purchased AND ltv_cents >= 10000))
    UNION SELECT id, 'buyer' FROM su WHERE has_purchased AND ltv_cents >= 10000""")
def _(t: Tables) -> DataFrame:
    buyers = t.subscribers.where("has_purchased and ltv_cents >= 10000").select(F.col("id").alias("subscriber_id"))
    return U.swap_tag(t.subscriber_tags, buyers, "signup-3", "buyer")


@op("increment_counters", """WITH every AS (SELECT id, times_used FROM ho UNION ALL SELECT id + 1000000, times_used FROM ho)
    SELECT every.id, every.times_used + coalesce(v.n, 0) AS times_used,
    CASE WHEN v.n IS NOT NULL THEN {ea} WHEN every.id % 3 > 0 THEN TIMESTAMP '2023-06-01' END AS last_used_at
    FROM every LEFT JOIN (SELECT hook_id, count(*) AS n FROM vi GROUP BY 1) v ON v.hook_id = every.id""".format(ea=EA))
def _(t: Tables) -> DataFrame:
    # Two hooks in three were used before; every hook has a twin that no video refers to.
    every = t.hooks.unionByName(t.hooks.withColumn("id", F.col("id") + 1_000_000))
    before = every.withColumn("last_used_at", F.when(F.col("id") % 3 > 0, as_ts("2023-06-01 00:00:00")))
    return drafts.count_usage(before, t.videos.select("hook_id"), as_ts(AS_OF_EVENTS)).select("id", "times_used", "last_used_at")


@op("apply_deltas", """SELECT pr.id, pr.acct_cents + coalesce(o.s, 0) AS acct_cents FROM pr LEFT JOIN
    (SELECT profile_id, CAST(sum(amount_cents) AS BIGINT) AS s FROM ph WHERE status = 'completed' GROUP BY 1) o ON o.profile_id = pr.id""")
def _(t: Tables) -> DataFrame:
    paid = t.purchases_hist.where("status = 'completed'").select(F.col("profile_id").alias("id"), "amount_cents")
    return U.apply_deltas(t.profiles.select("id", "acct_cents"), paid, "id", {"acct_cents": "amount_cents"})


@op("delete_in", "SELECT subscriber_id, tag FROM st WHERE subscriber_id NOT IN (SELECT id FROM su WHERE status = 'unsubscribed')")
def _(t: Tables) -> DataFrame:
    gone = t.subscribers.where("status = 'unsubscribed'").select(F.col("id").alias("subscriber_id"))
    return U.delete_where(t.subscriber_tags, gone)


@op("grant_access", f"""SELECT it.purchase_id, it.line_no, it.product_id, it.quantity, it.line_no = 1 OR ph.status = 'completed' AS access_granted,
    CASE WHEN it.line_no = 1 THEN TIMESTAMP '1998-01-01' WHEN ph.status = 'completed' THEN {OA} END AS access_granted_at,
    CASE WHEN it.line_no = 1 THEN 'sent/' || it.purchase_id WHEN ph.status = 'completed' THEN dp.first_file END AS download_url
    FROM it JOIN ph ON ph.id = it.purchase_id LEFT JOIN dp ON dp.id = it.product_id""")
def _(t: Tables) -> DataFrame:
    # First lines were granted earlier, whatever became of their purchase.
    first = F.col("line_no") == 1
    items = t.purchase_items.select(
        "purchase_id", "line_no", "product_id", "quantity", first.alias("access_granted"),
        F.when(first, as_ts("1998-01-01 00:00:00")).alias("access_granted_at"),
        F.when(first, F.concat(F.lit("sent/"), "purchase_id")).alias("download_url"),
    )
    paid = t.purchases_hist.where("status = 'completed'").select(F.col("id").alias("purchase_id"))
    return U.grant_access(items, t.products, paid, as_ts(AS_OF_ORDERS))


@op("refresh_last_run", """WITH every AS (SELECT id, name FROM wf UNION ALL SELECT id + 100, name FROM wf)
    SELECT every.id, every.name, coalesce(l.last_run_at, TIMESTAMP '2023-06-01') AS last_run_at,
    coalesce(l.last_run_status, 'success') AS last_run_status FROM every LEFT JOIN
    (SELECT workflow_id, started_at AS last_run_at, status AS last_run_status FROM lg
     QUALIFY row_number() OVER (PARTITION BY workflow_id ORDER BY started_at DESC, id DESC) = 1) l ON l.workflow_id = every.id""")
def _(t: Tables) -> DataFrame:
    # All workflows have run before; every one has a twin that is idle now.
    every = t.workflows.unionByName(t.workflows.withColumn("id", F.col("id") + 100))
    before = every.select("id", "name", as_ts("2023-06-01 00:00:00").alias("last_run_at"), F.lit("success").alias("last_run_status"))
    return U.refresh_last_run(before, t.execution_logs)
