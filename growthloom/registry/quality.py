"""Queries for data-quality operators."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import affiliates as AF
from growthloom.operators import quality as Q
from growthloom.registry.core import op
from growthloom.sources import tables
from growthloom.sources.fixtures import Tables


@op("check_enum", """SELECT event_id, 'event_type_domain' AS rule FROM events WHERE event_type NOT IN ('view','click','signup','purchase')
    UNION ALL SELECT event_id, 'band_domain' FROM ev WHERE k // 10 NOT IN (0,1,2,3,4,5,6,7,8)""")
def _(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", F.floor(F.col("k") / 10).cast("string").alias("band"))
    rules = {"event_type": ["view", "click", "signup", "purchase"], "band": [str(i) for i in range(9)]}
    return Q.violations_enum(rows, rules).select("event_id", "rule")


@op("check_range", "SELECT id, acct_cents FROM pr WHERE acct_cents < 0 OR acct_cents > 900000")
def _(t: Tables) -> DataFrame:
    return Q.violations_range(t.profiles, "acct_cents", 0, 900_000).select("id", "acct_cents")


@op("check_unique", """SELECT purchase_id, line_no, count(*) AS copies FROM it GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t: Tables) -> DataFrame:
    return Q.violations_unique(t.purchase_items, ["purchase_id", "line_no"])


@op("check_not_null", """SELECT 'profile_id' AS column_name, count(*) FILTER (profile_id IS NULL) AS missing FROM fe
    UNION ALL SELECT 'anonymous_id', count(*) FILTER (anonymous_id IS NULL) FROM fe
    UNION ALL SELECT 'stage', count(*) FILTER (stage IS NULL) FROM fe""")
def _(t: Tables) -> DataFrame:
    return Q.violations_null(t.funnel_events, ["profile_id", "anonymous_id", "stage"])


@op("check_fk", """SELECT l_orderkey AS purchase_id, CAST(l_linenumber AS BIGINT) AS line_no FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def _(t: Tables) -> DataFrame:
    kept = t.raw("orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
    gone = Q.violations_fk(t.purchase_items, kept, "purchase_id", "id")
    return gone.select("purchase_id", F.col("line_no").cast("long").alias("line_no"))


@op("cascade_delete", """SELECT 'cascade' AS rule, p.id, p.referred_by AS link FROM pr p
      WHERE p.referred_by IS NULL OR p.referred_by NOT IN (SELECT id FROM pr WHERE acct_cents < 0)
    UNION ALL SELECT 'set_null', p.id, CASE WHEN p.referred_by IN (SELECT id FROM pr WHERE acct_cents < 0) THEN NULL ELSE p.referred_by END
      FROM pr p
    UNION ALL SELECT 'restrict', g.id, count(*) FROM pr g JOIN ph o ON o.profile_id = g.id WHERE g.acct_cents < 0 GROUP BY g.id""")
def _(t: Tables) -> DataFrame:
    gone = t.profiles.where("acct_cents < 0").select("id")
    kids = t.profiles.select("id", "referred_by")
    shape = [F.col("id"), F.col("referred_by").alias("link")]
    cascade = Q.delete_cascade(kids, gone, "referred_by").select(F.lit("cascade").alias("rule"), *shape)
    nulled = Q.delete_set_null(kids, gone, "referred_by").select(F.lit("set_null").alias("rule"), *shape)
    held = Q.delete_restricted(gone, t.purchases_hist, "profile_id").select(
        F.lit("restrict").alias("rule"), "id", F.col("holders").alias("link")
    )
    return cascade.unionAll(nulled).unionAll(held)


@op("backfill_column", """SELECT id, coalesce(CASE WHEN status = 'completed' THEN fee_cents END, 0) AS cost_cents, 'usd' AS currency FROM ph""")
def _(t: Tables) -> DataFrame:
    gaps = t.purchases_hist.withColumn("cost_cents", F.when(F.col("status") == "completed", F.col("fee_cents")))
    df = tables.add_column(tables.add_column(gaps, "cost_cents", "long", 0), "currency", "string", "usd")
    return df.select("id", "cost_cents", "currency")


@op("apply_defaults", """SELECT id, 'usd' AS currency, CASE WHEN status = 'pending' THEN 0 ELSE fee_cents END AS fee_cents, 'stripe' AS processor,
    CASE WHEN status = 'completed' THEN 'pending' ELSE status END AS status FROM ph""")
def _(t: Tables) -> DataFrame:
    gaps = t.purchases_hist.select(
        "id", F.lit(None).cast("string").alias("currency"),
        F.when(F.col("status") != "pending", F.col("fee_cents")).alias("fee_cents"),
        F.lit(None).cast("string").alias("processor"),
        F.when(F.col("status") != "completed", F.col("status")).alias("status"),
    )
    return tables.with_defaults(gaps, "purchases")


@op("hook_import_qa", """SELECT text AS hook_text, min(doc_id) AS id,
      arg_min(least(10.0::DOUBLE, greatest(0.0::DOUBLE, (n_chars % 2000) / 100.0::DOUBLE - 5)), doc_id) AS estimated_performance
    FROM documents WHERE lang IN ('en', 'fr', 'de') AND text NOT IN (SELECT text FROM benchmark) GROUP BY text""")
def _(t: Tables) -> DataFrame:
    # The language plays the category; Spanish is the unknown one.
    score = (F.col("n_chars") % 2000) / F.lit(100.0) - 5
    new = t.raw("documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("hook_text"), F.col("lang").alias("category"),
        score.alias("estimated_performance"),
    )
    return Q.import_hooks(new, t.hooks, ["en", "fr", "de"]).select("hook_text", "id", "estimated_performance")


@op("quarantine_split", """SELECT id, stage, list_filter([CASE WHEN profile_id IS NULL THEN 'has_profile' END,
      CASE WHEN stage IN ('referral_click', 'affiliate_signup') THEN 'own_stage' END,
      CASE WHEN revenue_cents > 20000 THEN 'small_revenue' END], lambda x: x IS NOT NULL) AS failed_rules
    FROM fe WHERE profile_id IS NULL OR stage IN ('referral_click', 'affiliate_signup') OR revenue_cents > 20000""")
def _(t: Tables) -> DataFrame:
    rules = {
        "has_profile": F.col("profile_id").isNotNull(),
        "own_stage": ~F.col("stage").isin("referral_click", "affiliate_signup"),
        "small_revenue": F.col("revenue_cents") <= 20_000,
    }
    return Q.split_rules(t.funnel_events, rules)[1].select("id", "stage", "failed_rules")


def _shop(t: Tables) -> dict[str, DataFrame]:
    """Linked tables under their declared names and columns."""
    return {
        "profiles": t.profiles.select("id", "referred_by"),
        "purchases": t.purchases.select("id", "product_id", "profile_id", "affiliate_id"),
        "digital_products": t.products.select("id", "product_type"),
        "affiliates": t.affiliates.select("id", "profile_id"),
        "affiliate_commissions": AF.affiliate_run(t.purchases, t.affiliates, t.products).select(
            F.col("purchase_id").alias("id"), "affiliate_id", F.col("purchase_id").alias("source_purchase_id")
        ),
        "analytics_funnel_events": t.funnel_events.select("id", "profile_id"),
    }


@op("declared_links", """SELECT * FROM (SELECT 'profiles' AS child, 'referred_by' AS link, count(*) AS orphans FROM pr WHERE referred_by NOT IN (SELECT id FROM pr)
    UNION ALL SELECT 'purchases', 'product_id', count(*) FROM pu WHERE product_id NOT IN (SELECT id FROM dp WHERE is_active)
    UNION ALL SELECT 'purchases', 'profile_id', count(*) FROM pu WHERE profile_id NOT IN (SELECT id FROM pr)
    UNION ALL SELECT 'purchases', 'affiliate_id', count(*) FROM pu WHERE affiliate_id NOT IN (SELECT id FROM af)
    UNION ALL SELECT 'affiliates', 'profile_id', count(*) FROM af WHERE profile_id NOT IN (SELECT id FROM pr)
    UNION ALL SELECT 'affiliate_commissions', 'affiliate_id', 0 UNION ALL SELECT 'affiliate_commissions', 'source_purchase_id', 0
    UNION ALL SELECT 'analytics_funnel_events', 'profile_id', count(*) FROM fe WHERE profile_id NOT IN (SELECT id FROM pr))""")
def _(t: Tables) -> DataFrame:
    shop = _shop(t)
    shop["digital_products"] = t.products.where("is_active").select("id")
    return Q.check_links(shop)


@op("declared_rules", """SELECT id, list_filter([CASE WHEN customer_email IS NULL THEN 'customer_email_required' END,
      CASE WHEN processor NOT IN ('stripe','gumroad','paypal') THEN 'processor_domain' END, CASE WHEN status = 'gone' THEN 'status_domain' END], lambda x: x IS NOT NULL) AS failed_rules
    FROM (SELECT id, CASE WHEN profile_id % 2 = 0 THEN 'mail' END AS customer_email, CASE WHEN utm_medium = 'urgent' THEN 'cash' ELSE 'stripe' END AS processor,
      CASE WHEN status = 'pending' THEN 'gone' ELSE status END AS status FROM ph)""")
def _(t: Tables) -> DataFrame:
    rows = t.purchases_hist.select(
        "id", "amount_cents", F.when(F.col("profile_id") % 2 == 0, "mail").alias("customer_email"),
        F.when(F.col("utm_medium") == "urgent", "cash").otherwise("stripe").alias("processor"),
        F.when(F.col("status") == "pending", "gone").otherwise(F.col("status")).alias("status"),
    )
    return Q.apply_rules(rows, Q.table_rules("purchases", rows.columns)).select("id", "failed_rules")


@op("delete_with_rules", """WITH g AS (SELECT id FROM pr WHERE acct_cents < 0), ga AS (SELECT id FROM af WHERE profile_id IN (SELECT id FROM g)),
    k AS (SELECT pu.id, pu.affiliate_id FROM pu JOIN af ON af.id = pu.affiliate_id JOIN dp ON dp.id = pu.product_id WHERE af.is_active)
    SELECT 'profiles' AS tbl, id, CASE WHEN referred_by IN (SELECT id FROM g) THEN NULL ELSE referred_by END AS link FROM pr WHERE id NOT IN (SELECT id FROM g)
    UNION ALL SELECT 'purchases', id, CASE WHEN profile_id IN (SELECT id FROM g) THEN NULL ELSE profile_id END FROM pu
    UNION ALL SELECT 'purchases_affiliate', id, CASE WHEN affiliate_id IN (SELECT id FROM ga) THEN NULL ELSE affiliate_id END FROM pu
    UNION ALL SELECT 'affiliates', id, profile_id FROM af WHERE id NOT IN (SELECT id FROM ga)
    UNION ALL SELECT 'affiliate_commissions', id, affiliate_id FROM k WHERE affiliate_id NOT IN (SELECT id FROM ga)""")
def _(t: Tables) -> DataFrame:
    gone = t.profiles.where("acct_cents < 0").select("id")
    after, _ = Q.delete_with_rules(_shop(t), "profiles", gone)

    def rows(table: str, link: str, name: str | None = None) -> DataFrame:
        return after[table].select(F.lit(name or table).alias("tbl"), "id", F.col(link).alias("link"))

    return (
        rows("profiles", "referred_by").unionAll(rows("purchases", "profile_id"))
        .unionAll(rows("purchases", "affiliate_id", "purchases_affiliate")).unionAll(rows("affiliates", "profile_id"))
        .unionAll(rows("affiliate_commissions", "affiliate_id"))
    )


@op("delete_restricted", """SELECT g.id, count(*) AS holders FROM (SELECT id FROM dp WHERE NOT is_active) g JOIN
    (SELECT product_id FROM pu) p ON p.product_id = g.id GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    gone = t.products.where("not is_active").select("id")
    return Q.delete_with_rules(_shop(t), "digital_products", gone)[1]


@op("table_report", """SELECT 'content_events' AS tbl, 'video_id_required' AS rule, 0 AS failures UNION ALL SELECT 'content_events', 'platform_required', 0
    UNION ALL SELECT 'content_events', 'event_date_required', 0 UNION ALL SELECT 'content_events', 'platform_domain', count(*) FILTER (platform = 'youtube') FROM ce
    UNION ALL SELECT 'content_events', 'video_id_platform_event_date_unique', 0
    UNION ALL SELECT 'hooks', 'hook_text_required', 0 UNION ALL SELECT 'hooks', 'category_required', 0
    UNION ALL SELECT 'hooks', 'trigger_type_required', count(*) FILTER (source IS NULL) FROM documents UNION ALL SELECT 'hooks', 'estimated_performance_required', 0
    UNION ALL SELECT 'hooks', 'estimated_performance_range', count(*) FILTER (n_chars / 100.0 > 10) FROM documents
    UNION ALL SELECT 'hooks', 'hook_text_unique', count(*) - count(DISTINCT text) FROM documents""")
def _(t: Tables) -> DataFrame:
    # Texts play the hooks: copies break the unique key, long ones the score range.
    hooks = t.raw("documents").select(
        F.col("text").alias("hook_text"), F.col("lang").alias("category"), F.col("source").alias("trigger_type"),
        (F.col("n_chars") / 100).alias("estimated_performance"),
    )
    renamed = F.when(F.col("platform") == "youtube", "shorts").otherwise(F.col("platform"))
    content = t.content_events.withColumn("platform", renamed)
    a = Q.table_report(content, "analytics_content_events").select(F.lit("content_events").alias("tbl"), "rule", "failures")
    return a.unionAll(Q.table_report(hooks, "viral_hooks").select(F.lit("hooks").alias("tbl"), "rule", "failures"))
