"""The domain tables, derived from the driver's parquet tables.

Every frame is lazy and works on the whole of its source table.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from growthloom.functions import exprs as X
from growthloom.plans import keyed
from growthloom.session import configure

AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-08-02 00:00:00"
LAST_DAY = "2024-01-30"
FIRST_DAY = "2024-01-01"

HOOK_CATEGORIES = ["Mindset", "Productivity", "Discipline", "Money", "Relationships", "Health"]
TRIGGERS = ["Insight", "Urgency", "Authority", "Curiosity"]


def as_ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def pick(col: Column, values: list[str]) -> Column:
    """values[col]."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (col + 1).cast("int"))


def utm_columns(k: Column) -> list[Column]:
    return [
        pick(k % 4, ["tiktok", "instagram", "youtube", "email"]).alias("utm_source"),
        pick(k % 3, ["short_video", "bio_link", "newsletter"]).alias("utm_medium"),
        F.concat(F.lit("batch-"), (k % 5).cast("string")).alias("utm_campaign"),
    ]


# Schemas of the given tables, so that a scan never has to read footers first.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,
        o_orderpriority string""",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
}


class Tables:
    """Domain views over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.dir}/{name}.parquet")

    # events ------------------------------------------------------------------
    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    @cached_property
    def funnel_events(self) -> DataFrame:
        return funnel_view(self.events)

    @cached_property
    def purchases(self) -> DataFrame:
        suppliers = self.raw("supplier").agg(F.count(F.lit(1))).scalar()
        return (
            self.events.where(F.col("event_type") == "purchase")
            .withColumn("amount_cents", X.cents("value"))
            .select(
                F.col("event_id").alias("id"),
                F.col("k").cast("long").alias("product_id"),
                F.col("user_id").alias("profile_id"),
                "amount_cents",
                F.floor(F.col("amount_cents") / 20).alias("fee_cents"),
                F.when(F.col("event_id") % 10 == 0, "refunded")
                .when(F.col("event_id") % 10 == 1, "pending")
                .otherwise("completed")
                .alias("status"),
                F.when(F.col("event_id") % 3 == 0, F.col("event_id") % suppliers).alias("affiliate_id"),
                F.col("k").alias("source_video_id"),
                *utm_columns(F.col("k")),
                F.col("ts").alias("created_at"),
            )
        )

    @cached_property
    def content_events(self) -> DataFrame:
        kind = F.col("event_type")

        def n(k: str) -> Column:
            return F.count_if(kind == k)

        view = kind == "view"
        return (
            self.events.groupBy(
                F.col("k").alias("video_id"),
                pick(F.col("user_id") % 3, ["tiktok", "instagram", "youtube"]).alias("platform"),
                F.to_date("ts").alias("event_date"),
            )
            .agg(
                n("view").alias("views"),
                n("click").alias("likes"),
                n("signup").alias("saves"),
                n("purchase").alias("shares"),
                n("error").alias("comments"),
                F.coalesce(F.sum(F.when(view, X.cents("value"))), F.lit(0)).alias("watch_cs"),
                F.count_if((kind == "signup") & (F.col("value") >= 60)).alias("follower_gain"),
                F.count_if(view & (F.col("event_id") % 4 == 0)).alias("from_fyp"),
                F.count_if(view & (F.col("event_id") % 4 == 1)).alias("from_profile"),
                F.count_if(view & (F.col("event_id") % 4 == 2)).alias("from_search"),
                F.count_if(view & (F.col("event_id") % 4 == 3)).alias("from_hashtags"),
            )
        )

    @cached_property
    def videos(self) -> DataFrame:
        """One row per video id with lifetime totals."""
        kind = F.col("event_type")
        k = F.col("id")
        return (
            self.events.groupBy(F.col("k").alias("id"))
            .agg(
                F.min("ts").alias("published_at"),
                F.count_if(kind == "view").alias("total_views"),
                F.count_if(kind == "click").alias("total_likes"),
                F.count_if(kind == "signup").alias("total_saves"),
                F.count_if(kind == "purchase").alias("total_shares"),
                F.count_if(kind == "error").alias("total_comments"),
            )
            .withColumns(
                {
                    "hook_id": (k % 40).cast("long"),
                    "status": F.when(k % 5 == 0, "draft").when(k % 5 == 1, "scheduled").otherwise("published"),
                    "platforms": F.when(k % 3 == 0, F.array(F.lit("tiktok")))
                    .when(k % 3 == 1, F.array(F.lit("tiktok"), F.lit("instagram")))
                    .otherwise(F.array(F.lit("youtube"))),
                    "category": pick(k % 6, HOOK_CATEGORIES),
                }
            )
        )

    @cached_property
    def subscribers(self) -> DataFrame:
        kind = F.col("event_type")

        def last(k: str) -> Column:
            return F.max(F.when(kind == k, F.col("ts")))

        seen = self.events.groupBy(F.col("user_id").alias("id")).agg(
            F.min(F.when(kind == "signup", F.col("ts"))).alias("created_at"),
            last("view").alias("last_opened_at"),
            last("click").alias("last_clicked_at"),
            F.count_if(kind == "view").alias("total_opens"),
            F.count_if(kind == "click").alias("total_clicks"),
            F.coalesce(F.sum(F.when(kind == "purchase", X.cents("value"))), F.lit(0)).alias("ltv_cents"),
            (F.count_if(kind == "purchase") > 0).alias("has_purchased"),
        )
        people = self.profiles.select(
            "id", "email", "full_name", F.col("id").alias("profile_id"),
            F.when(F.col("acct_cents") < 0, "unsubscribed").otherwise("active").alias("status"),
            pick(F.col("nation") % 6, ["lead_magnet", "purchase", "tripwire", "landing_page", "manual", "referral"])
            .alias("source"),
        )
        return people.join(seen.hint("merge"), "id")

    @cached_property
    def subscriber_tags(self) -> DataFrame:
        """(subscriber, tag) pairs; the tag is the event type and a band of k."""
        return self.events.select(
            F.col("user_id").alias("subscriber_id"),
            F.concat_ws("-", "event_type", F.floor(F.col("k") / 5).cast("string")).alias("tag"),
        ).distinct()

    @cached_property
    def campaign_logs(self) -> DataFrame:
        kind = F.col("event_type")
        return self.events.where(kind.isin("view", "click", "signup")).select(
            F.col("event_id").alias("id"),
            (F.col("k") % 5).cast("long").alias("campaign_id"),
            F.col("user_id").alias("subscriber_id"),
            F.when(kind == "signup", F.col("ts")).alias("delivered_at"),
            F.when(kind == "view", F.col("ts")).alias("opened_at"),
            F.when(kind == "click", F.col("ts")).alias("clicked_at"),
            F.when(F.col("k") >= 98, F.col("ts")).alias("unsubscribed_at"),
            F.col("ts").alias("sent_at"),
            F.to_json(
                F.when(
                    kind == "click",
                    F.transform(
                        F.array(F.col("k") % 7, F.col("k") % 11),
                        lambda n: F.concat(F.lit("https://example.com/l/"), n.cast("string")),
                    ),
                ).otherwise(F.array().cast("array<string>"))
            ).alias("clicked_links"),
        )

    @cached_property
    def publishing_queue(self) -> DataFrame:
        kind = F.col("event_type")
        status = (
            F.when(kind == "view", "published")
            .when(kind == "click", "queued")
            .when(kind == "signup", "processing")
            .when(kind == "purchase", "skipped")
            .otherwise("failed")
        )
        return self.events.select(
            F.col("event_id").alias("id"),
            F.col("k").alias("video_id"),
            pick(F.col("user_id") % 3, ["tiktok", "instagram", "youtube"]).alias("platform"),
            F.col("ts").alias("scheduled_for"),
            status.alias("status"),
            (F.col("event_id") % 5).cast("int").alias("retry_count"),
            F.lit(3).alias("max_retries"),
        )

    @cached_property
    def workflows(self) -> DataFrame:
        return self.spark.range(9).select(
            F.col("id").alias("id"), F.concat(F.lit("workflow-"), F.col("id").cast("string")).alias("name")
        )

    @cached_property
    def execution_logs(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("id"),
            (F.col("user_id") % 8).alias("workflow_id"),
            F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
            F.col("ts").alias("started_at"),
            F.timestamp_micros(keyed.micros(F.col("ts")) + X.cents("value") * 10_000)
            .cast("timestamp_ntz")
            .alias("completed_at"),
            X.cents("value").alias("run_cs"),
        )

    # parts, customers, orders --------------------------------------------------
    @cached_property
    def products(self) -> DataFrame:
        kind = (
            F.when(F.col("p_type") == "ECONOMY", "lead_magnet")
            .when(F.col("p_type").isin("SMALL", "PROMO"), "tripwire")
            .when(F.col("p_type") == "MEDIUM", "membership")
            .when(F.col("p_type") == "LARGE", "automation_package")
            .otherwise("bundle")
        )
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            kind.alias("product_type"),
            X.cents("p_retailprice").alias("price_cents"),
            (X.cents("p_retailprice") + F.col("p_size") * 100).alias("compare_at_price_cents"),
            F.concat(F.lit("price_"), F.col("p_partkey")).alias("stripe_price_id"),
            F.to_json(
                F.array(F.struct(F.concat(F.lit("https://files.example.com/"), F.col("p_partkey")).alias("url")))
            ).alias("file_urls"),
            (F.col("p_size") * 1000).cast("long").alias("inventory_count"),
            (F.col("p_size") <= 45).alias("is_active"),
        )

    @cached_property
    def profiles(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("id"),
            F.concat(F.lit("auth-"), key).alias("auth_id"),
            F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lit("cus_"), key).alias("stripe_customer_id"),
            F.when(key > 0, F.floor(key / 4)).alias("referred_by"),
            X.cents("c_acctbal").alias("acct_cents"),
            F.col("c_nationkey").alias("nation"),
            F.col("c_mktsegment").alias("segment"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").withColumn("price_cents", X.cents("o_totalprice"))

    @cached_property
    def memberships(self) -> DataFrame:
        last = self.raw("orders").groupBy(F.col("o_custkey").alias("profile_id")).agg(
            F.max("o_orderdate").alias("current_period_start"), F.min("o_orderdate").alias("created_at")
        )
        key = F.col("profile_id")
        people = self.profiles.select(F.col("id").alias("profile_id"), "acct_cents", "segment")
        canceled = (F.col("acct_cents") >= 0) & (key % 7 == 0)
        return last.join(people, "profile_id").select(
            key.alias("id"),
            key,
            F.concat(F.lit("sub_"), key).alias("stripe_subscription_id"),
            F.when(key % 5 == 0, "year").otherwise("month").alias("plan"),
            F.when(key % 5 == 0, F.lit(19000)).otherwise(F.lit(1900)).cast("long").alias("price_cents"),
            F.when(F.col("acct_cents") < 0, "past_due").when(key % 7 == 0, "canceled").otherwise("active").alias("status"),
            "current_period_start",
            (F.col("current_period_start") + F.expr("interval 30 days")).alias("current_period_end"),
            F.when(
                canceled, as_ts(AS_OF_ORDERS) - F.make_dt_interval(hours=(key % 72).cast("int"))
            ).alias("ended_at"),
            (key % 13 == 0).alias("cancel_at_period_end"),
            F.when(canceled, F.lower("segment")).alias("cancellation_reason"),
            "created_at",
        )

    @cached_property
    def purchases_hist(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", "completed")
            .when(F.col("o_orderstatus") == "O", "pending")
            .otherwise("partially_refunded")
        )
        return self.orders.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("profile_id"),
            F.col("price_cents").alias("amount_cents"),
            F.floor(F.col("price_cents") / 20).alias("fee_cents"),
            status.alias("status"),
            F.lower(F.split_part("o_orderpriority", F.lit("-"), F.lit(2))).alias("utm_medium"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def purchase_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("purchase_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_quantity").cast("long").alias("quantity"),
            X.cents("l_extendedprice").alias("line_cents"),
            X.cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price_cents"),
            F.col("l_returnflag").alias("returnflag"),
        )

    @cached_property
    def affiliates(self) -> DataFrame:
        bal = F.col("s_acctbal")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_suppkey").alias("profile_id"),
            F.concat(F.lit("AFF"), F.col("s_suppkey")).alias("referral_code"),
            F.col("s_name").alias("full_name"),
            F.when(bal < 3000, "standard").when(bal < 7000, "premium").otherwise("elite").alias("tier"),
            F.lit(30.0).alias("commission_pct"),
            (bal >= 0).alias("is_active"),
            F.when(F.col("s_suppkey") % 4 == 0, 30).when(F.col("s_suppkey") % 4 == 1, 365).otherwise(60).alias("cookie_days"),
            (F.col("s_suppkey") * 100).alias("total_earned_cents"),
            (F.col("s_suppkey") * 40).alias("total_paid_cents"),
            (F.col("s_suppkey") * 60).alias("pending_cents"),
        )

    @cached_property
    def referrals(self) -> DataFrame:
        """Clicks (order date) and conversions (ship date) of a sale, by affiliate."""
        sales = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return (
            self.raw("lineitem")
            .join(sales, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_suppkey").alias("affiliate_id"),
                F.col("o_custkey").alias("profile_id"),
                F.col("l_orderkey").alias("purchase_id"),
                F.col("l_linenumber").alias("line_no"),
                F.col("o_orderdate").alias("clicked_at"),
                F.col("l_shipdate").alias("converted_at"),
                X.cents("l_extendedprice").alias("amount_cents"),
            )
        )

    @cached_property
    def commissions(self) -> DataFrame:
        """Commission rows: 30 % of each line, with its payout state."""
        state = (
            F.when(F.col("l_returnflag") == "R", "refunded")
            .when(F.col("l_linestatus") == "F", "paid")
            .when(F.col("l_returnflag") == "A", "approved")
            .otherwise("pending")
        )
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("affiliate_id"),
            F.col("l_orderkey").alias("purchase_id"),
            X.commission_cents(X.cents("l_extendedprice"), F.lit(30.0), F.lit("standard")).alias("amount_cents"),
            state.alias("status"),
            F.col("l_shipdate").alias("created_at"),
        )

    # texts -----------------------------------------------------------------------
    @cached_property
    def hooks(self) -> DataFrame:
        i = F.col("item_id")
        est = 70 + (i * 7) % 30
        return self.raw("benchmark").select(
            i.alias("id"),
            F.col("text").alias("hook_text"),
            pick(i % 6, HOOK_CATEGORIES).alias("category"),
            pick(i % 4, TRIGGERS).alias("trigger_type"),
            (est / F.lit(10)).cast("decimal(3,1)").alias("estimated_performance"),
            F.when(i % 5 != 0, ((est + (i * 3) % 11 - 5) / F.lit(10)).cast("decimal(3,1)")).alias("actual_performance"),
            (i % 7).alias("times_used"),
            (i % 8).alias("variant_group"),
        )

    @cached_property
    def scripts(self) -> DataFrame:
        key = F.col("doc_id")
        return self.raw("documents").select(
            key.alias("id"),
            F.col("text").alias("body_text"),
            F.split("text", "\n").alias("lines"),
            F.when(key > 0, F.floor(key / 3)).alias("previous_version_id"),
            pick(key % 6, HOOK_CATEGORIES).alias("category"),
            "lang",
            "source",
        )

    @cached_property
    def page_views(self) -> DataFrame:
        host = F.try_parse_url("url", F.lit("HOST"))
        agent = (
            F.when(F.startswith(host, F.lit("m.")), "Mozilla/5.0 (iPhone) Mobile")
            .when(F.startswith(host, F.lit("blog.")), "Mozilla/5.0 (iPad)")
            .otherwise("Mozilla/5.0 (X11; Linux x86_64)")
        )
        return self.raw("pages").select(
            F.col("page_id").alias("id"), "url", agent.alias("user_agent"),
            F.length("html").cast("long").alias("page_load_ms"),
            pick(F.col("page_id") % 5, ["US", "DE", "FR", "GB", "IN"]).alias("country"),
            F.when(F.col("page_id") % 9 > 0, F.col("page_id") * 37 % 300).alias("time_on_page_seconds"),
            (as_ts(FIRST_DAY + " 00:00:00") + F.make_dt_interval(days=(F.col("page_id") % 30).cast("int"))).alias("viewed_at"),
        )

    @cached_property
    def completions(self) -> DataFrame:
        return self.raw("conversations").where(F.col("role") == "assistant").select("conv_id", "turn", "text")

    # messages --------------------------------------------------------------------
    @cached_property
    def lead_messages(self) -> DataFrame:
        return lead_view(self.events)

    @cached_property
    def checkout_messages(self) -> DataFrame:
        return checkout_view(self.events)

    @cached_property
    def affiliate_messages(self) -> DataFrame:
        suppliers = self.raw("supplier").agg(F.count(F.lit(1))).scalar()
        return affiliate_view(self.events, suppliers)

    @cached_property
    def subscription_messages(self) -> DataFrame:
        return subscription_view(self.raw("orders"))


def lead_view(events: DataFrame) -> DataFrame:
    """One lead body per signup event; every tenth address is not valid. Works on a stream too."""
    u = F.col("user_id")
    mail = F.concat(F.lit(" Customer."), F.lpad(u.cast("string"), 9, "0"),
                    F.when(F.col("event_id") % 10 == 7, "(at)").otherwise("@"), F.lit("Example.com "))
    return events.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("received_at"),
        F.to_json(
            F.struct(
                mail.alias("email"),
                F.when(F.col("k") < 50, F.concat(F.lit("Lead 7 "), F.col("k"))).otherwise("").alias("name"),
                F.when(F.col("k") % 2 == 0, "referral").alias("source"),
                (F.col("k") % 3 == 0).alias("double_opt_in"),
                F.when(F.col("k") % 4 == 0, F.concat(F.lit("https://example.com/p/"), F.col("k"))).alias("source_url"),
                F.when(F.col("k") % 5 == 0, F.concat(F.lit("v"), F.col("k"))).when(F.col("k") % 5 == 1, "").alias("source_video_id"),
                F.when(F.col("k") % 3 == 0, F.concat(F.lit("10.0.0."), F.col("k"))).alias("ip"),
            )
        ).alias("body"),
    )


def checkout_view(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One message per event: purchases complete a checkout, signups start a subscription
    checkout, everything else is a type nobody handles.  Works on a stream too."""
    kind = F.col("event_type")
    u = F.col("user_id")
    return events.select(
        *keep,
        F.col("event_id").alias("id"),
        F.col("ts").alias("received_at"),
        F.to_json(
            F.struct(
                F.when(kind.isin("purchase", "signup"), "checkout.session.completed")
                .otherwise(F.concat(F.lit("page."), kind))
                .alias("type"),
                F.struct(
                    F.struct(
                        F.concat(F.lit("cs_"), F.col("event_id")).alias("id"),
                        F.when(kind == "signup", "subscription").otherwise("payment").alias("mode"),
                        X.cents("value").alias("amount_total"),
                        F.lit("usd").alias("currency"),
                        F.concat(F.lit("cus_"), u).alias("customer"),
                        F.struct(
                            F.concat(F.lit("customer."), F.lpad(u.cast("string"), 9, "0"), F.lit("@example.com"))
                            .alias("email"),
                            F.concat(F.lit("Customer#"), F.lpad(u.cast("string"), 9, "0")).alias("name"),
                        ).alias("customer_details"),
                        F.struct(
                            F.when(F.col("k") < 50, F.col("k").cast("string")).alias("product_id"),
                            F.when(F.col("k") >= 50, F.concat(F.lit("price_"), F.col("k"))).alias("price_id"),
                        ).alias("metadata"),
                    ).alias("object")
                ).alias("data"),
            )
        ).alias("body"),
    )


def affiliate_view(events: DataFrame, affiliates: Column) -> DataFrame:
    """One affiliate message per purchase: a third names the affiliate, a third the code, the rest a code nobody has.
    Every fifth purchase is sent twice, the second time with another amount."""
    e, k, u = F.col("event_id"), F.col("k"), F.col("user_id")
    kind = F.when(k < 30, "tripwire").when(k < 60, "membership").when(k < 80, "automation_package").when(k < 90, "course")
    sent = events.where("event_type = 'purchase'").select(
        "event_id", "k", "user_id", "ts", X.cents("value").alias("cents"),
        F.explode(F.when(e % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    return sent.select(
        (e + F.col("again") * 10_000_000).alias("id"),
        (F.col("ts") + F.make_dt_interval(hours=F.col("again"))).alias("received_at"),
        F.to_json(
            F.struct(
                F.concat(F.lit("p"), e).alias("purchase_id"),
                F.when(e % 3 == 0, (e % affiliates).cast("string")).alias("affiliate_id"),
                F.when(e % 3 == 1, F.concat(F.lit("AFF"), e % affiliates)).when(e % 3 == 2, F.concat(F.lit("GONE"), e)).alias("referral_code"),
                F.when(e % 50 != 0, F.col("cents") + F.col("again")).alias("amount_cents"),
                kind.alias("product_type"),
                F.when(k % 4 == 0, 45).when(k % 4 == 1, 0).alias("commission_pct"),
                F.concat(F.lit("customer."), F.lpad(u.cast("string"), 9, "0"), F.lit("@example.com")).alias("customer_email"),
                F.when(e % 2 == 0, u.cast("string")).alias("profile_id"),
                F.when((kind == "membership") & (e % 2 == 0), F.concat(F.lit("sub_"), u)).alias("membership_id"),
                F.when((kind == "membership") & (e % 2 == 0), F.lit(True)).alias("is_recurring"),
            )
        ).alias("body"),
    )


def subscription_view(orders: DataFrame) -> DataFrame:
    """One subscription message per order, in the sender's JSON shape; works on a stream too."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    start = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    kind = (
        F.when(key % 11 == 0, "customer.subscription.created")
        .when(key % 11 == 1, "customer.subscription.deleted")
        .otherwise("customer.subscription.updated")
    )
    status = (
        F.when(key % 11 == 1, "canceled").when(F.col("o_orderstatus") == "P", "past_due").otherwise("active")
    )
    return orders.select(
        key.alias("id"),
        F.col("o_orderdate").alias("received_at"),
        F.to_json(
            F.struct(
                kind.alias("type"),
                F.struct(
                    F.struct(
                        F.concat(F.lit("sub_"), cust).alias("id"),
                        status.alias("status"),
                        F.concat(F.lit("cus_"), cust).alias("customer"),
                        start.alias("current_period_start"),
                        (start + 30 * 86400).alias("current_period_end"),
                        (key % 17 == 0).alias("cancel_at_period_end"),
                        F.when(key % 11 == 1, start).alias("ended_at"),
                        F.when((key % 11 == 1) | (key % 17 == 0), start).alias("canceled_at"),
                        F.when(key % 13 == 0, start).alias("trial_start"),
                        F.when(key % 13 == 0, start + 14 * 86400).alias("trial_end"),
                        F.struct(F.concat(F.lit("plan_"), key % 3).alias("plan_id")).alias("metadata"),
                        F.struct(
                            F.array(F.struct(F.struct(X.cents("o_totalprice").alias("unit_amount")).alias("price")))
                            .alias("data")
                        ).alias("items"),
                    ).alias("object")
                ).alias("data"),
            )
        ).alias("body"),
    )


def funnel_view(events: DataFrame) -> DataFrame:
    """Funnel events from raw events; works on a stream too."""
    k, kind = F.col("k"), F.col("event_type")
    stage = (
        F.when(
            kind == "view",
            F.when(k >= 95, "referral_click").when(k >= 50, "profile_visit").otherwise("content_view"),
        )
        .when(
            kind == "click",
            F.when(k >= 90, "automation_package_view")
            .when(k >= 75, "membership_view")
            .when(k >= 50, "tripwire_view")
            .otherwise("landing_page_view"),
        )
        .when(
            kind == "signup",
            F.when(k >= 85, "affiliate_signup").when(k >= 70, "membership_started").otherwise("lead_magnet_download"),
        )
        .when(
            kind == "purchase",
            F.when(k >= 90, "automation_package_purchase")
            .when(k >= 60, "membership_purchased")
            .otherwise("tripwire_purchase"),
        )
    )
    anonymous = F.col("user_id") % 10 == 0
    return events.where(kind != "error").select(
        F.col("event_id").alias("id"),
        F.when(~anonymous, F.col("user_id")).alias("profile_id"),
        F.when(anonymous, F.concat(F.lit("a"), F.col("user_id"))).alias("anonymous_id"),
        F.when(anonymous, F.concat(F.lit("a"), F.col("user_id"))).otherwise(F.col("user_id").cast("string")).alias("person"),
        stage.alias("stage"),
        k.alias("source_video_id"),
        *utm_columns(k),
        F.when(kind == "purchase", X.cents("value")).otherwise(F.lit(0)).cast("long").alias("revenue_cents"),
        F.col("ts").alias("created_at"),
    )
