"""Affiliate messages -> referrals, commissions, totals; and commissions of attributed sales."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from growthloom import schemas
from growthloom.functions import exprs as X
from growthloom.operators import upsert as U
from growthloom.operators.joins import attribute_each, or_lookup
from growthloom.plans import keyed
from growthloom.sources.documents import parse_messages


@dataclass
class AffiliateResult:
    rejected: DataFrame
    referrals: DataFrame
    commissions: DataFrame
    affiliates: DataFrame


def affiliate_rows(messages: DataFrame) -> DataFrame:
    """One flat row per purchase with the message's defaults; of several messages of a purchase the first counts.

    A missing amount is 0, a missing type a tripwire; a rate that is missing or 0 is none.
    """
    m = F.col("msg")
    flat = parse_messages(messages, schemas.AFFILIATE_MESSAGE).where(m["purchase_id"].isNotNull()).select(
        "id", "received_at", m["purchase_id"].alias("purchase_id"), m["affiliate_id"].alias("affiliate_id"),
        m["referral_code"].alias("referral_code"), F.coalesce(m["amount_cents"], F.lit(0)).alias("amount_cents"),
        X.or_default(m["product_type"], "tripwire").alias("product_type"),
        F.when(m["commission_pct"] != 0, m["commission_pct"]).alias("message_rate"),
        X.normalize_email(F.coalesce(m["customer_email"], F.lit(""))).alias("referred_email"),
        m["profile_id"].alias("referred_profile_id"), m["membership_id"].alias("membership_id"),
        F.coalesce(m["is_recurring"], F.lit(False)).alias("is_recurring"),
    )
    rest = [c for c in flat.columns if c != "purchase_id"]
    first = flat.groupBy("purchase_id").agg(F.min_by(F.struct(*rest), F.struct("received_at", "id")).alias("_r"))
    return first.select("purchase_id", "_r.*")


def _made(*parts: Column) -> Column:
    """An id that a replay makes again."""
    return F.sha2(F.concat_ws("/", *parts), 256)


def affiliate_sync(messages: DataFrame, affiliates: DataFrame) -> AffiliateResult:
    """Look the affiliate up by id, else by code; commission by message rate, else product, else affiliate, with the tier's bonus.

    Every paid purchase of an active affiliate makes a referral and a commission that names it, and adds to the affiliate's
    earned and pending cents.  Purchases of unknown or inactive affiliates are kept aside with the reason.
    """
    known = affiliates.select(F.col("id").cast("string").alias("_id"), "referral_code", F.col("id").alias("affiliate"), "tier", "commission_pct", "is_active")
    asked = affiliate_rows(messages).withColumnRenamed("referral_code", "asked_code")
    found = or_lookup(asked, known, [("affiliate_id", "_id"), ("asked_code", "referral_code")], ["affiliate", "tier", "commission_pct", "is_active"])
    reason = F.when(F.col("affiliate").isNull(), "unknown").when(~F.coalesce("is_active", F.lit(False)), "inactive")
    marked = found.withColumn("reason", reason)
    rejected = marked.where("reason is not null").select("purchase_id", "affiliate_id", F.col("asked_code").alias("referral_code"), "reason")
    rate = X.commission_rate("message_rate", "product_type", "commission_pct")
    paid = marked.where("reason is null").select(
        "purchase_id", F.col("affiliate").alias("affiliate_id"), "referred_email", "referred_profile_id", "membership_id", "received_at",
        "amount_cents", rate.alias("rate_pct"), X.commission_cents("amount_cents", rate, "tier").alias("commission_cents"), "is_recurring",
        _made(F.lit("referral"), F.col("purchase_id"), F.col("affiliate").cast("string")).alias("referral_id"))
    referrals = paid.select(
        F.col("referral_id").alias("id"), "affiliate_id", "referred_email", "referred_profile_id", F.lit(True).alias("converted"),
        F.col("received_at").alias("converted_at"), "purchase_id", F.col("amount_cents").alias("purchase_amount_cents"), "commission_cents")
    commissions = paid.select(
        _made(F.lit("commission"), F.col("referral_id")).alias("id"), "affiliate_id", "referral_id", F.col("commission_cents").alias("amount_cents"),
        F.lit("usd").alias("currency"), F.when(F.col("is_recurring"), "recurring").otherwise("one_time").alias("commission_type"), "rate_pct",
        X.pct("commission_cents", "amount_cents").alias("effective_pct"), F.col("purchase_id").alias("source_purchase_id"),
        F.col("membership_id").alias("source_membership_id"), F.lit("pending").alias("status"), F.col("received_at").alias("created_at"))
    return AffiliateResult(rejected, referrals, commissions, add_totals(affiliates, commissions))


def add_totals(affiliates: DataFrame, commissions: DataFrame) -> DataFrame:
    """Affiliates with new pending commissions added to what they earned and have to come."""
    sums = commissions.where("status = 'pending'").select(F.col("affiliate_id").alias("id"), "amount_cents")
    return U.apply_deltas(affiliates, sums, "id", {"total_earned_cents": "amount_cents", "pending_cents": "amount_cents"})


def number_recurring(commissions: DataFrame, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Recurring commissions with their number within the membership, in time order."""
    only = commissions.where("commission_type = 'recurring' and source_membership_id is not null")
    return keyed.scan_by_key(only, ["source_membership_id"], "created_at", ["source_purchase_id"],
                             {"recurrence_number": ("rownum", "source_membership_id")}, rows)


def attributed_commissions(clicks: DataFrame, sales: DataFrame, affiliates: DataFrame, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Commission of every sale that a click of some affiliate still covers, paid to the winner.

    Clicks are (profile_id, id, at, affiliate_id), sales (profile_id, id, at, amount_cents, product_type).  A click lasts its
    affiliate's `cookie_days`; inactive affiliates do not compete.
    """
    who = affiliates.where("is_active")
    lasting = clicks.join(who.select(F.col("id").alias("affiliate_id"), F.col("cookie_days").alias("days")), "affiliate_id")
    won = attribute_each(lasting.withColumnRenamed("affiliate_id", "by"), sales, ["profile_id"], rows).where("click_id is not null")
    paid = won.join(sales.select("id", "amount_cents", "product_type"), "id").withColumnRenamed("by", "affiliate_id")
    terms = who.select(F.col("id").alias("affiliate_id"), "tier", "commission_pct")
    rate = X.commission_rate(F.lit(None), "product_type", "commission_pct")
    return paid.join(terms, "affiliate_id").select(
        "id", "profile_id", "affiliate_id", "click_id", "clicked_at", "at", X.commission_cents("amount_cents", rate, "tier").alias("amount_cents"))
