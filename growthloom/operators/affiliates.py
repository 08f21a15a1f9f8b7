"""Affiliate commissions, balances and payouts."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.functions import exprs as X
from growthloom.operators.joins import apart
from growthloom.operators.revenue import with_product_type
from growthloom.plans import keyed

MIN_PAYOUT_CENTS = 5_000


def affiliate_run(purchases: DataFrame, affiliates: DataFrame, products: DataFrame) -> DataFrame:
    """Commission of every purchase that an active affiliate brought in."""
    sold = with_product_type(purchases.where("affiliate_id is not null"), apart(products))
    who = affiliates.where("is_active").select(F.col("id").alias("affiliate_id"), "tier", "commission_pct")
    rate = X.commission_rate(F.lit(None), "product_type", "commission_pct")
    return sold.join(apart(who), "affiliate_id").select(
        F.col("id").alias("purchase_id"), "affiliate_id", "profile_id", "product_type", "tier", "created_at",
        F.col("amount_cents").alias("purchase_cents"),
        rate.alias("rate_pct"),
        X.commission_cents("amount_cents", rate, "tier").alias("amount_cents"),
        X.pct(X.commission_cents("amount_cents", rate, "tier"), "amount_cents").alias("effective_pct"),
        F.when(F.col("product_type") == "membership", "recurring").otherwise("one_time").alias("commission_type"),
        F.lit("pending").alias("status"),
    )


def affiliate_balances(commissions: DataFrame) -> DataFrame:
    """Earned, paid and open cents per affiliate."""
    def of(*states: str):
        return F.coalesce(F.sum(F.when(F.col("status").isin(*states), F.col("amount_cents"))), F.lit(0))

    return commissions.groupBy("affiliate_id").agg(
        of("pending", "approved", "paid").alias("total_earned_cents"),
        of("paid").alias("total_paid_cents"),
        of("pending", "approved").alias("pending_cents"),
    )


def payouts(commissions: DataFrame, month: str, minimum: int = MIN_PAYOUT_CENTS) -> DataFrame:
    """Approved balances of at least the minimum, counted up to the first of `month`."""
    until = F.lit(month).cast("timestamp_ntz")
    ready = commissions.where((F.col("status") == "approved") & (F.col("created_at") < until))
    sums = ready.groupBy("affiliate_id").agg(
        F.sum("amount_cents").alias("payout_cents"), F.count(F.lit(1)).alias("commissions")
    )
    return sums.where(F.col("payout_cents") >= minimum).withColumn("paid_on", F.lit(month).cast("date"))


def recurrence(commissions: DataFrame, subscription: str, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Number the recurring commissions of each subscription."""
    only = commissions.where("commission_type = 'recurring'")
    return keyed.scan_by_key(
        only, [subscription], "created_at", ["purchase_id"], {"recurrence_number": ("rownum", subscription)}, rows,
    )
