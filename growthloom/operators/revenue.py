"""Money: revenue, refunds, lifetime value, products."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from growthloom.functions import exprs as X


def with_product_type(purchases: DataFrame, products: DataFrame) -> DataFrame:
    kinds = products.select(F.col("id").alias("product_id"), "product_type")
    return purchases.join(kinds, "product_id")


def revenue(purchases: DataFrame, products: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Completed revenue per product type, 0 when there is none.

    Purchases are summed per (group, product) before they meet the products.
    """
    done = purchases.where("status = 'completed'")
    sums = done.groupBy(*by, "product_id").agg(F.sum("amount_cents").alias("cents"))
    typed = with_product_type(sums, products)

    def of(*kinds: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("product_type").isin(*kinds), F.col("cents"))), F.lit(0))

    return typed.groupBy(*by).agg(
        of("tripwire").alias("tripwire_revenue_cents"),
        of("membership").alias("membership_revenue_cents"),
        of("automation_package").alias("automation_revenue_cents"),
        F.coalesce(F.sum("cents"), F.lit(0)).alias("total_revenue_cents"),
    )


def revenue_trend(purchases: DataFrame, grain: str = "day") -> DataFrame:
    """Completed revenue per day or week and its change against the period before."""
    period = F.to_date(F.date_trunc(grain, F.col("created_at").cast("timestamp"))).alias("period")
    sums = purchases.where("status = 'completed'").groupBy(period).agg(F.sum("amount_cents").alias("revenue_cents"))
    before = F.lag("revenue_cents").over(Window.orderBy("period"))
    return sums.withColumn("previous_cents", before).withColumn(
        "change_pct", X.pct(F.col("revenue_cents") - F.col("previous_cents"), F.col("previous_cents"))
    )


def ltv(purchases: DataFrame) -> DataFrame:
    """Revenue and average order per customer."""
    done = purchases.where("status = 'completed'")
    per = done.groupBy("profile_id").agg(F.sum("amount_cents").alias("ltv_cents"), F.count(F.lit(1)).alias("orders"))
    return per.withColumn("avg_order_cents", X.ratio("ltv_cents", "orders", 2))


def ltv_summary(purchases: DataFrame) -> DataFrame:
    per = ltv(purchases)
    return per.agg(
        F.count(F.lit(1)).alias("customers"), F.sum("ltv_cents").alias("revenue_cents"),
        X.ratio(F.sum("ltv_cents"), F.count(F.lit(1)), 2).alias("mean_ltv_cents"),
    )


def refunds(purchases: DataFrame, by: str = "product_id") -> DataFrame:
    full, part = F.col("status") == "refunded", F.col("status") == "partially_refunded"
    return purchases.groupBy(by).agg(
        F.count(F.lit(1)).alias("purchases"),
        F.count_if(full).alias("refunded"),
        F.count_if(part).alias("partly_refunded"),
        F.coalesce(F.sum(F.when(full | part, F.col("amount_cents"))), F.lit(0)).alias("touched_cents"),
        X.ratio(F.count_if(full | part), F.count(F.lit(1))).alias("refund_rate"),
    )


def product_sales(items: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue and remaining stock of every product."""
    sold = items.groupBy(F.col("product_id").alias("id")).agg(
        F.sum("quantity").alias("units"), F.sum("line_cents").alias("revenue_cents")
    )
    return products.select("id", "product_type", "inventory_count").join(sold, "id", "left").select(
        "id", "product_type",
        F.coalesce("units", F.lit(0)).alias("units"),
        F.coalesce("revenue_cents", F.lit(0)).alias("revenue_cents"),
        (F.col("inventory_count") - F.coalesce("units", F.lit(0))).alias("remaining"),
    )
