"""Checkout messages -> purchases, access, tags, lifetime value."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from growthloom import schemas
from growthloom.functions import exprs as X
from growthloom.operators import filters, upsert as U
from growthloom.operators.joins import apart, or_lookup
from growthloom.sources.documents import parse_messages


@dataclass
class PurchaseResult:
    skipped: DataFrame
    subscriptions: DataFrame
    purchases: DataFrame


def checkouts(messages: DataFrame) -> DataFrame:
    """Flat checkout rows with `skip` and `reason`."""
    parsed = parse_messages(messages, schemas.CHECKOUT_MESSAGE)
    o = F.col("msg.data.object")
    flat = parsed.select(
        "id", "received_at", F.col("msg.type").alias("event_type"), o["id"].alias("session_id"),
        X.normalize_email(F.coalesce(o["customer_details"]["email"], o["customer_email"], F.lit(""))).alias("customer_email"),
        F.coalesce(o["customer_details"]["name"], F.lit("")).alias("customer_name"),
        F.coalesce(o["amount_total"], F.lit(0)).alias("amount_cents"),
        X.or_default(o["currency"], "usd").alias("currency"),
        o["customer"].alias("stripe_customer_id"),
        o["metadata"]["product_id"].alias("meta_product_id"),
        o["metadata"]["price_id"].alias("meta_price_id"),
        X.or_default(o["mode"], "payment").alias("mode"),
    )
    return filters.gate(flat, "event_type")


def purchases_from(messages: DataFrame, products: DataFrame, profiles: DataFrame) -> PurchaseResult:
    return route_checkouts(checkouts(messages), products, profiles)


def route_checkouts(rows: DataFrame, products: DataFrame, profiles: DataFrame) -> PurchaseResult:
    """Payments with their product and buyer; subscription checkouts go to the
    membership job, unhandled types are kept aside."""
    skipped, handled = filters.route(rows, F.col("skip"))
    subs, payments = filters.route(handled, F.col("mode") == "subscription")
    catalog = products.select(
        F.col("id").alias("product_id"), F.col("id").cast("string").alias("_pid"), "stripe_price_id", "product_type"
    )
    sold = or_lookup(
        payments, catalog, [("meta_product_id", "_pid"), ("meta_price_id", "stripe_price_id")], ["product_id", "product_type"]
    )
    buyers = profiles.select(F.col("id").alias("profile_id"), F.col("email").alias("customer_email"))
    bought = sold.join(apart(buyers), "customer_email", "left").select(
        F.col("session_id").alias("processor_charge_id"), "id", "product_id", "product_type", "matched_on",
        "profile_id", "customer_email", "amount_cents", "currency", F.lit("completed").alias("status"),
        F.col("received_at").alias("created_at"),
    )
    return PurchaseResult(skipped, subs, bought)


def resolve_person(messages: DataFrame, subscribers: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every address of the messages with its subscriber and profile; missing ones
    get an id made from the address, so a replay creates the same rows."""
    people = messages.where(X.valid_email("customer_email")).groupBy(F.col("customer_email").alias("email")).agg(
        F.max_by("stripe_customer_id", F.struct("received_at", "id")).alias("stripe_customer_id")
    )
    made = F.sha2("email", 256)
    subs = subscribers.select("email", F.col("id").cast("string").alias("_sid"))
    profs = profiles.select("email", F.col("id").cast("string").alias("_pid"))
    return people.join(subs, "email", "left").join(profs, "email", "left").select(
        "email", "stripe_customer_id",
        F.coalesce("_sid", made).alias("subscriber_id"), F.coalesce("_pid", made).alias("profile_id"),
        F.col("_sid").isNull().alias("new_subscriber"), F.col("_pid").isNull().alias("new_profile"),
    )


def buyer_ltv(subscribers: DataFrame, purchases: DataFrame) -> DataFrame:
    """Subscribers' lifetime value after the purchases are added."""
    deltas = purchases.where("profile_id is not null").select(F.col("profile_id").alias("id"), "amount_cents")
    return U.apply_deltas(subscribers, deltas, "id", {"ltv_cents": "amount_cents"})


def purchase_tags(tags: DataFrame, purchases: DataFrame) -> DataFrame:
    """Subscriber tags with `purchased-<type>` added for every product type bought."""
    slug = F.concat(F.lit("purchased-"), F.translate("product_type", "_", "-"))
    bought = purchases.where("profile_id is not null and product_type is not null").select(
        F.col("profile_id").alias("subscriber_id"), slug.alias("tag")
    )
    return tags.select("subscriber_id", "tag").union(bought.distinct()).distinct()
