"""Subscription messages -> membership rows, member flags, lifecycle log."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from growthloom import schemas
from growthloom.functions import exprs as X
from growthloom.operators import upsert as U
from growthloom.operators.joins import or_lookup
from growthloom.plans import keyed
from growthloom.sources.documents import parse_messages


def subscription_rows(messages: DataFrame) -> DataFrame:
    """Flat subscription rows; needs `id`, `received_at`, `body`."""
    o = F.col("msg.data.object")
    price = F.try_element_at(o["items"]["data"], F.lit(1))["price"]
    return parse_messages(messages, schemas.SUBSCRIPTION_MESSAGE).select(
        "id", "received_at", F.col("msg.type").alias("message_type"),
        o["id"].alias("stripe_subscription_id"), o["customer"].alias("stripe_customer_id"),
        o["metadata"]["email"].alias("customer_email"),
        X.map_status(o["status"]).alias("status"),
        (~F.coalesce(o["status"].isin(X.SUBSCRIPTION_STATUS), F.lit(False))).alias("unknown_status"),
        X.epoch_ts(o["current_period_start"]).cast("timestamp_ntz").alias("current_period_start"),
        X.epoch_ts(o["current_period_end"]).cast("timestamp_ntz").alias("current_period_end"),
        *[X.epoch_ts(o[c]).cast("timestamp_ntz").alias(c) for c in ("trial_start", "trial_end", "canceled_at", "ended_at")],
        o["metadata"]["plan_id"].alias("plan_id"),
        F.coalesce(o["cancel_at_period_end"], F.lit(False)).alias("cancel_at_period_end"),
        F.coalesce(price["unit_amount"], o["metadata"]["price_cents"], F.lit(1900)).alias("price_cents"),
        F.coalesce(price["currency"], F.lit("usd")).alias("currency"),
        F.coalesce(price["recurring"]["interval"], F.lit("month")).alias("interval"),
    )


def lifecycle_log(rows: DataFrame, limit: int = keyed.HOT_ROWS) -> DataFrame:
    """Lifecycle event of every message against the message before it."""
    scanned = keyed.scan_by_key(
        rows, ["stripe_subscription_id"], "received_at", ["id"],
        {
            "prev_price": ("lag", "price_cents"),
            "prev_status": ("lag", "status"),
            "prev_start": ("lag", "current_period_start"),
        },
        limit,
    )
    kind = X.lifecycle_event(
        "message_type", "status", "cancel_at_period_end", "price_cents", "prev_price", "prev_status",
        "current_period_start", "prev_start",
    )
    return scanned.select(
        "id", "stripe_subscription_id", "received_at", "status", F.col("price_cents").alias("new_price"),
        F.col("prev_price").alias("previous_price"), kind.alias("event_type"),
    )


SYNCED = ["status", "current_period_start", "current_period_end", "cancel_at_period_end", "canceled_at", "ended_at"]


def membership_sync(memberships: DataFrame, messages: DataFrame) -> DataFrame:
    """Memberships after the messages: newest message wins; price, plan and trial stay as first seen."""
    rows = subscription_rows(messages).where("not unknown_status")
    return U.upsert(
        memberships,
        rows.select(*memberships.columns, "received_at", "id"),
        ["stripe_subscription_id"], SYNCED, ["received_at", "id"],
    )


def resolve_profiles(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile of each customer's newest message, by customer id or else by address.

    A customer without a profile gets one whose id is made from the customer id,
    so a replay creates the same row.
    """
    newest = keyed.latest_by(
        rows.select("stripe_customer_id", "customer_email", "status", "received_at", "id"),
        ["stripe_customer_id"], ["received_at", "id"],
    )
    known = profiles.select(F.col("id").cast("string").alias("profile_id"), F.col("stripe_customer_id").alias("_cid"), "email")
    found = or_lookup(newest, known, [("stripe_customer_id", "_cid"), ("customer_email", "email")], ["profile_id"])
    return found.select(
        "stripe_customer_id", "status",
        F.coalesce("profile_id", F.sha2("stripe_customer_id", 256)).alias("profile_id"),
        F.col("profile_id").isNull().alias("needs_creation"), X.is_member("status").alias("is_member"),
    )


def member_flags(profiles: DataFrame, latest: DataFrame, now: Column) -> DataFrame:
    """Profiles with member flag and first member time; `latest` has profile_id and status."""
    state = latest.select(F.col("profile_id").alias("id"), F.col("status").alias("_status"))
    joined = profiles.join(state, "id", "left")
    touched = F.col("_status").isNotNull()
    return joined.withColumns(
        {
            "member_since": F.when(touched, X.member_since("_status", "is_member", "member_since", now)).otherwise(
                F.col("member_since")
            ),
            "is_member": F.when(touched, X.is_member("_status")).otherwise(F.col("is_member")),
        }
    ).drop("_status")
