"""Lead messages -> clean leads, new subscribers, tags."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from growthloom import schemas
from growthloom.functions import exprs as X
from growthloom.operators import upsert as U
from growthloom.sources.documents import parse_messages

LEAD_TAG = "lead-magnet"
SUBSCRIBER = ["full_name", "source", "source_url", "source_video_id", "double_opt_in_confirmed", "consent_ip", "consent_timestamp"]


@dataclass
class LeadResult:
    leads: DataFrame
    invalid: DataFrame
    new_subscribers: DataFrame
    tags: DataFrame


def clean_leads(messages: DataFrame) -> DataFrame:
    """Typed lead rows with a `valid` flag; needs `id`, `received_at`, `body`."""
    parsed = parse_messages(messages, schemas.LEAD_MESSAGE).select("id", "received_at", "msg.*")
    email = X.normalize_email(F.coalesce("email", F.lit("")))
    return parsed.withColumn("email", email).select(
        "id", "received_at", "email",
        X.display_name("name", "email").alias("full_name"),
        X.or_default("source", "landing_page").alias("source"),
        X.or_default("source_url", "").alias("source_url"),
        F.nullif("source_video_id", F.lit("")).alias("source_video_id"),
        F.coalesce("double_opt_in", F.lit(False)).alias("double_opt_in_confirmed"),
        X.or_default("ip", "").alias("consent_ip"),
        F.col("received_at").alias("consent_timestamp"),
        X.valid_email("email").alias("valid"),
    )


def lead_capture(messages: DataFrame, subscribers: DataFrame, lead_tag: str = LEAD_TAG) -> LeadResult:
    return capture(clean_leads(messages), subscribers, lead_tag)


def capture(rows: DataFrame, subscribers: DataFrame, lead_tag: str = LEAD_TAG) -> LeadResult:
    """Valid leads make a subscriber when their address is new; all of them get both tags."""
    good, bad = rows.where("valid"), rows.where("not valid")
    new = U.new_rows(
        subscribers.select("email"),
        good.select("email", "id", *SUBSCRIBER, F.col("received_at").alias("created_at")),
        ["email"], ["created_at", "id"],
    ).drop("id").withColumn("status", F.lit("active"))
    tags = good.select(
        "email", F.explode(F.array(F.concat(F.lit("source-"), F.col("source")), F.lit(lead_tag))).alias("tag")
    ).distinct()
    return LeadResult(good, bad, new, tags)
