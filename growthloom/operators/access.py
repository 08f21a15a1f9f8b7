"""Row visibility per role, and admissibility of writes."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Who may read what ----------------------------------------------
OPEN_TABLES = ["content_templates", "viral_hooks", "automation_membership_blueprints"]
ACTIVE_TABLES = ["digital_products", "membership_plans"]
# table -> column that holds the owner's profile id
OWNED = {
    "user_sessions": "profile_id",
    "purchases": "profile_id",
    "memberships": "profile_id",
    "membership_events": "profile_id",
    "affiliates": "profile_id",
}
# table -> (link column, owned parent table)
OWNED_THROUGH = {
    "purchase_items": ("purchase_id", "purchases"),
    "affiliate_referrals": ("affiliate_id", "affiliates"),
    "affiliate_commissions": ("affiliate_id", "affiliates"),
}
# -----------------------------------------------------------------------------


def _own_profiles(tables: dict[str, DataFrame], uid: str) -> DataFrame:
    return tables["profiles"].where(F.col("auth_id") == uid).select(F.col("id").alias("_owner"))


def visible(tables: dict[str, DataFrame], table: str, role: str = "anon", uid: str | None = None) -> DataFrame:
    """The rows of `table` a role may read."""
    df = tables[table]
    if role == "service_role":
        return df
    if table == "content_videos":
        public = df.where(F.col("status") == "published")
    elif table in ACTIVE_TABLES:
        public = df.where("is_active")
    elif table in OPEN_TABLES:
        public = df
    else:
        public = None
    if public is not None:
        return public
    if role == "authenticated" and uid is not None:
        if table == "profiles":
            return df.where(F.col("auth_id") == uid)
        if table in OWNED:
            mine = _own_profiles(tables, uid)
            return df.join(mine, F.col(OWNED[table]) == F.col("_owner"), "left_semi")
        if table in OWNED_THROUGH:
            link, parent = OWNED_THROUGH[table]
            parents = visible(tables, parent, role, uid).select(F.col("id").alias("_parent"))
            return df.join(parents, F.col(link) == F.col("_parent"), "left_semi")
    return df.where(F.lit(False))


def check_writes(df: DataFrame, profiles: DataFrame, table: str, role: str, uid: str | None = None) -> DataFrame:
    """Add `accepted`: may this role write the row?

    The insert policies name no role, so they hold for every caller and are ORed: funnel events and page views without a
    profile are open to all, those of a profile to its owner. On `profiles` the row is an update, allowed to its owner.
    """
    if role == "service_role":
        return df.withColumn("accepted", F.lit(True))
    if table not in ("analytics_funnel_events", "analytics_page_views", "profiles"):
        return df.withColumn("accepted", F.lit(False))
    if table == "profiles":
        own = F.coalesce(F.col("auth_id") == F.lit(uid), F.lit(False))
        return df.withColumn("accepted", own if role == "authenticated" else F.lit(False))
    free = F.col("profile_id").isNull()
    if role != "authenticated" or uid is None:
        return df.withColumn("accepted", free)
    mine = _own_profiles({"profiles": profiles}, uid).distinct()
    joined = df.join(mine, F.col("profile_id") == F.col("_owner"), "left")
    return joined.withColumn("accepted", free | F.col("_owner").isNotNull()).drop("_owner")
