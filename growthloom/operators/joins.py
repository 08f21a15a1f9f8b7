"""Joins that need more than a plain `join` call.

Sides are never broadcast by hint: Spark decides from their size, and AQE splits
hot keys of the large side. Sides that grow with the input may be kept `apart`.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.plans import keyed
from growthloom.session import stage


def apart(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input and is never to be broadcast.

    A scan counts as the bytes of its files, which a table of many rows and narrow or repeated values keeps small: Spark then
    gathers it in the driver. Both sides are shuffled instead, and AQE splits hot keys.
    """
    return side.hint("merge")


def members(memberships: DataFrame, profiles: DataFrame) -> DataFrame:
    """Memberships with the contact data of their profile."""
    who = profiles.select(F.col("id").alias("profile_id"), "email", "full_name")
    return memberships.join(who, "profile_id")


def workflow_logs(workflows: DataFrame, logs: DataFrame, cond: Column, keep_idle: bool = True) -> DataFrame:
    """Workflows with their runs that meet `cond`; idle workflows stay unless told otherwise.

    Few workflows own all runs, so the runs must not be shuffled by workflow: as
    the large side of an inner join they stay where they are when the registry
    fits a broadcast, which an outer join from the registry would not allow.
    """
    runs = logs.where(cond).withColumnRenamed("id", "run_id").withColumnRenamed("workflow_id", "id")
    busy = runs.join(workflows, "id")
    if not keep_idle:
        return busy
    idle = workflows.join(runs.select("id").distinct(), "id", "left_anti")
    return busy.unionByName(idle, allowMissingColumns=True)


def or_lookup(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], payload: Sequence[str]) -> DataFrame:
    """Match on the first key pair that hits, later pairs only where earlier ones miss.

    One equi-join per pair instead of a nested-loop join on an OR.  A right key
    that repeats counts once, with its least payload, so no left row is doubled;
    left rows without any match keep NULL payload.
    """
    out = left
    for n, (lk, rk) in enumerate(pairs):
        side = right.where(F.col(rk).isNotNull()).groupBy(F.col(rk).alias(f"_k{n}")).agg(
            F.min(F.struct(*[F.col(p) for p in payload])).alias(f"_p{n}")
        )
        out = out.join(apart(side), F.col(lk) == F.col(f"_k{n}"), "left")
    hit = F.coalesce(*[F.col(f"_p{n}") for n in range(len(pairs))])
    matched = F.coalesce(
        *[F.when(F.col(f"_p{n}").isNotNull(), F.lit(lk)) for n, (lk, _) in enumerate(pairs)]
    )
    return out.withColumn("_hit", hit).select(*left.columns, "_hit.*", matched.alias("matched_on"))


def unused(candidates: DataFrame, used: DataFrame, key: str) -> DataFrame:
    return candidates.join(used.select(key), key, "left_anti")


def zip_rows(a: DataFrame, b: DataFrame, order_a: Sequence[Column], order_b: Sequence[Column]) -> DataFrame:
    """Row n of `a` beside row n of `b`, in the given total orders."""
    left = keyed.number_rows(a, order_a, "position")
    right = keyed.number_rows(b, order_b, "position")
    return left.join(right, "position")


def visual_at(visuals: str, i: Column) -> Column:
    """The visual at position `i` from 0, or the last one; NULL when there is none."""
    last = F.size(visuals)
    return F.when(last > 0, F.try_element_at(F.col(visuals), F.least(i + 1, last)))


def align(scripts: DataFrame, keep: Sequence[str], lines: str, visuals: str) -> DataFrame:
    """One row per script line with the visual of the same position, or the last one
    when there are fewer.  Paired inside the row, so arrays are never copied per line."""

    def pair(line: Column, i: Column) -> Column:
        return F.struct((i + 1).cast("long").alias("line_no"), line.alias("line"), visual_at(visuals, i).alias("visual"))

    return scripts.select(*keep, F.inline(F.transform(lines, pair)))


def attribute(clicks: DataFrame, buys: DataFrame, keys: Sequence[str], days: int, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Credit each buy to the latest click of the same keys at most `days` before it.

    An as-of scan over the union of both inputs: every input row is looked at
    once, no click-buy pairs are formed.  Inputs have (keys, id, at); the result
    has one row per buy, `click_id` NULL when no click is in reach.
    """
    cols = [*keys, "id", "at"]
    both = clicks.select(*cols, F.lit(0).alias("kind")).unionByName(buys.select(*cols, F.lit(1).alias("kind")))
    seen = F.when(F.col("kind") == 0, F.struct("at", "id"))
    scanned = keyed.scan_by_key(both, keys, "at", ["kind", "id"], {"_click": ("max", seen)}, rows)
    reach = F.col("_click.at") >= F.col("at") - F.expr(f"interval {days} days")
    return scanned.where("kind = 1").select(
        *cols,
        F.when(reach, F.col("_click.id")).alias("click_id"),
        F.when(reach, F.col("_click.at")).alias("clicked_at"),
    )


def attribute_each(clicks: DataFrame, buys: DataFrame, keys: Sequence[str], rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Credit each buy to the latest click of the same keys that has not run out, where every click lasts its own `days`.

    The newest click may have run out while an older one still lasts, so a single running maximum is not enough: of the clicks
    of one length the newest is the best, so there is one as-of scan per key and length among the key's own clicks, and a buy
    takes the latest of the clicks found that still last.  A buy is copied once per length of its key's clicks; no click-buy
    pairs are formed, and hot keys are cut into slices.

    Clicks have (keys, id, at, by, days), buys (keys, id, at) with ids of their own; the result has one row per buy with
    click_id, clicked_at and by, NULL when no click lasts.  Clicks of one instant: the greatest id, then the greatest `by`, wins.
    """
    lengths = clicks.select(*keys, "days").distinct()
    asked = buys.select(*keys, "id", "at").join(lengths, list(keys), "left")
    both = clicks.select(*keys, "days", "id", "at", "by", F.lit(0).alias("kind")).unionByName(
        asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    seen = F.when(F.col("kind") == 0, F.struct("at", "id", "by"))
    scanned = keyed.scan_by_key(both, [*keys, "days"], "at", ["kind", "id", "by"], {"_click": ("max", seen)}, rows)
    lasts = F.col("_click.at") + F.make_dt_interval(days=F.col("days").cast("int")) >= F.col("at")
    best = scanned.where("kind = 1").groupBy(*keys, "id", "at").agg(F.max(F.when(lasts, F.col("_click"))).alias("_click"))
    return best.select(*keys, "id", "at", F.col("_click.id").alias("click_id"), F.col("_click.at").alias("clicked_at"), F.col("_click.by").alias("by"))


def next_buy(starts: DataFrame, buys: DataFrame, key: str, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Every checkout start with `next_at`, the time of the next purchase of the same key."""
    cols = [key, "id", "at"]
    both = starts.select(*cols, F.lit(1).alias("kind")).unionByName(buys.select(*cols, F.lit(0).alias("kind")))
    # Walk backwards in time, so that the running minimum is the next purchase.
    bought = F.when(F.col("kind") == 0, F.col("at"))
    scanned = keyed.scan_by_key(both, [key], "at", ["kind", "id"], {"next_at": ("min", bought)}, rows, descending=True)
    return scanned.where("kind = 1").select(*cols, "next_at")


def abandoned(starts: DataFrame, buys: DataFrame, key: str, as_of: Column, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Checkouts without a later purchase of the same person -> reminder step by age.

    A checkout counts as finished when a purchase follows within 48 hours; the
    step is 1, 2 or 3 once 1, 24 or 48 hours passed without one.
    """
    hours = (keyed.micros(as_of) - keyed.micros(F.col("at"))) / F.lit(3.6e9)
    step = F.when(hours >= 48, 3).when(hours >= 24, 2).when(hours >= 1, 1).otherwise(0)
    done = F.col("next_at") <= F.col("at") + F.expr("interval 48 hours")
    seen = next_buy(starts, buys, key, rows)
    return seen.where(~F.coalesce(done, F.lit(False))).select(key, "id", "at", step.alias("step"))


def referral_counts(profiles: DataFrame, needed: int = 3) -> DataFrame:
    """How many profiles each profile referred; enough of them earn a free membership."""
    counts = profiles.where(F.col("referred_by").isNotNull()).groupBy(F.col("referred_by").alias("id")).agg(
        F.count(F.lit(1)).alias("referrals")
    )
    return profiles.join(counts, "id").select("id", "email", "referrals", (F.col("referrals") >= needed).alias("free_membership"))


def version_lineage(scripts: DataFrame, parent: str = "previous_version_id", max_depth: int = 1 << 20) -> DataFrame:
    """Root version and depth of every script by pointer doubling.

    Each round halves the distance to the root, so a chain of n versions takes
    log2(n) rounds; rows that reached their root leave the join.
    """
    links = scripts.select("id", F.col(parent).alias("up"))
    there = scripts.select(F.col("id").alias("_id"))
    # A link to a version that is not there ends the chain.
    state = links.join(there, F.col("up") == F.col("_id"), "left").select(
        "id", F.when(F.col("_id").isNotNull(), F.col("up")).alias("up")
    )
    done = state.where("up is null").select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth"))
    done = stage(done, "lineage-done")
    active = stage(state.where("up is not null").select("id", "up", F.lit(1).cast("long").alias("depth")), "lineage-active")
    rounds = 0
    while not active.isEmpty():
        rounds += 1
        if 1 << rounds > 2 * max_depth:
            raise ValueError("version chain is longer than max_depth or has a cycle")
        known_roots = done.select(F.col("id").alias("_id"), "root", F.col("depth").alias("_d"))
        jumps = active.select(F.col("id").alias("_aid"), F.col("up").alias("_up"), F.col("depth").alias("_ad"))
        stepped = active.join(known_roots, F.col("up") == F.col("_id"), "left").join(
            jumps, F.col("up") == F.col("_aid"), "left"
        )
        stepped = stage(
            stepped.select(
                "id", "root",
                F.col("_up").alias("up"),
                (F.col("depth") + F.coalesce("_d", "_ad")).alias("depth"),
            ),
            "lineage-step",
        )
        done = done.unionByName(stepped.where("root is not null").select("id", "root", "depth"))
        active = stepped.where("root is null").select("id", "up", "depth")
    return done


def audience(campaigns: DataFrame, tags: DataFrame) -> DataFrame:
    """(campaign_id, subscriber_id) with any target tag and no excluded tag.

    One pass over the tags: wanted and banned tags of all campaigns join together
    and are told apart while they are counted.
    """
    wants = campaigns.select("campaign_id", F.explode("target_tags").alias("tag"), F.lit(True).alias("wanted"))
    bans = campaigns.select("campaign_id", F.explode("exclude_tags").alias("tag"), F.lit(False).alias("wanted"))
    hits = tags.join(wants.unionByName(bans), "tag")
    seen = hits.groupBy("campaign_id", "subscriber_id").agg(F.bool_and("wanted").alias("wanted"))
    return seen.where("wanted").select("campaign_id", "subscriber_id")


def pick_winner(hooks: DataFrame) -> DataFrame:
    """Every variant with the id of its group's best performer."""
    best = hooks.where("actual_performance is not null").groupBy("variant_group").agg(
        F.max_by("id", F.struct("actual_performance", -F.col("id"))).alias("winning_variant_id")
    )
    return hooks.join(best, "variant_group", "left")


def video_attribution(funnel: DataFrame, purchases: DataFrame, videos: DataFrame) -> DataFrame:
    """Funnel volume and completed revenue credited to the source video.

    Both event sides are summed per video before they meet.
    """
    steps = funnel.groupBy(F.col("source_video_id").alias("id")).agg(
        F.count_if(F.col("stage") == "content_view").alias("views"),
        F.count_if(F.col("stage") == "lead_magnet_download").alias("leads"),
        F.count_if(F.col("stage").endswith("_purchase") | (F.col("stage") == "membership_purchased")).alias("sales"),
    )
    money = purchases.where("status = 'completed'").groupBy(F.col("source_video_id").alias("id")).agg(
        F.sum("amount_cents").alias("revenue_cents")
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("views", "leads", "sales", "revenue_cents")}
    return videos.select("id", "hook_id").join(steps, "id", "left").join(money, "id", "left").withColumns(zero)
