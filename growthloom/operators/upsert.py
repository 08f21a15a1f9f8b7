"""Mutations as functions from snapshot to snapshot (parquet tables have no MERGE)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.plans.keyed import latest_by


def insert_ignore(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add source rows whose key is new; the first in `order` wins within the source."""
    return target.unionByName(new_rows(target, source, key, order).select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in source.columns if c not in key]
    if rest == list(order) and len(rest) == 1:
        one = source.groupBy(*key).agg(F.min(rest[0]).alias(rest[0]))
    elif rest:
        first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")
        one = source.groupBy(*key).agg(first).select(*key, "_r.*")
    else:
        one = source.distinct()
    return one.join(target.select(*key), list(key), "left_anti")


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], set_cols: Sequence[str],
           order: Sequence[str] | None = None) -> DataFrame:
    """Insert new keys; on a key that exists overwrite `set_cols` only.

    Give `order` unless the source has one row per key already: the last row in
    that order wins.
    """
    key = list(key)
    one = latest_by(source, key, order) if order else source
    t = target.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("_t"))
    s = one.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("_s"))
    both = t.join(s, key, "full_outer")
    out = []
    for c in target.columns:
        if c in key:
            out.append(F.col(c))
            continue
        kept, given = F.col(f"_t.{c}"), F.col(f"_s.{c}")
        use_source = F.col("_s").isNotNull() if c in set_cols else F.col("_t").isNull()
        out.append(F.when(use_source, given).otherwise(kept).alias(c))
    return both.select(*out)


def update_from(target: DataFrame, source: DataFrame, key: Sequence[str], exprs: dict[str, Column]) -> DataFrame:
    """Set columns from a matching source row (one per key); others keep their value.

    Expressions may use target columns and source columns.
    """
    extra = [c for c in source.columns if c not in key]
    boxed = source.select(*key, F.lit(True).alias("_hit"), *extra)
    joined = target.join(boxed, list(key), "left")
    sets = {c: F.when(F.col("_hit"), e).otherwise(F.col(c) if c in target.columns else F.lit(None)) for c, e in exprs.items()}
    cols = [*target.columns, *[c for c in exprs if c not in target.columns]]
    return joined.withColumns(sets).select(*cols)


def apply_deltas(target: DataFrame, deltas: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Add summed deltas to counters.  `columns` maps counter -> delta column."""
    sums = deltas.groupBy(key).agg(*[F.sum(d).alias(f"_d_{c}") for c, d in columns.items()])
    joined = target.join(sums, key, "left")
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_d_{c}"), F.lit(0)))
    return joined.select(*target.columns)


def delete_where(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop target rows whose key columns are in `keys`."""
    return target.join(keys.distinct(), keys.columns, "left_anti")


def tag(tags: DataFrame, subscribers: DataFrame, name: str) -> DataFrame:
    """(subscriber_id, tag) pairs with `name` added for every given subscriber."""
    wanted = subscribers.select(F.col("subscriber_id")).distinct().withColumn("tag", F.lit(name))
    return tags.select("subscriber_id", "tag").union(wanted).distinct()


def untag(tags: DataFrame, subscribers: DataFrame, name: str) -> DataFrame:
    gone = subscribers.select("subscriber_id").distinct().withColumn("tag", F.lit(name))
    return tags.join(gone, ["subscriber_id", "tag"], "left_anti")


def swap_tag(tags: DataFrame, subscribers: DataFrame, old: str, new: str) -> DataFrame:
    return untag(tag(tags, subscribers, new), subscribers, old)


def touch(df: DataFrame, changed: Column, as_of: Column) -> DataFrame:
    """Set `updated_at` on changed rows only."""
    return df.withColumn("updated_at", F.when(F.coalesce(changed, F.lit(False)), as_of).otherwise(F.col("updated_at")))


def grant_access(items: DataFrame, products: DataFrame, paid: DataFrame, as_of: Column) -> DataFrame:
    """Open the items paid in this run: flag, time and the first file of the product.

    Items not paid here keep what they have, and an item granted before keeps its time and its link.
    """
    files = products.select(F.col("id").alias("product_id"), F.get_json_object("file_urls", "$[0].url").alias("_url"))
    done = paid.select("purchase_id").distinct().withColumn("_paid", F.lit(True))
    joined = items.join(done, "purchase_id", "left").join(files, "product_id", "left")
    opened = F.coalesce(F.col("_paid"), F.lit(False))

    def old(name: str, kind: str) -> Column:
        return F.col(name) if name in items.columns else F.lit(None).cast(kind)

    before = F.coalesce(old("access_granted", "boolean"), F.lit(False))
    fresh = opened & ~before
    return joined.withColumns(
        {
            "access_granted": before | opened,
            "access_granted_at": F.when(fresh, as_of).otherwise(old("access_granted_at", "timestamp_ntz")),
            "download_url": F.when(fresh, F.col("_url")).otherwise(old("download_url", "string")),
        }
    ).drop("_paid", "_url")


def refresh_last_run(workflows: DataFrame, logs: DataFrame) -> DataFrame:
    """Registry rows with time and status of their newest run; a workflow without a run in `logs` keeps its own."""
    last = logs.groupBy(F.col("workflow_id").alias("id")).agg(
        F.max("started_at").alias("last_run_at"), F.max_by("status", F.struct("started_at", "id")).alias("last_run_status")
    )
    last = last.withColumnsRenamed({"last_run_at": "_at", "last_run_status": "_status"})
    return update_from(workflows, last, ["id"], {"last_run_at": F.col("_at"), "last_run_status": F.col("_status")})
