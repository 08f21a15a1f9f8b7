"""Queries for sorting, top-k and set operations."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.operators import content as C
from growthloom.registry.core import op
from growthloom.sources.fixtures import Tables


@op("order_by", "SELECT id, current_period_end, status FROM me ORDER BY current_period_end, id")
def _(t: Tables) -> DataFrame:
    return t.memberships.orderBy("current_period_end", "id").select("id", "current_period_end", "status")


@op("nulls_last", "SELECT id, CAST(actual_performance AS DOUBLE) AS score FROM ho ORDER BY actual_performance DESC NULLS LAST, id")
def _(t: Tables) -> DataFrame:
    return t.hooks.orderBy(F.desc_nulls_last("actual_performance"), F.asc("id")).select(
        "id", F.col("actual_performance").cast("double").alias("score")
    )


@op("top_hooks", """SELECT id, hook_text, CAST(actual_performance AS DOUBLE) AS score, times_used FROM ho WHERE actual_performance IS NOT NULL
    ORDER BY actual_performance DESC, id LIMIT 20""")
def _(t: Tables) -> DataFrame:
    return C.top_hooks(t.hooks, 20, "actual_performance").select(
        "id", "hook_text", F.col("actual_performance").cast("double").alias("score"), "times_used"
    )


@op("top_hooks_estimated", "SELECT id, CAST(estimated_performance AS DOUBLE) AS score FROM ho ORDER BY estimated_performance DESC, id LIMIT 10")
def _(t: Tables) -> DataFrame:
    return C.top_hooks(t.hooks, 10, "estimated_performance").select(
        "id", F.col("estimated_performance").cast("double").alias("score")
    )


@op("top_unused_hooks", """SELECT id, CAST(estimated_performance AS DOUBLE) AS score FROM ho
    WHERE hook_text NOT IN (SELECT hook_text FROM ho JOIN vi ON vi.hook_id = ho.id AND vi.status = 'draft')
    ORDER BY estimated_performance DESC, id LIMIT 20""")
def _(t: Tables) -> DataFrame:
    used = t.hooks.join(t.videos.where("status = 'draft'").select(F.col("hook_id").alias("id")), "id", "left_semi")
    return C.next_hooks(t.hooks, used, 20).select("id", F.col("estimated_performance").cast("double").alias("score"))


@op("union_all", "SELECT id, 'text' AS kind FROM sc UNION ALL SELECT id, 'hook' FROM ho UNION ALL SELECT conv_id, role FROM conversations")
def _(t: Tables) -> DataFrame:
    texts = t.scripts.select("id", F.lit("text").alias("kind"))
    hooks = t.hooks.select("id", F.lit("hook").alias("kind"))
    turns = t.raw("conversations").select(F.col("role").alias("kind"), F.col("conv_id").alias("id"))
    return texts.unionByName(hooks).unionByName(turns)


@op("set_difference", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(t: Tables) -> DataFrame:
    buyers = t.raw("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return t.profiles.select("id").subtract(buyers)


@op("set_difference_all", """SELECT line, CAST(count(*) AS BIGINT) AS n FROM (SELECT line FROM ln WHERE id % 2 = 0 EXCEPT ALL SELECT line FROM ln WHERE id % 2 = 1) GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    lines = t.scripts.select("id", F.explode("lines").alias("line"))
    # exceptAll, written as counts per line: copies of a line meet as numbers.
    counts = lines.groupBy("line").agg(F.sum(F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("n"))
    return counts.where("n > 0")


@op("set_intersection", "SELECT line FROM ln WHERE category IN ('Mindset','Money','Health') INTERSECT SELECT line FROM ln WHERE category NOT IN ('Mindset','Money','Health')")
def _(t: Tables) -> DataFrame:
    lines = t.scripts.select("category", F.explode("lines").alias("line"))
    one = F.col("category").isin("Mindset", "Money", "Health")
    return lines.where(one).select("line").intersect(lines.where(~one).select("line"))


@op("random_pick", "SELECT id, hook_text FROM ho ORDER BY md5(id || ':42'), id LIMIT 5")
def _(t: Tables) -> DataFrame:
    return C.random_pick(t.hooks, "id", 5, seed=42).select("id", "hook_text")
