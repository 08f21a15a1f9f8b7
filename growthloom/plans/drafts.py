"""Hooks and templates -> prompts and draft scripts; completions -> script rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.functions import exprs as X


def build_prompt(hooks: DataFrame, templates: DataFrame, voice: str, spec: str) -> DataFrame:
    """One prompt per hook and its template.  `templates` has template_no, name, point1..3, cta."""
    joined = hooks.join(templates, "template_no")
    lines = [
        F.lit(voice), F.lit(spec),
        F.concat(F.lit("Template: "), F.col("name")),
        F.concat(F.lit("Hook: "), F.col("hook_text")),
        *[F.concat(F.lit(f"Point {i}: "), F.coalesce(f"point{i}", F.lit(""))) for i in (1, 2, 3)],
        F.concat(F.lit("CTA: "), F.coalesce("cta", F.lit(""))),
        F.lit("One sentence per line. 130-180 words."),
    ]
    return joined.select("id", "template_no", F.concat_ws("\n", *lines).alias("prompt"))


def ingest_completions(completions: DataFrame, text: str, keys: list[str], asked: str | None = None) -> DataFrame:
    """Script rows from model answers; an answer without a hook keeps the one asked for."""
    hook = F.nullif(F.col("c.hook"), F.lit(""))
    hook = F.coalesce(hook, F.col("_asked"), F.lit("")) if asked else F.coalesce(hook, F.lit(""))
    extra = [F.col(asked).alias("_asked")] if asked else []
    return completions.select(*keys, *extra, X.parse_completion(text).alias("c")).select(
        *keys, hook.alias("hook_text"), F.col("c.body").alias("body_text"), F.col("c.cta").alias("cta_text"),
        F.col("c.word_count").alias("word_count"),
    )


def count_usage(hooks: DataFrame, used: DataFrame, as_of) -> DataFrame:
    """Usage counter and last use of every hook after the scripts in `used` (hook_id) are made."""
    old = F.col("last_used_at") if "last_used_at" in hooks.columns else F.lit(None)
    n = used.groupBy(F.col("hook_id").alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    joined = hooks.join(n, "id", "left")
    return joined.withColumns(
        {
            "times_used": F.col("times_used") + F.coalesce("_n", F.lit(0)),
            "last_used_at": F.when(F.col("_n").isNotNull(), as_of).otherwise(old),
        }
    ).drop("_n")


def fill_script(drafts: DataFrame, structure: str, brand: str) -> DataFrame:
    """Draft lines from a template text with {topic}, {category} and {brand}."""
    body = X.fill(structure, {"topic": X.topic("hook_text"), "category": "category", "brand": F.lit(brand)})
    return drafts.withColumn("body_text", F.concat_ws("\n", "hook_text", body))
