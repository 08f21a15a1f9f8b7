"""Scripts -> production packages and the manifest."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.functions import exprs as X
from growthloom.operators import content as C


def shot_list(scripts: DataFrame, visuals: str = "visuals") -> DataFrame:
    """One row per script line: times, overlay and search terms.  Needs id, category, lines."""
    timed = C.timecodes(scripts, ["id", "category"], "lines", visuals)
    shots = timed.withColumn("text_overlay", X.overlay(F.coalesce("visual", F.lit(""))))
    # The empty suffix keeps Spark from folding lower(upper(x)) into lower(x), which
    # differs for letters such as the German sharp s.
    term = F.lower(F.concat("text_overlay", F.lit("")))
    return shots.select(
        "id", "line_no", "line", "start_s", "end_s", "text_overlay",
        F.array(term, F.lower("category"), F.lit("cinematic"), F.lit("minimalist")).alias("search_terms"),
    )


def packages(scripts: DataFrame, brand: str | None = None) -> DataFrame:
    """One nested package per script; its lists hold the lines of one input row only."""
    timed = C.with_timed_lines(scripts.where(F.size("lines") > 0), "lines", "_timed")
    nested = F.transform("_timed", lambda x: F.struct(
        x["line_no"].alias("line_no"), x["start_s"].alias("start_s"), x["end_s"].alias("end_s"), x["line"].alias("line"),
        X.overlay(x["line"]).alias("text_overlay")))
    meta = timed.select(
        "id", "category", "score", "hook_text", nested.alias("lines"), F.element_at("_timed", -1)["end_s"].alias("total_s")
    )
    return meta.withColumns(
        {
            "priority": X.priority("score"),
            "hashtags": F.create_map(*[x for p in X.PLATFORM_HASHTAGS for x in (F.lit(p), X.hashtags(F.lit(p), brand))]),
        }
    )


def manifest_lines(numbered: DataFrame) -> DataFrame:
    """Markdown table row of every manifest entry, with its order number."""
    cells = [F.col(c).cast("string") for c in ("id", "hook_text", "category", "score", "priority", "order_no")]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c, F.lit("")) for c in cells]), F.lit(" |"))
    return numbered.select("order_no", row.alias("line"))


def manifest(packaged: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Hook, score, priority and overall order of every package."""
    rows = packaged.select("id", "hook_text", "category", "score", "priority")
    return C.production_order(rows, order)
