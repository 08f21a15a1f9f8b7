"""Constraint checks as data jobs: find, split off or repair rows that break a rule."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from growthloom import schemas


def enum_rule(table: str, column: str) -> Column:
    """True when the value is missing or in the declared domain."""
    return F.coalesce(F.col(column).isin(schemas.ENUMS[(table, column)]), F.lit(True))


def table_rules(table: str, columns: Sequence[str]) -> dict[str, Column]:
    """Every declared rule of a table for the columns at hand."""
    rules = {f"{c}_required": F.col(c).isNotNull() for c in schemas.REQUIRED.get(table, []) if c in columns}
    for (t, c) in schemas.ENUMS:
        if t == table and c in columns:
            rules[f"{c}_domain"] = enum_rule(t, c)
    for (t, c), (low, high, open_low) in schemas.RANGES.items():
        if t == table and c in columns:
            ok = F.lit(True)
            if low is not None:
                ok = ok & ((F.col(c) > low) if open_low else (F.col(c) >= low))
            rules[f"{c}_range"] = ok & (F.col(c) <= high) if high is not None else ok
    return rules


def table_report(df: DataFrame, table: str) -> DataFrame:
    """(rule, failures) for every declared rule of a table and its natural key.

    Row rules are counted in one pass; the key adds one grouping.
    """
    rules = table_rules(table, df.columns)
    failing = [F.count_if(~F.coalesce(ok, F.lit(True))).alias(name) for name, ok in rules.items()]
    out = df.agg(*failing).unpivot([], list(rules), "rule", "failures") if rules else None
    key = schemas.NATURAL_KEYS.get(table, [])
    if key and set(key) <= set(df.columns):
        copies = violations_unique(df, key).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("failures"))
        row = copies.select(F.lit("_".join([*key, "unique"])).alias("rule"), "failures")
        out = row if out is None else out.unionAll(row)
    return out


def check_links(tables: dict[str, DataFrame]) -> DataFrame:
    """(child, link, orphans) of every declared link between the given tables."""
    out = None
    for child, link, parent, _ in schemas.LINKS:
        if child in tables and parent in tables and link in tables[child].columns:
            lost = violations_fk(tables[child].select(link), tables[parent], link, "id")
            row = lost.agg(F.count(F.lit(1)).alias("orphans")).select(
                F.lit(child).alias("child"), F.lit(link).alias("link"), "orphans"
            )
            out = row if out is None else out.unionAll(row)
    return out


def apply_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add `failed_rules`, the names of all rules a row breaks (NULL counts as kept)."""
    broken = [F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken)))


def split_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined)."""
    marked = apply_rules(df, rules)
    return marked.where(F.size("failed_rules") == 0).drop("failed_rules"), marked.where(F.size("failed_rules") > 0)


def violations_enum(df: DataFrame, rules: dict[str, Sequence[str]]) -> DataFrame:
    """One row per broken enum value, with the rule that broke."""
    checks = {f"{c}_domain": F.col(c).isNull() | F.col(c).isin(list(v)) for c, v in rules.items()}
    return split_rules(df, checks)[1].withColumn("rule", F.explode("failed_rules")).drop("failed_rules")


def violations_range(df: DataFrame, column: str, low=None, high=None, open_low: bool = False) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((c <= low) if open_low else (c < low))
    if high is not None:
        bad = bad | (c > high)
    return df.where(bad)


def violations_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (keys with a NULL never clash)."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def violations_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, missing) from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "missing")


def violations_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_pk"), "left_anti")


def delete_cascade(child: DataFrame, gone: DataFrame, link: str) -> DataFrame:
    """Drop children of deleted parents.  `gone` has one column of keys."""
    keys = gone.toDF("_gone")
    return child.join(keys, F.col(link) == F.col("_gone"), "left_anti")


def delete_set_null(child: DataFrame, gone: DataFrame, link: str) -> DataFrame:
    """Keep children of deleted parents, without their link."""
    keys = gone.toDF("_gone").distinct()
    joined = child.join(keys, F.col(link) == F.col("_gone"), "left")
    return joined.withColumn(link, F.when(F.col("_gone").isNull(), F.col(link))).drop("_gone")


def delete_restricted(gone: DataFrame, child: DataFrame, link: str) -> DataFrame:
    """Parents that may not be deleted, with the number of rows that hold them."""
    keys = gone.toDF("id").distinct()
    held = child.groupBy(F.col(link).alias("id")).agg(F.count(F.lit(1)).alias("holders"))
    return keys.join(held, "id")


def delete_with_rules(tables: dict[str, DataFrame], parent: str, gone: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Delete rows of `parent` and treat its children as declared.

    Returns the tables after the delete, and the ids that could not go with the
    number of rows that hold them.  Children that cascade take their own children
    with them.
    """
    out = dict(tables)
    links = [(c, col, rule) for c, col, p, rule in schemas.LINKS if p == parent and c in out and col in out[c].columns]
    held = None
    for child, col, rule in links:
        if rule == "restrict":
            rows = delete_restricted(gone, out[child], col)
            held = rows if held is None else held.unionByName(rows)
    ids = gone.toDF("id").distinct()
    if held is None:
        refused = ids.where(F.lit(False)).withColumn("holders", F.lit(0).cast("long"))
    else:
        refused = held.groupBy("id").agg(F.sum("holders").alias("holders"))
        ids = ids.join(refused, "id", "left_anti")
    out[parent] = out[parent].join(ids, "id", "left_anti").select(*out[parent].columns)
    for child, col, rule in links:
        if rule == "set null":
            out[child] = delete_set_null(out[child], ids, col).select(*out[child].columns)
        elif rule == "cascade":
            if any(p == child for _, _, p, _ in schemas.LINKS) and "id" in out[child].columns:
                below = out[child].join(ids.toDF("_gone"), F.col(col) == F.col("_gone"), "left_semi").select("id")
                out, _ = delete_with_rules(out, child, below)
            else:
                out[child] = delete_cascade(out[child], ids, col)
    return out, refused


def import_hooks(new: DataFrame, existing: DataFrame, categories: Sequence[str]) -> DataFrame:
    """New hooks that are not there yet and have a known category; scores clamped to 0-10."""
    fresh = new.where(F.col("category").isin(list(categories)))
    known = existing.select(F.col("hook_text").alias("_known"))
    fresh = fresh.join(known, F.col("hook_text") == F.col("_known"), "left_anti")
    rest = [c for c in fresh.columns if c != "hook_text"]
    first = fresh.groupBy("hook_text").agg(F.min_by(F.struct(*rest), "id").alias("_r")).select("hook_text", "_r.*")
    score = F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.col("estimated_performance").cast("double")))
    return first.withColumn("estimated_performance", score)
