"""Mix sources to target weights by hash-random order and distributed prefix sums.

Every document gets a random key by hashing; the keys of a source are cut into ranges, the words of each range are summed,
and a running sum over the ranges gives each one its offset. Inside a range a window sorts by key. So no task ever holds
more than one range of one source, however large the source is, and a rerun cuts at the same documents.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthloom.llm.rows import packed, unpacked

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2  # times a source's words
RANGE_ROWS = 20_000


def words_in(text: Column) -> Column:
    """Number of runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Words to take from each source.

    `sizes` has one row per source: source, source_size. The sources, by code point and null last, weigh `weights` in
    turn and share `share` of all words; a target stops at `most` times its source, and what it leaves is shared again
    by weight. That ends where all open sources have one quotient of target and weight: with the sources sorted by the
    quotient at which each is full, it is the first one that does not fill its source.

    The windows here see one row per source, never documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_full = W.orderBy("__full", "__rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sizes.withColumn("__rank", F.row_number().over(by_name))
        .withColumn("__weight", F.element_at(cycle, ((F.col("__rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("__cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("__full", F.col("__cap") / F.col("__weight"))
        .withColumn("__total", F.sum("source_size").over(W.partitionBy()) * F.lit(float(share)))
        .withColumn("__left", F.col("__total") - F.sum("__cap").over(by_full.rowsBetween(W.unboundedPreceding, 0)) + F.col("__cap"))
        .withColumn("__open", F.sum("__weight").over(by_full.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("__level", F.col("__left") / F.col("__open"))
        .withColumn("__level", F.min(F.when(F.col("__level") <= F.col("__full"), F.struct("__full", "__level"))).over(W.partitionBy()))
    )
    level = F.coalesce(F.col("__level.__level"), F.lit(float("inf")))
    target = F.least(F.col("__cap"), F.greatest(level * F.col("__weight"), F.lit(0.0)))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: int = 10, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Every document with its words, its source's words and target, how often the mix holds it, and the words it takes.

    Adds size, source_size, target, copies, taken; other columns stay (names that begin with `__` are reserved, the five
    added names are replaced). A source is repeated whole as often as its target allows; of the rest, the documents whose
    middle lies below the budget are taken, so a source misses its target by half a document at most. Null text has no
    words; a null source is a source of its own; equal rows share their fate or lie side by side in the order; documents
    without words take 0 words. No document is held more than twice with the given limits.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    ranges = 64 + docs.count() // RANGE_ROWS
    u = F.coalesce(F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))), F.lit(10)), 16, 10).cast("long"), F.lit(0))
    keyed = docs.withColumns({
        "__source": _source_key(F.col("source")), "size": words_in(F.col("text")), "__key": u,
        "__range": F.floor(u * F.lit(ranges) / F.lit(1 << 40)).cast("long"),
    })
    sums = keyed.groupBy("__source", "__range").agg(F.first("source").alias("source"), F.sum("size").alias("__words"))
    goal = targets(sums.groupBy("__source").agg(F.first("source").alias("source"), F.sum("__words").alias("source_size"))
                   .select("source", "source_size"), weights, share, most)
    before = W.partitionBy("__source").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    cuts = sums.select("__source", "__range", F.coalesce(F.sum("__words").over(before), F.lit(0)).alias("__before")).join(
        goal.select(_source_key(F.col("source")).alias("__source"), "source_size", "target"), "__source")
    inside = W.partitionBy("__source", "__range").orderBy("__key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = keyed.join(cuts, ["__source", "__range"]).withColumn(
        "__before", F.col("__before") + F.sum("size").over(inside) - F.col("size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.col("target") - whole * F.col("source_size")
    more = (whole < F.lit(int(most))) & (F.col("__before") + F.col("size") / 2 <= rest)
    copies = whole + more.cast("int")
    return placed.withColumns({"copies": copies, "taken": (copies * F.col("size")).cast("long")}).drop(
        "__source", "__key", "__range", "__before")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is held, with its own columns, whatever their names."""
    needed = ["doc_id", "text", "source"]
    out = mix(packed(docs, needed), **options).where("copies > 0")
    return out.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(*unpacked(out, docs.columns, needed))
