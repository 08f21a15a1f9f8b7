"""Benchmark passages in training text, by a positional inverted index.

The index holds one posting per token: term, row, position. Test phrases are looked up from their rarest terms: the postings
of the rarest one, less its offset in the phrase, are the places where the phrase may begin; the lists of the next rarest
terms, less their offsets, are intersected with them. What is left is read back in the text.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.session import stage

WINDOW = 10
DEPTH = 3  # terms of a phrase whose lists are intersected before the text is read
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words in order, A-Z lower-cased; null has none."""
    parts = F.split(F.translate(text, UPPER, LOWER), NOT_WORD)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def row_key() -> Column:
    """Identifies a row's id and text; equal rows share it, and the check against the text forgives a collision."""
    return F.xxhash64("doc_id", "text")


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of (item_id, text): words, n, items (ids as strings), phrase (a number).

    A window is `window` consecutive words; an item with fewer words, but not none, is one window. Items with null id are
    named by the empty string; items that repeat an id count once.
    """
    split = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = split.where(F.size("w") > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("words").alias("phrase"), "words", F.size("words").alias("n"), "items")


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings (term, row, at) of every token of (doc_id, text), or of those in `terms` (one column, term, distinct).

    Written to the shared folder, one segment per part of the documents; nothing is shuffled.
    """
    tokens = docs.where("text is not null").select(
        row_key().alias("row"), F.posexplode(F.split(F.translate("text", UPPER, LOWER), NOT_WORD)).alias("at", "word"))
    # A text that begins with a separator has an empty first part: all its positions are one higher, which no phrase sees.
    if terms is None:
        return stage(tokens.where("word <> ''").select(F.xxhash64("word").alias("term"), "row", "at"), "postings")
    wanted = terms.select(F.col("term").alias("word"))
    return stage(tokens.join(wanted, "word").select(F.xxhash64("word").alias("term"), "row", "at"), "postings")


def ranked_terms(found: DataFrame, index: DataFrame, depth: int) -> DataFrame:
    """(phrase, rank, term, offset): the `depth` rarest terms of each phrase by tokens in the index, rarest first."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("tokens"))
    split = found.select("phrase", F.posexplode("words").alias("offset", "word")).select(
        "phrase", "offset", F.xxhash64("word").alias("term"))
    rated = split.join(counts, "term", "left").groupBy("phrase").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("tokens", F.lit(0)).alias("tokens"), "offset", "term"))).alias("all"))
    first = F.slice("all", 1, depth)
    return rated.select("phrase", F.posexplode(first).alias("rank", "t")).select("phrase", "rank", "t.term", "t.offset")


def candidates(index: DataFrame, found: DataFrame, depth: int = DEPTH, slop: int = 0) -> DataFrame:
    """(row, phrase, start) where the `depth` rarest terms of a phrase stand at their offsets, or within `slop` of them."""
    ranked = stage(ranked_terms(found, index, depth), "ranked-terms")
    most = found.agg(F.max("n")).first()[0] or 0

    def places(rank: int) -> DataFrame:
        return index.join(ranked.where(F.col("rank") == rank).drop("rank"), "term").select(
            "row", "phrase", (F.col("at") - F.col("offset")).alias("start"))

    out = places(0)
    short = found.select("phrase", "n")
    for rank in range(1, min(depth, most)):
        other = places(rank)
        if slop:
            # Starts in bins of slop + 1: partners lie in the same bin or in one beside it.
            other = other.select("row", "phrase", F.col("start").alias("other"), F.explode(
                F.array(*[F.floor(F.col("start") / (slop + 1)) + d for d in (-1, 0, 1)])).alias("bin"))
            hit = out.withColumn("bin", F.floor(F.col("start") / (slop + 1))).join(other, ["row", "phrase", "bin"])
            hit = hit.where(F.abs(F.col("start") - F.col("other")) <= slop).select("row", "phrase", "start").distinct()
        else:
            hit = out.join(other, ["row", "phrase", "start"])
        done = out.join(short.where(F.col("n") <= rank).select("phrase"), "phrase", "left_semi").select("row", "phrase", "start")
        out = hit.unionByName(done)
    return out


def proximity(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 3) -> DataFrame:
    """(row, item, start): places where every term of a window stands within `slop` words of its place in the window."""
    found = phrases(items, window)
    return candidates(index, found, depth=window, slop=slop).join(found.select("phrase", F.explode("items").alias("item")), "phrase").select(
        "row", "item", "start").distinct()


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """Documents with n_words, n_hit, n_items, items (sorted) and contaminated; other columns stay.

    A word is hit inside any exact occurrence of a window. Null texts have no words; equal rows get equal results; empty
    documents or benchmark tables give no hits.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "n_hit", "n_items", "items", "contaminated")]
    found = stage(phrases(items, window), "phrases")
    terms = stage(found.select(F.explode("words").alias("term")).distinct().coalesce(8), "terms")  # its size on disk decides the join
    index = build_index(docs, terms)
    places = candidates(index, found, depth).join(found, "phrase")
    hits = places.groupBy("row").agg(F.collect_set(F.struct("start", "n", "words", "items")).alias("__hits"))
    # Positions of the index count an empty first part; so do these.
    parts = F.split(F.translate("text", UPPER, LOWER), NOT_WORD)
    out = docs.select(*columns).withColumn("__row", row_key()).join(hits.withColumnRenamed("row", "__row"), "__row", "left")
    exact = F.when(F.col("__hits").isNotNull(), F.filter("__hits", lambda h: F.slice(parts, h["start"] + 1, h["n"]) == h["words"]))
    out = out.withColumn("__n", F.coalesce(F.size(F.array_remove(parts, "")), F.lit(0))).withColumn("__exact", exact)
    covered = F.array_distinct(F.flatten(F.transform("__exact", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform("__exact", lambda h: h["items"]))))
    none = F.array().cast("array<string>")
    return out.select(
        *columns, F.greatest(F.col("__n"), F.lit(0)).cast("long").alias("n_words"),
        F.greatest(F.coalesce(F.size(covered), F.lit(0)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(names, none).alias("items"),
    ).select(*columns, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))
