"""Drop lines that many documents share, by levelled sorted runs of line hashes.

Documents come in batches. A run is a table of line hashes, sorted by hash, with the documents counted so far and the
document that keeps the line. A batch is merge-joined with the runs: lines no run knows (the anti join) become the batch's
own run, lines some run knows add to a table of repeats. When a level holds FANOUT runs they are merged into one run of the
next level. Batches are taken from the largest doc_id down, so the document that first brings a line is the one to keep it,
and only repeats have to be looked at again.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.session import stage

BATCHES = 4
FANOUT = 2
LEAST_CHARS = 40
LEAST_DOCS = 5
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


class Runs:
    """Levelled sorted runs: `levels[i]` holds fewer than FANOUT tables of (one, two, docs, keeper), sorted by hash."""

    def __init__(self, fanout: int = FANOUT):
        self.levels: list[list[DataFrame]] = []
        self.fanout = fanout

    def tables(self) -> list[DataFrame]:
        return [t for level in self.levels for t in level]

    def all(self) -> DataFrame | None:
        found = self.tables()
        out = found[0] if found else None
        for t in found[1:]:
            out = out.unionByName(t)
        return out

    def add(self, run: DataFrame, level: int = 0) -> None:
        """Write a run, sorted; merge a full level into one run of the next."""
        run = stage(run.sortWithinPartitions("one", "two"), f"line-run-{level}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = full[0]
            for t in full[1:]:
                merged = merged.unionByName(t)
            self.add(merged.groupBy("one", "two").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper")), level + 1)

    def take(self, batch: DataFrame) -> DataFrame | None:
        """Add a batch of (one, two, docs, keeper), one row per line; returns its lines that a run already knew."""
        known = self.all()
        if known is None:
            self.add(batch)
            return None
        batch = stage(batch, "line-batch")
        seen = known.select("one", "two").hint("merge")
        again = batch.join(seen, ["one", "two"], "left_semi")
        self.add(batch.join(seen, ["one", "two"], "left_anti"))
        return again


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, row, at, one, two): position and 128-bit key hash of every line of at least `least_chars` code points."""
    lines = F.posexplode(F.split(F.col("text"), "\n", -1)).alias("at", "line")
    found = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("row"), lines)
    found = found.where(F.length("line") >= least_chars).select("doc_id", "row", "at", F.btrim("line", F.lit(SPACE)).alias("line"))
    key = F.translate("line", UPPER, LOWER)
    return found.where(F.length("line") >= least_chars).select(
        "doc_id", "row", "at", F.xxhash64(key).alias("one"), F.xxhash64(F.lit(2), key).alias("two"))


def repeated_lines(hashes: DataFrame, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(one, two, keeper) of the lines that at least `least_docs` documents hold."""
    if batches > 1:
        parts = hashes.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    else:
        parts = []
    runs, repeats = Runs(fanout), None
    bounds = [None, *sorted(set(parts)), None]
    for low, high in reversed(list(zip(bounds[:-1], bounds[1:]))):
        rows = hashes
        if low is not None:
            rows = rows.where(F.col("doc_id") > low)
        if high is not None:
            rows = rows.where(F.col("doc_id") <= high)
        batch = rows.groupBy("one", "two").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
        again = runs.take(batch)
        if again is not None:
            repeats = again if repeats is None else repeats.unionByName(again)
    counted = runs.all()
    if repeats is not None:
        counted = counted.unionByName(repeats)
    return counted.groupBy("one", "two").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper")).where(
        F.col("docs") >= least_docs).select("one", "two", "keeper")


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """Documents with n_lines, n_dropped and kept (the text that stays); other columns stay, text as it was.

    A line that at least `least_docs` documents hold stays only where the largest doc_id is. Documents are told apart by
    doc_id: rows that repeat one count as one document, and all of them keep the line if it is the largest. A null or empty
    text is one empty line. Rows with null doc_id hold no document's place: they count for nothing and lose nothing.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    hashes = stage(line_hashes(docs, least_chars), "line-hashes")
    repeated = repeated_lines(hashes, least_docs, batches)
    lost = (hashes.join(repeated, ["one", "two"]).where(F.col("doc_id") < F.col("keeper"))
            .groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_set("at").alias("__lost")))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n", -1)
    out = docs.select(*columns).join(lost, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__row")), "left")
    kept = F.array_join(F.filter(lines, lambda line, at: ~F.array_contains("__lost", at)), "\n")
    return out.select(
        *columns, F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("__lost"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__lost").isNull(), text).otherwise(kept).alias("kept"))
