"""Licences of files: TF-IDF cosine of licence statements to templates, inherited from the nearest directory above.

A statement is a line that holds one of a few cue words; every line of every file is looked at. The weight of a term follows
from the statements of all files. A file without a statement of its own takes the licence of the licence file in the nearest
directory at or above its own, found by joining directories with their ancestors.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.session import stage

# The usual short statements of common licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license: redistribution and use in source and binary forms"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, all copyright is waived under CC0 1.0"),
]
CUES = r"(?i)licen[cs]e|redistribution and use|all copyright is waived"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
LEAST_COSINE = 0.6


def terms(line: Column) -> Column:
    """Words and pairs of neighbouring words."""
    words = F.regexp_extract_all(F.lower(line), F.lit(r"([a-z0-9]+(?:[.-][a-z0-9]+)*)"))
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, F.filter(pairs, lambda p: p.contains(" ")))


def templates(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or TEMPLATES, "license string, text string")


def statements(files: DataFrame) -> DataFrame:
    """(path, at, line) of every licence statement in the whole texts of (path, text)."""
    lines = F.posexplode(F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line"))), lambda x: x["line"].rlike(CUES)))
    return files.where(F.col("text").rlike(CUES)).select("path", lines.alias("n", "x")).select("path", "x.at", "x.line")


def matches(found: DataFrame, known: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(line, license, score): the template nearest to each distinct line, from `least` on; ties to the first name."""
    lines = stage(found.groupBy("line").agg(F.count(F.lit(1)).alias("uses")), "statements")
    count = lines.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    used = lines.select("line", "uses", F.explode(F.array_distinct(terms(F.col("line")))).alias("term")).groupBy("term").agg(F.sum("uses").alias("df"))
    given = known.select("license", F.explode(terms(F.col("text"))).alias("term")).groupBy("license", "term").agg(F.count(F.lit(1)).alias("tf"))
    counted = lines.select("line", F.explode(terms(F.col("line"))).alias("term")).groupBy("line", "term").agg(F.count(F.lit(1)).alias("tf"))

    def weighted(rows: DataFrame) -> DataFrame:
        return rows.join(used, "term", "left").withColumn("w", F.col("tf") * (F.log((F.lit(count) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1)).drop("tf", "df")

    line_terms, known_terms = weighted(counted), weighted(given)
    norms = line_terms.groupBy("line").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    known_norms = known_terms.groupBy("license").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("known_norm"))
    dots = line_terms.join(known_terms.withColumnRenamed("w", "kw"), "term").groupBy("line", "license").agg(F.sum(F.col("w") * F.col("kw")).alias("dot"))
    cosine = dots.join(norms, "line").join(known_norms, "license").select("line", "license", F.round(F.col("dot") / F.col("norm") / F.col("known_norm"), 9).alias("score"))
    best = cosine.where(F.col("score") >= least).groupBy("line").agg(F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("b"))
    return best.select("line", "b.license", (-F.col("b.less")).alias("score"))


def directory(path: Column) -> Column:
    """The part before the last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, known: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(path, license, score, line, own, from_path) for every distinct path of (path, text).

    `own` tells a licence stated in the file (the best of its statements, the first of equals) from an inherited one, whose
    licence file is `from_path`. Files without either have nulls. Rows without path are left out, rows that repeat a path
    are one file; null and empty texts state nothing.
    """
    files = files.where("path is not null")
    found = stage(statements(files), "found")
    named = found.join(matches(found, known, least), "line")
    own = stage(named.groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("less"), "at", "license")).alias("b")).select(
        "path", "b.license", (-F.col("b.less")).alias("score"), F.col("b.at").alias("line")), "own-licenses")
    granting = own.where(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE)).groupBy(directory(F.col("path")).alias("above")).agg(
        F.min(F.struct((-F.col("score")).alias("less"), F.col("path").alias("from_path"), "license")).alias("g"))
    paths = files.select("path").distinct().withColumn("dir", directory(F.col("path")))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct((F.size(parts) - n).alias("up"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")))
    chain = paths.select("dir").distinct().select("dir", F.inline(above))
    nearest = chain.join(granting, "above").groupBy("dir").agg(F.min(F.struct("up", "g")).alias("n")).select(
        "dir", F.col("n.g.license").alias("given"), F.col("n.g.from_path").alias("given_by"), (-F.col("n.g.less")).alias("given_score"))
    out = paths.join(own, "path", "left").join(nearest, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        "path", F.coalesce("license", "given").alias("license"), F.when(mine, F.col("score")).otherwise(F.col("given_score")).alias("score"),
        "line", F.when(F.coalesce("license", "given").isNotNull(), mine).alias("own"), F.when(~mine, F.col("given_by")).alias("from_path"))
