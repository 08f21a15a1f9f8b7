"""Readers for JSON and Markdown content files and for message inboxes.

A document is a file, or a line with `lines=True` for folders that hold many
documents per file; the parsers work on any text column.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from growthloom.functions import exprs as X

HOOK_FILE = "hooks array<struct<text: string, category: string, trigger: string, estimated_performance: double>>"
GROUPED_FILE = "categories array<struct<category: string, description: string, hooks: array<string>>>"
SCRIPT_FILE = """array<struct<id: string, hook: string, template: string, pillar: string, performance_score: double,
    voiceover: struct<model: string, settings: struct<stability: double, clarity: double>, tone: string,
    script: array<string>>, visuals: array<struct<line: bigint, b_roll: string, text_overlay: string, position: string>>,
    cta: struct<text: string, placement: string>, thumbnail_concept: string>>"""


def _files(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    texts = spark.read.text(path, wholetext=not lines)
    return texts.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


def parse_hooks(df: DataFrame, body: str = "body", keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """{"hooks": [...]} documents to one row per hook, with its position."""
    parsed = df.select(*keep, F.from_json(body, HOOK_FILE)["hooks"].alias("_h"))
    return parsed.select(*keep, F.posexplode("_h").alias("ordinal", "_x")).select(*keep, "ordinal", "_x.*")


def read_hooks(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return parse_hooks(_files(spark, path, lines))


def parse_grouped_hooks(df: DataFrame, body: str = "body", keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """{"categories": [{category, hooks: [...]}]} to one row per hook."""
    groups = df.select(*keep, F.explode(F.from_json(body, GROUPED_FILE)["categories"]).alias("_g"))
    return groups.select(
        *keep, F.col("_g.category").alias("category"), F.posexplode("_g.hooks").alias("ordinal", "text")
    )


def read_grouped_hooks(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return parse_grouped_hooks(_files(spark, path, lines))


def parse_scripts(df: DataFrame, body: str = "body", keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """A JSON array of scripts to one row per script."""
    return df.select(*keep, F.explode(F.from_json(body, SCRIPT_FILE)).alias("_s")).select(*keep, "_s.*")


def read_scripts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """All batch files a glob names."""
    return parse_scripts(_files(spark, path, lines))


def explode_lines(df: DataFrame, key: str, lines: str) -> DataFrame:
    """An array of lines to (key, line_no from 1, line)."""
    return df.select(key, F.posexplode(lines).alias("_p", "line")).select(
        key, (F.col("_p") + 1).cast("long").alias("line_no"), "line"
    )


def parse_sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """Markdown text with `## n. title` headings to one row per numbered section."""
    parts = df.select(key, F.explode(F.split(F.concat(F.lit("\n"), F.col(text)), r"\n(?=## \d+\. )")).alias("_s"))
    sections = parts.where(F.col("_s").rlike(r"^## \d+\. "))

    def field(label: str):
        found = F.regexp_extract("_s", rf"\*\*{label}:\*\* ([^\n]*)", 1)
        return F.nullif(found, F.lit(""))

    return sections.select(
        key,
        F.regexp_extract("_s", r"^## (\d+)\. ", 1).cast("long").alias("section_no"),
        F.regexp_extract("_s", r"^## \d+\. ([^\n]*)", 1).alias("name"),
        field("Hook").alias("hook"),
        field("Point 1").alias("point1"),
        field("Point 2").alias("point2"),
        field("Point 3").alias("point3"),
        F.nullif(F.regexp_extract("_s", r'\*\*CTA:\*\* "([^"]*)"', 1), F.lit("")).alias("cta"),
    )


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    return parse_sections(_files(spark, path), "file", "body")


def parse_messages(df: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """Typed message columns in `msg`; a body that does not parse is kept in `_corrupt_record`.

    The parse sits in a one-element generator: filters on message fields then stay
    above it, where they would otherwise be pushed down and parse every body twice.
    """
    full = f"{schema}, _corrupt_record string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return df.select("*", F.explode(F.array(F.from_json(body, full, options))).alias("msg"))


def read_inbox(spark: SparkSession, path: str, schema: str, stream: bool = False) -> DataFrame:
    """JSON-lines message files as a batch or a stream, with bad records kept."""
    reader = spark.readStream if stream else spark.read
    raw = reader.schema("value string").text(path).withColumnRenamed("value", "body")
    return parse_messages(raw, schema)


def page_view_columns(df: DataFrame, url: str = "url") -> DataFrame:
    """Host, path and the five campaign parameters of a URL column."""
    return df.withColumns(X.parse_url(url))
