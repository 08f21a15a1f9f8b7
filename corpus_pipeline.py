"""A corpus through five operators: language, near copies, benchmark passages, mixture, shards."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.llm import contamination, jaccard, language, mixing, shards
from growthloom.llm.rows import packed, unpacked
from growthloom.session import stage

WORDS, PERCENT = 5, 80  # near copies: shingles of five words, Jaccard similarity from 0.8


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; null texts and texts without a letter go. Equal scores go to the first language by name."""
    model = language.fit(docs.where(~language.held_out("doc_id", 3, 1)))
    found = language.identify(packed(docs, ["text"]), model).where("lang_pred <> 'und'")
    return found.select(*unpacked(found, docs.columns, ["text"]))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id. Rows without doc_id stay, a repeated row once.

    Rows of one doc_id with different texts are documents of their own here: a hash of id and text names them. Of equal
    ids and texts the row whose other columns hash lowest stays.
    """
    needed = ["doc_id", "text"]
    rows = packed(docs, needed)
    named = rows.where("doc_id is not null").withColumn("__key", F.xxhash64("doc_id", "text"))
    found = jaccard.jaccard_components(named.select(F.col("__key").alias("doc_id"), "text"), words=WORDS, percent=PERCENT)
    group = found.select(F.col("doc_id").alias("__key"), "component_id").distinct()
    ids = named.select("__key", "doc_id").distinct().join(group, "__key")
    first = ids.groupBy("component_id").agg(F.min(F.struct("doc_id", "__key"))["__key"].alias("__key")).select("__key")
    # Repeated rows fold map-side: a row that a third of the table repeats is no task's burden.
    kept = named.join(first, "__key", "left_semi").groupBy("__key").agg(
        F.min_by(F.struct(*needed, "__rest"), F.xxhash64(F.to_json("__rest"))).alias("__row")).select("__row.*")
    return kept.unionByName(rows.where("doc_id is null")).select(*unpacked(kept, docs.columns, needed))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = contamination.contaminated(packed(docs, ["doc_id", "text"]), items).where("not contaminated")
    return clean.select(*unpacked(clean, docs.columns, ["doc_id", "text"]))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated or left out to meet each source's target."""
    return mixing.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard and slot; equal texts share a shard, equal loads go to the smaller shard.

    An input column named shard or slot goes out as input_shard or input_slot.
    """
    put = shards.shard(packed(docs, ["doc_id", "text"]))
    own = [c.alias(f"input_{n}") if n in ("shard", "slot") else c
           for n, c in zip(docs.columns, unpacked(put, docs.columns, ["doc_id", "text"]), strict=True)]
    return put.select(*own, "shard", "slot")


STAGES = [("language ID", languages), ("near copies", near_copies), ("decontamination", decontamination),
          ("mixing", mixture), ("sharding", sharding)]
ORACLE_SQL = None  # fitted models, graph components and a heap: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
