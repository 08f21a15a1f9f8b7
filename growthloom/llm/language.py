"""Language of a text: known words first, then ever shorter character n-grams."""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.session import stage

SAMPLE = 5_000  # labelled documents per language that the model is fitted on, at most
SAMPLE_ALL = 50_000  # and over all languages: what bounds the model, whose entries are all words and n-grams of the sample
ORDERS = (5, 4, 3, 2, 1)  # lengths of the n-grams, in the order they are tried
FLOOR = 0.1  # count given to a language in which an entry was not seen
SURE = 50  # words from which more text adds no confidence
CACHE = 300_000  # unknown words whose scores a task remembers at once
AT_ONCE = 50_000  # words from which the texts gathered so far are scored
WORD = re.compile(r"[^\W\d_]+")


class Model:
    """Log frequencies per language of words and n-grams: one row of `table` each, in the order of `grams`."""

    def __init__(self, languages: list[str], grams: dict[int, pa.Array], table: np.ndarray):
        self.languages, self.grams, self.table = languages, grams, table

    @classmethod
    def counted(cls, languages: list[str], counts: dict[int, tuple[pa.Array, np.ndarray]]) -> Model:
        """From the entries of every order (0: whole words) and their counts, one column per language."""
        parts = []
        for grams, table in counts.values():
            floored = table.astype(np.float32) + np.float32(FLOOR)
            parts.append(np.log(floored / floored.sum(axis=0, dtype=np.float64).astype(np.float32)))
        return cls(languages, {n: grams for n, (grams, _) in counts.items()}, np.concatenate(parts))

    @cached_property
    def known(self) -> dict[int, dict[str, int]]:
        """Order -> entry -> row. Made where texts are scored; the driver holds Arrow arrays only."""
        out, row = {}, 0
        for n, grams in self.grams.items():
            out[n] = dict(zip(grams.to_pylist(), range(row, row + len(grams))))
            row += len(grams)
        return out

    def backoff(self, word: str) -> list[int]:
        """Rows of an unknown word's known n-grams, of the greatest length that has any."""
        padded = f" {word} "
        for n in ORDERS:
            rows = self.known[n]
            hits = [rows[g] for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in rows]
            if hits:
                return hits
        return []

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of unknown words: the mean of the rows found for each, zeros where there are none."""
        hits = [self.backoff(w) for w in words]
        counts = np.fromiter(map(len, hits), dtype=np.int64, count=len(hits))
        rows = np.fromiter(chain.from_iterable(hits), dtype=np.int64, count=int(counts.sum()))
        sums = summed(self.table, rows, np.repeat(np.arange(len(hits)), counts), len(hits))
        return (sums / np.maximum(counts, 1)[:, None]).astype(np.float32)


def summed(table: np.ndarray, rows: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sums of the given rows by group."""
    out = np.empty((groups, table.shape[1]))
    for i in range(table.shape[1]):
        out[:, i] = np.bincount(group, weights=table[rows, i], minlength=groups)
    return out


def fit(labelled: DataFrame, sample: int = SAMPLE, sample_all: int = SAMPLE_ALL) -> Model:
    """Fit on rows of (doc_id, text, lang): about `sample` documents per language and `sample_all` in all, picked by hash.

    Words and n-grams are counted on Spark, all of the sample's, and come to the driver as one row per entry with an array of
    counts by language. A table without usable rows gives a model without languages.
    """
    rows = labelled.where("lang is not null and text is not null and doc_id is not null")
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(found)
    if not found:
        return Model([], {n: pa.array([], pa.string()) for n in (0, *ORDERS)}, np.zeros((0, 0), dtype=np.float32))
    each = min(sample, max(1, sample_all // len(found)))
    cut = F.create_map(*[F.lit(x) for lang, n in found.items() for x in (lang, min(1.0, each / n))])[F.col("lang")]
    picked = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < cut)
    words = picked.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))).alias("gram"))
    counts = F.array(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)) for x in languages])
    words = stage(words.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "language-words")
    padded = F.concat(F.lit(" "), F.col("gram"), F.lit(" "))
    counted = words.select(F.lit(0).alias("order"), "lang", "gram", "n")
    for n in ORDERS:
        length = F.lit(n)
        grams = F.transform(F.sequence(F.lit(1), F.length("gram") + 3 - n), lambda i: F.substring(padded, i, length))  # noqa: B023
        counted = counted.unionByName(words.where(F.length("gram") + 3 > n).select(length.alias("order"), "lang", F.explode(grams).alias("gram"), "n"))
    table = counted.groupBy("order", "gram").agg(counts.cast("array<int>").alias("counts"))
    table = stage(table, "language-counts")
    out = {}
    for n in (0, *ORDERS):  # order by order, so that the driver holds one table's batches beside the model
        part = table.where(F.col("order") == n).select("gram", "counts").toArrow().combine_chunks()
        lists = part["counts"].combine_chunks() if len(part) else pa.array([], pa.list_(pa.int32()))
        grams = part["gram"].combine_chunks() if len(part) else pa.array([], pa.string())
        out[n] = (grams, lists.flatten().to_numpy(zero_copy_only=False).reshape(len(part), len(languages)))
    return Model.counted(languages, out)


class Scores:
    """Scores of the model's words and of those a task has met: a row number per word, the rows in one growing array."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.rows = dict(self.model.known[0])
        self.table, self.used = self.model.table, len(self.model.table)

    def numbers(self, words: list[str]) -> np.ndarray:
        if self.used > len(self.model.table) + CACHE:
            self.forget()
        new = list(set(words).difference(self.rows))
        if new:
            if len(self.table) < self.used + len(new):
                self.table = np.concatenate([self.table[: self.used], np.empty((self.used + len(new), self.table.shape[1]), dtype=np.float32)])
            self.table[self.used : self.used + len(new)] = self.model.words(new)
            self.rows.update(zip(new, range(self.used, self.used + len(new))))
            self.used += len(new)
        return np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))


def _scored(model: Model, texts: pd.Series, known: Scores) -> tuple[list, list]:
    names, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return names, scores

    def settle(places: list[int], words: list[str], counts: list[int]) -> None:
        at = known.numbers(words)  # may replace the table
        total = summed(known.table, at, np.repeat(np.arange(len(counts)), counts), len(counts))
        n = np.array(counts)[:, None]
        logit = total / n * np.minimum(n, SURE)
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        for place, best, sure in zip(places, p.argmax(axis=1), p.max(axis=1) / p.sum(axis=1)):
            names[place], scores[place] = model.languages[best], float(sure)

    places, words, counts = [], [], []
    for place, text in enumerate(texts):
        own = WORD.findall(text.lower()) if text else []
        if any(c.isalpha() for w in own for c in w):
            places.append(place)
            words += own
            counts.append(len(own))
        if len(words) >= AT_ONCE:
            settle(places, words, counts)
            places, words, counts = [], [], []
    if words:
        settle(places, words, counts)
    return names, scores


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add lang_pred and score (0 to 1); other columns stay, and only the text is looked at.

    `und` with score 0 where the text is null or holds no letter, or where no language was learned. Ties go to the first
    language by name. Whole texts are read, whatever their length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Scores(shared.value)
        for texts in batches:
            names, scores = _scored(shared.value, texts, known)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.drop("lang_pred", "score").withColumn("__lang", score("text")).select(
        *[c for c in docs.columns if c not in ("lang_pred", "score")], "__lang.lang_pred", "__lang.score")


def held_out(doc_id: str, parts: int, part: int):
    """Whether crc32 of the id as text leaves that remainder; a null id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))
