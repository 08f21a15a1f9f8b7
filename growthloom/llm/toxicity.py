"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own vector and the mean vector of its character n-grams; a run of letters with more than GRAMS known
n-grams enters as several pieces, so that all of it is read. All overlapping windows of a text are scored; the text's score is
that of its worst window.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.session import stage

SAMPLE = 3_000  # labelled documents of each class that the network is fitted on
WIDTH, STRIDE = 48, 32  # words of a window, words to the next one
GRAM = 4
KNOWN_WORDS, KNOWN_GRAMS = 4_000, 6_000  # words and n-grams with a vector: the most telling ones
LEAST = 5  # occurrences of a word or n-gram that has one
SIZE, HIDDEN = 6, 8
GRAMS = 8  # known n-grams of a piece; a word with more of them is several pieces
EPOCHS, STEPS = 8, 400  # passes over the windows, more if these are too few for that many steps
BATCH = 2048  # windows scored at once
CACHE = 200_000  # words a task remembers at once
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def windows_of(n: int) -> range:
    """Starts of the windows over n words: they overlap, and the last one reaches the end."""
    return range(0, max(n - (WIDTH - STRIDE), 1), STRIDE)


def grams_of(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + GRAM] for i in range(len(padded) - GRAM + 1)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Word and n-gram vectors, two GRUs, attention, one output."""

    def __init__(self, words: dict[str, float], grams: dict[str, float], seed: int = 3):
        """Known words and n-grams with their log odds, which start the first component of their vectors."""
        rng = np.random.default_rng(seed)
        self.words = {w: i + 1 for i, w in enumerate(words)}
        self.grams = {g: i + 1 for i, g in enumerate(grams)}  # number 0: unknown
        self.odds = {**{g: abs(v) for g, v in grams.items()}}
        p = self.p = {
            "ew": rng.normal(0, 0.1, (len(words) + 1, SIZE)), "eg": rng.normal(0, 0.1, (len(grams) + 1, SIZE)),
            "att": rng.normal(0, 0.3, (2 * HIDDEN, HIDDEN)), "att_b": np.zeros(HIDDEN), "att_v": rng.normal(0, 0.3, HIDDEN),
            "out": rng.normal(0, 0.3, 2 * HIDDEN), "out_b": np.zeros(1),
        }
        p["ew"][1:, 0], p["eg"][1:, 0] = np.array(list(words.values())) / 4, np.array(list(grams.values())) / 4
        p["ew"][0], p["eg"][0] = 0, 0
        for d in "fb":
            p[d + "x"] = rng.normal(0, 0.3, (2 * SIZE, 3 * HIDDEN))
            p[d + "h"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            p[d + "b"] = np.zeros(3 * HIDDEN)
        self.shift = 0.0

    def ids(self, word: str) -> list[list[int]]:
        """Of each piece of a word: number of the word (0 after the first), then GRAMS numbers of n-grams (0: none)."""
        found = [self.grams[g] for g in grams_of(word) if g in self.grams]
        cut = [found[at : at + GRAMS] for at in range(0, len(found), GRAMS)] or [[]]
        return [[0 if i else self.words.get(word, 0), *part, *[0] * (GRAMS - len(part))] for i, part in enumerate(cut)]

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """Vectors of words given by `ids`, one row each."""
        count = np.maximum((ids[..., 1:] > 0).sum(axis=-1, keepdims=True), 1)
        return np.concatenate([self.p["ew"][ids[..., 0]], self.p["eg"][ids[..., 1:]].sum(axis=-2) / count], axis=-1)

    def _gru(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States (n, t, HIDDEN) over projected inputs x (n, t, 3 HIDDEN); a masked step leaves the state as it is."""
        n, steps, _ = x.shape
        h, u = np.zeros((n, HIDDEN), dtype=x.dtype), self.p[d + "h"].astype(x.dtype)
        states, kept = np.empty((n, steps, HIDDEN), dtype=x.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = h @ u
            gates = 1 / (1 + np.exp(-(x[:, t, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])))
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(x[:, t, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
            new = (z * h + (1 - z) * c) * mask[:, t] + h * (1 - mask[:, t])
            if keep:
                kept.append((t, h, z, r, c, a[:, 2 * HIDDEN :]))
            h = new
            states[:, t] = h
        return states, kept

    def _pool(self, states: np.ndarray, mask: np.ndarray):
        p = {k: v.astype(states.dtype) for k, v in self.p.items() if k[:3] in ("att", "out")}
        act = np.tanh(states @ p["att"] + p["att_b"])
        s = act @ p["att_v"] + np.where(mask[..., 0] > 0, 0, -1e9).astype(states.dtype)
        e = np.exp(s - s.max(axis=1, keepdims=True))
        weight = e / e.sum(axis=1, keepdims=True)
        pooled = (weight[..., None] * states).sum(axis=1)
        return act, weight, pooled, pooled @ p["out"] + p["out_b"]

    def logits(self, projected: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
        """Scores of windows; `rows` (n, t) are rows of the projected inputs, -1 past the end."""
        mask = (rows >= 0)[..., None].astype(np.float32)
        states = [self._gru(d, projected[d][np.maximum(rows, 0)], mask, False)[0] for d in "fb"]
        return self._pool(np.concatenate(states, axis=2), mask)[3] + np.float32(self.shift)

    def fit(self, ids: np.ndarray, mask: np.ndarray, label: np.ndarray, seed: int = 3) -> None:
        """Train on windows: ids (n, t, 1 + GRAMS), mask (n, t), label (n); Adam on weighted log loss."""
        rng, p = np.random.default_rng(seed), self.p
        m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
        weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-9), 0.5 / max(1 - label.mean(), 1e-9))
        step, epochs = 0, max(EPOCHS, -(-STEPS * 128 // max(len(label), 128)))
        for epoch in range(epochs):
            order = rng.permutation(len(label))
            for low in range(0, len(order), 128):
                rows = order[low : low + 128]
                g = self._gradients(ids[rows], mask[rows][..., None].astype(float), label[rows], weight[rows])
                step += 1
                for k in p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    p[k] -= 0.01 * (1 - 0.8 * epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                p["ew"][0], p["eg"][0] = 0, 0

    def _gradients(self, ids, mask, label, weight) -> dict[str, np.ndarray]:
        p, g = self.p, {k: np.zeros_like(x) for k, x in self.p.items()}
        x = self.inputs(ids)
        runs = {d: self._gru(d, x @ p[d + "x"] + p[d + "b"], mask, True) for d in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        act, share, pooled, logit = self._pool(states, mask)
        err = (sigmoid(logit) - label) * weight / len(label)
        g["out"], g["out_b"][0] = pooled.T @ err, err.sum()
        d_pooled = err[:, None] * p["out"]
        d_states = share[..., None] * d_pooled[:, None, :]
        d_share = (states * d_pooled[:, None, :]).sum(axis=2)
        d_s = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
        g["att_v"] = (act * d_s[..., None]).sum(axis=(0, 1))
        d_act = d_s[..., None] * p["att_v"] * (1 - act**2)
        g["att"], g["att_b"] = np.einsum("nti,ntj->ij", states, d_act), d_act.sum(axis=(0, 1))
        d_states = d_states + d_act @ p["att"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            d_h = np.zeros((len(label), HIDDEN))
            for t, h, z, r, c, a in reversed(runs[d][1]):
                d_h = d_h + d_states[:, t, k * HIDDEN : (k + 1) * HIDDEN]
                on, d_new = mask[:, t], d_h * mask[:, t]
                d_c = d_new * (1 - z) * (1 - c**2)
                d_z, d_r = d_new * (h - c) * z * (1 - z), d_c * a * r * (1 - r)
                d_in = np.concatenate([d_z, d_r, d_c], axis=1)
                d_a = np.concatenate([d_z, d_r, d_c * r], axis=1)
                g[d + "h"] += h.T @ d_a
                g[d + "x"] += x[:, t].T @ d_in
                g[d + "b"] += d_in.sum(axis=0)
                d_x[:, t] += d_in @ p[d + "x"].T
                d_h = d_new * z + d_a @ p[d + "h"].T + d_h * (1 - on)
        np.add.at(g["ew"], ids[..., 0].ravel(), d_x[..., :SIZE].reshape(-1, SIZE))
        count = np.maximum((ids[..., 1:] > 0).sum(axis=-1, keepdims=True), 1)
        part = np.repeat((d_x[..., SIZE:] / count)[..., None, :], GRAMS, axis=-2)
        np.add.at(g["eg"], ids[..., 1:].ravel(), part.reshape(-1, SIZE))
        g["ew"][0], g["eg"][0] = 0, 0
        return g


class Scorer:
    """Scores whole texts with a network; remembers the projected inputs of words it has met."""

    def __init__(self, network: Network):
        self.network = network
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}  # first row of a word's pieces
        self.used, self.pieces = 0, np.empty(1024, dtype=np.int64)
        self.inputs = {d: np.empty((1024, 3 * HIDDEN), dtype=np.float32) for d in "fb"}

    def learn(self, words: list[str]) -> None:
        net = self.network
        found = [net.ids(w) for w in words]
        counts = np.array([len(f) for f in found])
        x = net.inputs(np.array([piece for f in found for piece in f]))
        first, end = self.used, self.used + len(x)
        while len(self.pieces) < end:
            self.pieces = np.concatenate([self.pieces, np.empty_like(self.pieces)])
            self.inputs = {d: np.concatenate([v, np.empty_like(v)]) for d, v in self.inputs.items()}
        for d in "fb":
            self.inputs[d][first:end] = x @ net.p[d + "x"] + net.p[d + "b"]
        starts = first + np.cumsum(counts) - counts
        self.pieces[starts] = counts
        self.rows.update(zip(words, starts.tolist(), strict=True))
        self.used = end

    def __call__(self, texts) -> np.ndarray:
        """The highest window logit of each text, -inf for a text without words."""
        best = np.full(len(texts), -np.inf)
        waiting, owner = [], []
        for k, text in enumerate(texts):
            words = words_of(text)
            if not words:
                continue
            new = set(words).difference(self.rows)
            if new:
                if self.used + len(new) > CACHE:
                    self.flush(waiting, owner, best)
                    waiting, owner = [], []
                    self.clear()
                    new = set(words)
                self.learn(sorted(new))
            ids = np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))
            counts = self.pieces[ids]
            if counts.max() > 1:
                ids = np.repeat(ids - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            starts = np.array(windows_of(len(ids)))
            at = starts[:, None] + np.arange(WIDTH)
            waiting.append(np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], -1))
            owner.append(np.full(len(starts), k))
            if sum(map(len, owner)) >= BATCH:
                self.flush(waiting, owner, best)
                waiting, owner = [], []
        self.flush(waiting, owner, best)
        return best

    def flush(self, waiting: list, owner: list, best: np.ndarray) -> None:
        if waiting:
            rows, who = np.concatenate(waiting), np.concatenate(owner)
            for low in range(0, len(rows), BATCH):
                np.maximum.at(best, who[low : low + BATCH], self.network.logits(self.inputs, rows[low : low + BATCH]).astype(float))


def _odds(counts: DataFrame, toxic: int, clean: int, limit: int) -> dict[str, float]:
    """Log odds of the entries that tell the classes apart best, from (entry, bad, good)."""
    log = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    sure = F.abs(log) / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = counts.where(F.col("bad") + F.col("good") >= LEAST).select("entry", log.alias("odds"), sure.alias("sure"))
    return {r["entry"]: r["odds"] for r in best.orderBy(F.desc("sure"), "entry").limit(limit).collect()}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Fit on about `sample` documents of each class of (doc_id, toxic), picked by hash. None without both classes.

    The driver gets one window of each toxic and up to three of each clean sampled document, of WIDTH words each.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    size = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return None
    share = {k: min(1.0, sample / n) for k, n in size.items()}
    spot = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = marked.where(spot < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    texts = docs.where("text is not null").where(spot < max(share.values())).select("doc_id", "text")
    rows = stage(texts.join(picked, "doc_id").select("text", "toxic"), "labelled")
    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return None
    found = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")))).alias("entry"))
    words = stage(found.groupBy("entry").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "labelled-words")
    padded = F.concat(F.lit(" "), "entry", F.lit(" "))
    pieces = F.transform(F.sequence(F.lit(1), F.length(padded) - GRAM + 1), lambda i: F.substring(padded, i, F.lit(GRAM)))
    grams = words.where(F.length(padded) >= GRAM).select(F.explode(F.array_distinct(pieces)).alias("entry"), "bad", "good")
    grams = grams.groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    totals = words.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    network = Network(_odds(words, size[1], size[0], KNOWN_WORDS), _odds(grams, totals["bad"] or 0, totals["good"] or 0, KNOWN_GRAMS))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first_word, first_gram = network.p["ew"][:, 0], network.p["eg"][:, 0]
        seen: dict[str, list[tuple[list[int], float]]] = {}
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words = words_of(text)
                if len(seen) > CACHE:
                    seen.clear()
                for w in set(words).difference(seen):
                    seen[w] = [(ids, max(first_word[ids[0]], max(first_gram[ids[1:]]))) for ids in network.ids(w)]
                pieces = [piece for w in words for piece in seen[w]]
                marks = np.array([mark for _, mark in pieces])
                starts = list(windows_of(len(pieces)))
                order = sorted(starts, key=lambda s: (-marks[s : s + WIDTH].max(initial=-9), s))
                chosen = order[:1] if toxic else dict.fromkeys([*order[:2], order[len(order) // 2]])
                out += [([i for ids, _ in pieces[s : s + WIDTH] for i in ids], int(toxic)) for s in chosen if pieces]
            yield pd.DataFrame(out, columns=["ids", "toxic"])

    kept = rows.mapInPandas(pick, "ids array<int>, toxic int").orderBy("ids", "toxic").collect()
    ids = np.zeros((len(kept), WIDTH, 1 + GRAMS), dtype=np.int64)
    mask = np.zeros((len(kept), WIDTH))
    for i, r in enumerate(kept):
        window = np.array(r["ids"]).reshape(-1, 1 + GRAMS)
        ids[i, : len(window)], mask[i, : len(window)] = window, 1
    network.fit(ids, mask, np.array([r["toxic"] for r in kept], dtype=float))

    # Put 0.5 where it tells the sampled documents apart best, halfway between the classes' nearest scores.
    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(network)
        for batch in batches:
            yield pd.DataFrame({"logit": scorer(batch["text"].tolist()), "toxic": batch["toxic"]})

    rated = rows.mapInPandas(rate, "logit double, toxic int").toPandas().sort_values("logit", kind="stable")
    rated = rated[np.isfinite(rated["logit"])]
    logit, toxic = rated["logit"].to_numpy(), rated["toxic"].to_numpy()
    if len(logit) > 1:
        wrong = np.cumsum(toxic)[:-1] / max(toxic.sum(), 1) + 1 - np.cumsum(1 - toxic)[:-1] / max((1 - toxic).sum(), 1)
        best = np.flatnonzero(wrong == wrong.min())
        middle = best[np.argmax(logit[best + 1] - logit[best])]
        network.shift = -float(logit[middle] + logit[middle + 1]) / 2
    return network


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """Add score (0 to 1) and predicted (1 from 0.5); other columns stay, and only the text is looked at.

    Every window of the whole text is scored. Null texts, texts without words and a missing network score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value) if shared.value is not None else None
        for texts in batches:
            logit = scorer(texts.tolist()) if scorer else np.full(len(texts), -np.inf)
            yield pd.Series(np.where(np.isfinite(logit), sigmoid(logit), 0.0))

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, toxic("text").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
