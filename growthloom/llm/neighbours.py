"""Nearest neighbours by learned partitions of a neighbour graph.

On a bounded sample the graph of nearest neighbours is cut into partitions of equal size with few edges between them, and a
small network learns to name the partitions of a vector's neighbours. Every vector of the table is stored in its most
probable partition. A query visits its most probable partitions, and all vectors there are ranked by the exact product.
How many partitions a query visits is measured on the sample: the fewest that reach the recall asked for.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE = 8_000  # vectors the partitions are learned from
SPREAD = 16  # one partition per SPREAD of the root of the vectors: a query gets k rows from each one it visits
MOST_PARTS = 128
LINKS = 16  # neighbours of a vector in the graph
RECALL = 0.95  # wanted on the sample
BLOCK = 4096  # vectors, BLOCK_QUERIES queries in one block
BLOCK_QUERIES = 1024


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): vectors that are not null, not zero, finite, with an id and of the most frequent length."""
    v = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    found = found.where(finite & F.exists("v", lambda x: x != 0))
    length = found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return found.where(F.size("v") == (length[0]["d"] if length else 0))


def graph(x: np.ndarray, links: int) -> np.ndarray:
    """Row numbers of each row's nearest other rows by inner product."""
    out = np.empty((len(x), min(links, len(x) - 1)), dtype=np.int64)
    for low in range(0, len(x), 512):
        s = x[low : low + 512] @ x.T
        s[np.arange(len(s)), np.arange(low, low + len(s))] = -np.inf
        out[low : low + len(s)] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def partition(x: np.ndarray, near: np.ndarray, parts: int, sweeps: int = 6) -> np.ndarray:
    """Balanced parts: halves along the widest direction, then moves towards the part that holds most neighbours."""
    part = np.zeros(len(x), dtype=np.int64)
    todo, made = [(np.arange(len(x)), parts)], 0
    while todo:
        rows, n = todo.pop()
        if n == 1:
            part[rows] = made
            made += 1
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.ones(x.shape[1])
        for _ in range(20):
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) or 1.0
        order = rows[np.argsort(centred @ axis, kind="stable")]
        cut = len(rows) * (n // 2) // n
        todo += [(order[:cut], n // 2), (order[cut:], n - n // 2)]
    most = math.ceil(1.1 * len(x) / parts)
    size = np.bincount(part, minlength=parts)
    back = [[] for _ in range(len(x))]
    for i, row in enumerate(near):
        for j in row:
            back[j].append(i)
    around = [np.concatenate([near[i], np.array(back[i], dtype=np.int64)]) for i in range(len(x))]
    for _ in range(sweeps):
        moved = 0
        for i in np.random.default_rng(8).permutation(len(x)):
            votes = np.bincount(part[around[i]], minlength=parts)
            for to in np.argsort(-votes, kind="stable")[:3]:
                if to == part[i] or votes[to] <= votes[part[i]]:
                    break
                if size[to] < most:
                    size[part[i]] -= 1
                    size[to] += 1
                    part[i] = to
                    moved += 1
                    break
        if not moved:
            break
    return part


class Router:
    """A network of one hidden layer: vector to probabilities of the parts."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 25, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.scale = 1.0 / (np.abs(x).mean() or 1.0)
        shapes = [(x.shape[1], hidden), (hidden,), (hidden, target.shape[1]), (target.shape[1],)]
        self.w = [rng.normal(0, 1 / math.sqrt(s[0]), s) if len(s) == 2 else np.zeros(s) for s in shapes]
        m, v, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        for epoch in range(epochs):
            rate = 0.005 * (1 - epoch / epochs) + 0.0002
            order = rng.permutation(len(x))
            for low in range(0, len(x), 128):
                rows = order[low : low + 128]
                z = x[rows] * self.scale
                h = np.maximum(z @ self.w[0] + self.w[1], 0)
                e = (self.softmax(h @ self.w[2] + self.w[3]) - target[rows]) / len(rows)
                back = (e @ self.w[2].T) * (h > 0)
                step += 1
                for k, g in enumerate([z.T @ back, back.sum(0), h.T @ e, e.sum(0)]):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def softmax(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x * self.scale) @ self.w[0] + self.w[1], 0)
        return self.softmax(h @ self.w[2] + self.w[3])


def fit(vectors: DataFrame, rows: int, k: int, sample: int = SAMPLE, recall: float = RECALL) -> tuple[Router | None, int, int]:
    """Router, number of parts and parts to visit, learned from about `sample` vectors picked by hash."""
    share = min(1.0, sample / max(rows, 1))
    picked = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit(8)), F.lit(1 << 30)) < share * (1 << 30)).orderBy("vec_id").limit(2 * sample).collect()
    parts = min(MOST_PARTS, math.ceil(math.sqrt(rows) / SPREAD), len(picked) // 32)
    if parts < 2:
        return None, 1, 1
    x = np.array([r["v"] for r in picked])
    near = graph(x, LINKS)
    part = partition(x, near, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1.0)
    target[np.arange(len(x)), part] += 1
    router = Router(x, target / target.sum(axis=1, keepdims=True))
    chance = router(x)
    home = chance.argmax(axis=1)
    order = np.argsort(-chance, axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(x), 0), axis=1)
    # The k nearest of a thin sample lie further out than those of the table, so this does not flatter.
    wanted = graph(x, k)
    rank = np.take_along_axis(place, home[wanted], axis=1)
    found = [(rank < n).mean() for n in range(1, parts + 1)]
    visits = next((n for n, f in enumerate(found, 1) if f >= recall), parts)
    return router, parts, visits


def _top(block: pa.Table, k: int) -> pa.Table:
    """The k best vectors of a block for each of its queries: exact products, ties to the smaller id."""
    def side(query: bool):
        rows = block.filter(pc.equal(block["query"], query))
        v = rows["v"].combine_chunks()
        return rows["vec_id"].to_numpy(), np.asarray(v.flatten()).reshape(len(rows), -1 if len(rows) else 0)

    query_ids, q = side(True)
    ids, v = side(False)
    found: list[tuple] = []
    if len(query_ids) and len(ids):
        near = 1e-9 * np.linalg.norm(v, axis=1).max()
        for low in range(0, len(q), 256):
            products = q[low : low + 256] @ v.T
            for i, s in enumerate(products, low):
                own = ids == query_ids[i]
                s = np.where(own, -np.inf, s)
                left = min(k, len(ids) - int(own.sum()))
                if left <= 0:
                    continue
                least = np.partition(s, len(s) - left)[len(s) - left]
                c = np.flatnonzero((s >= least - near * np.linalg.norm(q[i])) & ~own)
                exact = (v[c] * q[i]).sum(axis=1)  # the same sum for equal vectors, unlike a matrix product
                best = np.lexsort((ids[c], -exact))[:k]
                found += zip([query_ids[i]] * len(best), ids[c][best], exact[best], strict=True)
    columns = list(zip(*found, strict=True)) or [[], [], []]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                     "score": pa.array(columns[2], pa.float64())})


def search(rows: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id `every` divides, by inner product.

    Rows without an id, and vectors that are null, zero, not finite or not of the most frequent length take no part. Rows
    that repeat a query's id are not its neighbours, and an id queries once, by its smallest vector. Ties go to the smaller
    id. An empty table gives no rows.
    """
    vectors = usable(rows, vec_id, vector)
    count = vectors.count()
    router, parts, visits = fit(vectors, count, k, sample, recall)
    shared = rows.sparkSession.sparkContext.broadcast(router)

    @F.pandas_udf("array<int>")
    def route(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            best = np.zeros((len(v), 1), dtype=np.int32)
            if shared.value is not None and len(v):
                best = np.argsort(-shared.value(np.stack(v.to_numpy())), axis=1, kind="stable")[:, :visits].astype(np.int32)
            yield pd.Series(list(best))

    routed = vectors.withColumn("parts", route("v"))
    stored = routed.select("vec_id", "v", F.col("parts")[0].alias("part"))
    queries = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("parts", route("v"))
    asked = queries.select("vec_id", "v", F.explode("parts").alias("part"))
    # At most MOST_PARTS rows each: how many blocks a part needs on either side.
    rights = stored.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("rights"))
    lefts = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("lefts"))
    blocks = F.broadcast(rights.join(lefts, "part"))
    spot = F.xxhash64("vec_id", F.lit(9))
    left = asked.join(blocks, "part").withColumn("i", F.pmod(spot, "lefts").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
    right = stored.join(blocks, "part").withColumn("j", F.pmod(spot, "rights").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
    cells = left.select("part", "i", "j", "vec_id", "v", F.lit(True).alias("query")).unionByName(
        right.select("part", "i", "j", "vec_id", "v", F.lit(False).alias("query")))
    best = cells.groupBy("part", "i", "j").applyInArrow(lambda t: _top(t, k), "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
