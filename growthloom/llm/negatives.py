"""Hard negatives by exact integer scores, looked up in tables of subset sums (the method of the four Russians).

Vectors are whole numbers. Every eight dimensions form a group. For an anchor, a group has a table of 256 sums: of each subset of
the anchor's eight numbers. A candidate is held as bit planes, in two's complement: plane b has one byte per group, with bit b of
its eight numbers. The byte picks the sum of the anchor's numbers whose partner has that bit set, so the inner product is the sum
over planes and groups of table[byte] shifted by b, the sign plane counted negatively. All scores are exact and complete.

Anchors and candidates meet in blocks of bounded size. A first pass, within labels, finds each anchor's positives; a second one,
with the scores of the positives known, finds the negatives in their windows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthloom.session import stage

GROUP = 8
LIMIT = 1 << 24  # numbers of a vector lie below this in size, so that scores fit 64 bits
BLOCK = 4_096  # candidates of a block
BLOCK_ANCHORS = 2_048
TILE = 256  # anchors whose tables are in use at once
ROWS = 2_048  # candidates scored at once
BITS = 1 << np.arange(GROUP)


def whole(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of rows whose label and vector are not null and whose components are finite.

    Rows without an id, empty vectors, and components of 2^24 or more (after scaling) take no part either: their scores do not fit.
    """
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) & (F.abs(c * scale) < LIMIT - 1))
    found = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform("embedding", lambda c: c.cast("double")).alias("x"))
    found = found.where("vec_id is not null and label is not null and x is not null").where(finite & (F.size("x") > 0))
    return found.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v"))


def planes(v: np.ndarray) -> np.ndarray:
    """(rows, planes, groups) bytes of whole numbers, the last plane that of the sign."""
    width = -v.shape[1] % GROUP
    v = np.pad(v, ((0, 0), (0, width))).reshape(len(v), -1, GROUP)
    bits = int(max(int(v.max(initial=0)), -int(v.min(initial=0)) - 1, 0)).bit_length() + 1
    return np.stack([((v >> b & 1) * BITS).sum(axis=2).astype(np.uint8) for b in range(bits)], axis=1)


def tables(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): sums of every subset of eight numbers, each made from one of its subsets by one addition."""
    width = -anchors.shape[1] % GROUP
    a = np.pad(anchors, ((0, 0), (0, width))).reshape(len(anchors), -1, GROUP).transpose(1, 2, 0).astype(kind)
    out = np.zeros((a.shape[0], 1 << GROUP, a.shape[2]), dtype=kind)
    for bit in range(GROUP):
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + a[:, bit : bit + 1]
    return out


def scores(anchors: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors) of whole numbers with packed candidates."""
    bits = packed.shape[1]
    most = anchors.shape[1] * max(1, int(np.abs(anchors).max(initial=0))) << bits
    kind = np.int32 if most < 1 << 31 else np.int64
    out = np.zeros((len(packed), len(anchors)), dtype=kind)
    for left in range(0, len(anchors), TILE):
        table = tables(anchors[left : left + TILE], kind)
        for low in range(0, len(packed), ROWS):
            part, total = packed[low : low + ROWS], out[low : low + ROWS, left : left + TILE]
            sums = np.zeros(total.shape, dtype=kind)
            found = np.empty_like(sums)
            for b in reversed(range(bits)):  # shift what the higher planes gave, add this plane
                sums <<= 1
                for g in range(table.shape[0]):
                    np.take(table[g], part[:, b, g], axis=0, out=found, mode="clip")
                    if b == bits - 1:
                        sums -= found
                    else:
                        sums += found
            total[:] = sums
    return out


def _packed(rows: DataFrame) -> DataFrame:
    """(vec_id, label, d, bits, packed): the rows' bit planes, as many as their batch needs; d is the number of dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["v"]
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for d in np.unique(sizes):
                mine = np.flatnonzero(sizes == d)
                v = values[(ends[mine] - d)[:, None] + np.arange(d)]
                for low in range(0, len(mine), ROWS):
                    some = mine[low : low + ROWS]
                    p = planes(v[low : low + ROWS])
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [batch["vec_id"].take(pa.array(some)), batch["label"].take(pa.array(some)), pa.array(np.full(n, d, dtype=np.int32)),
                         pa.array(np.full(n, p.shape[1], dtype=np.int32)), pa.array([x.tobytes() for x in p], pa.binary())],
                        names=["vec_id", "label", "d", "bits", "packed"])

    return rows.mapInArrow(run, "vec_id long, label long, d int, bits int, packed binary")


def _planes_of(table: pa.Table, d: int) -> np.ndarray:
    """The candidates' planes, all with as many as the widest: a narrower one repeats its sign."""
    groups, bits = -(-d // GROUP), table["bits"].to_numpy()
    out = np.empty((len(bits), int(bits.max(initial=1)), groups), dtype=np.uint8)
    packed = table["packed"].to_pylist()
    for b in np.unique(bits):
        mine = np.flatnonzero(bits == b)
        got = np.frombuffer(b"".join(packed[i] for i in mine), dtype=np.uint8).reshape(len(mine), b, groups)
        out[mine, :b] = got
        out[mine, b:] = got[:, -1:]
    return out


def _blocks(anchors: DataFrame, candidates: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """Anchors and candidates of equal keys, dealt into blocks (keys, i, j) of bounded size on either side.

    A key that holds most rows has many blocks. Block counts are one row per key, joined as Spark sees fit.
    """
    lefts = anchors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ANCHORS).cast("int").alias("lefts"))
    rights = candidates.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("rights"))
    counts = lefts.join(rights, keys)
    spot = F.xxhash64("vec_id", F.lit(12))
    all_rights, all_lefts = F.sequence(F.lit(0), F.col("rights") - 1), F.sequence(F.lit(0), F.col("lefts") - 1)
    left = anchors.join(counts, keys).withColumn("i", F.pmod(spot, "lefts").cast("int")).withColumn("j", F.explode(all_rights))
    right = candidates.join(counts, keys).withColumn("j", F.pmod(spot, "rights").cast("int")).withColumn("i", F.explode(all_lefts))
    head = list(dict.fromkeys([*keys, "d", "label", "i", "j", "vec_id"]))
    return left.select(*head, "v", *extra).unionByName(right.select(*head, "bits", "packed"), allowMissingColumns=True)


def _sides(block: pa.Table):
    """Anchor rows with their vectors, candidate rows with their planes; None where a side is empty."""
    anchors = block.filter(pc.is_null(block["packed"]))
    candidates = block.filter(pc.is_valid(block["packed"]))
    if not len(anchors) or not len(candidates):
        return None
    d = int(block["d"][0].as_py())
    v = anchors["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(anchors), d)
    return anchors, candidates, v, _planes_of(candidates, d)


def best(score: np.ndarray, ids: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores where `ok`, ties to the smaller id."""
    at = np.flatnonzero(ok)
    if len(at) > k:
        s = score[at]
        at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return at[np.lexsort((ids[at], -score[at].astype(np.int64)))[:k]]


def _top(df: DataFrame, keys: list[str], k: int, id_column: str, score: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc(score), id_column)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, label, embedding).

    Anchors are rows whose id `every` divides. Their positives are the best `positives` rows of their label, their negatives, for
    each positive, the best `negatives` rows of other labels whose score lies from `low` to `high` per cent of the positive's.
    Scores are inner products of floor(scale * x); ties go to the smaller id. Vectors of different lengths have no product. An id
    that repeats asks once, by its smallest (label, vector); its other rows are candidates as they are, never its own. An anchor
    without positives, or a positive without negatives, gives no rows; nor does an empty table.
    """
    found = whole(rows, scale)
    candidates = stage(_packed(found), "negatives-planes")
    anchors = found.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select(
        "vec_id", "x.label", F.size("x.v").alias("d"), "x.v")
    anchors = stage(anchors, "negatives-anchors")

    def near(block: pa.Table) -> pa.Table:
        out, sides = [], _sides(block)
        if sides:
            a, c, v, p = sides
            asked, ids, s = a["vec_id"].to_numpy(), c["vec_id"].to_numpy(), scores(v, p)
            for n, own in enumerate(asked):
                at = best(s[:, n], ids, ids != own, positives)
                out += zip([own] * len(at), ids[at], s[at, n])
        columns = list(zip(*out)) or [[], [], []]
        return pa.table({name: pa.array(np.array(c, dtype=np.int64)) for name, c in zip(("anchor_id", "positive_id", "positive_score"), columns)})

    first = _blocks(anchors, candidates, ["d", "label"], []).groupBy("d", "label", "i", "j").applyInArrow(
        near, "anchor_id long, positive_id long, positive_score long")
    pairs = stage(_top(first, ["anchor_id"], positives, "positive_id", "positive_score"), "negatives-positives")
    wanted = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("wanted"))  # `positives` of them at most
    asked = anchors.join(wanted, "vec_id").select(
        "vec_id", "label", "d", "v", F.transform("wanted", lambda w: w["positive_id"]).alias("pos"), F.transform("wanted", lambda w: w["positive_score"]).alias("pos_score"))

    def far(block: pa.Table) -> pa.Table:
        out, sides = [], _sides(block)
        if sides:
            a, c, v, p = sides
            ids, labels, s = c["vec_id"].to_numpy(), c["label"].to_numpy(), scores(v, p)
            for n, (own, label, pos, pos_score) in enumerate(zip(a["vec_id"].to_pylist(), a["label"].to_pylist(), a["pos"].to_pylist(), a["pos_score"].to_pylist())):
                other, mine_ = labels != label, s[:, n].astype(np.int64)
                for place, (positive, score) in enumerate(zip(pos, pos_score)):
                    # 100 n >= low score and 100 n <= high score, in whole numbers that cannot overflow
                    ok = other & (mine_ >= -(-low * score // 100)) & (mine_ <= high * score // 100)
                    at = best(mine_, ids, ok, negatives)
                    out += zip([own] * len(at), [place] * len(at), [positive] * len(at), [score] * len(at), ids[at], mine_[at])
        columns = list(zip(*out)) or [[]] * 6
        names = ("anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table({name: pa.array(np.array(c, dtype=np.int64)) for name, c in zip(names, columns)})

    second = _blocks(asked, candidates, ["d"], ["pos", "pos_score"]).groupBy("d", "i", "j").applyInArrow(
        far, "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long")
    return _top(second, ["anchor_id", "place"], negatives, "negative_id", "negative_score").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
