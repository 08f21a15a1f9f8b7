"""Documents whose word shingles overlap: a Jaccard join by vertical partitioning.

All shingles stand in one order, that of their hashes. The order is cut into fragments, and so is every document's set.

* Two sets that link differ in at most D shingles, so at most D fragments differ. Of a document with more than D fragments
  that hold something, one of those is the same in its partner: documents that share the content of a fragment are
  candidates. There are a few more than D + 1 fragments, so that nearly every document has that many. The rare document that
  has not shows its empty fragments too: two such documents share one of all. D follows from the size, so sizes fall into
  classes; a document shows its fragments as its own class cuts them, and if its size links with the class below, as that one.
* Per candidate pair the overlap is counted in each fragment of a coarser cut, and the counts are summed.
* All pairs of a large group are never formed. Each candidate group has a hub, the document whose fragments are shared
  most; members are compared with the hub, linked ones are of one component and need no comparison with each other. Members still
  apart from the hub leave if too many of their shingles are in no other component of the group, and so does the rest.
  Only who stays is compared, those apart with the others, in blocks of bounded size.
* Large joins go slice after slice: of the content hashes, of the coarser cut, of the blocks. The shuffle files of a slice are
  removed before the next one, so the disk holds a part of what is shuffled.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.llm.components import components
from growthloom.session import discard, stage

WORDS = 3
PERCENT = 90
CUTS = 4  # fragments in which overlaps are counted
SLICES = 4  # of the content hashes and of the blocks, joined one after the other
BITS = 48  # of a fragment's content hash: among 10^12 fragments one in 280 meets a foreign one, which the comparison finds out
BLOCK = 256  # documents on either side of a block
COLUMNS = 8192  # shingles of a fragment counted at once
CACHE = 400_000  # word hashes a task remembers at once
U64 = np.uint64


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        split = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
        if not split:
            return np.empty(0, dtype=U64)
        if len(self.seen) > CACHE:
            self.seen.clear()
        for w in set(split).difference(self.seen):
            self.seen[w] = xxhash.xxh3_64_intdigest(w)
        a = np.fromiter(map(self.seen.__getitem__, split), dtype=U64, count=len(split))
        width = min(self.words, len(a))
        h = np.full(len(a) - width + 1, width, dtype=U64)
        for i in range(width):
            h = h * U64(0x9E3779B97F4A7C15) + a[i : len(a) - width + 1 + i]
        return np.unique(mixed(h))


def reach(n: int, percent: int = PERCENT) -> int:
    """The greatest size that links with size n."""
    return n * 100 // percent


def size_classes(most: int, percent: int = PERCENT) -> list[int]:
    """First size of each class, a step of `reach` wide, up to the first beyond `most`."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, reach(out[-1], percent)))
    return out


def parts_of(first: int, last: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """Of the class of sizes first to last: most shingles in which two sets differ that link, one of them of the class and the
    other not smaller than it; fragments, so many that nearly every set has more full ones; greatest size that shows them."""
    far = reach(last, percent)
    differ = (last + far) * (100 - percent) // (100 + percent)
    parts = differ + 1
    while differ:
        empty = parts * math.exp(-first / parts)
        if parts >= differ + 1 + empty + math.sqrt(empty) or parts >= 2 * (differ + 1):
            break
        parts += 1
    return differ, parts, far


def class_parts(starts: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    return [parts_of(int(a), int(b) - 1, percent) for a, b in zip(starts[:-1], starts[1:])]


def signatures(shingles: np.ndarray, starts: np.ndarray, classes: list[tuple[int, int, int]]) -> np.ndarray:
    """Content hashes of a set's fragments in its class and the one below that it links with: the full ones, and the empty ones
    if few are full."""
    n = len(shingles)
    own = int(np.searchsorted(starts, n, side="right")) - 1
    sums = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(mixed(shingles ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
    out = []
    for c in (own, own - 1) if own and n <= classes[own - 1][2] else (own,):
        differ, parts, _ = classes[c]
        fragment = ((shingles >> U64(32)) * U64(parts)) >> U64(32)
        cut = np.searchsorted(fragment, np.arange(parts + 1, dtype=U64))
        content = sums[cut[1:]] - sums[cut[:-1]]
        shown = mixed(mixed(content + np.arange(parts, dtype=U64) * U64(0xD6E8FEB86659FD93)) + U64(c))
        full = cut[1:] > cut[:-1]
        out.append(shown[full] if full.sum() > differ else shown)
    return np.concatenate(out) >> U64(64 - BITS)


def node_of(shingles: np.ndarray) -> int:
    """64-bit name of a set: documents with equal sets are one node."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "big", signed=True)


def _shingled(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, node, signatures by slice) of every document, a column `signatures_k` per slice k; no node for an empty set.

    A set that a task met before comes without signatures, so equal documents multiply nothing; so do rows without doc_id.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, starts, met = Shingler(words), np.array(size_classes(1 << 16, percent)), set()
        classes, none = class_parts(starts, percent), np.empty(0, dtype=np.int64)
        for batch in batches:
            if len(met) > CACHE:
                met.clear()
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                sets = [make(t) for t in part["text"]]
                most = max(map(len, sets), default=0)
                if most >= starts[-1]:
                    starts = np.array(size_classes(2 * most, percent))
                    classes = class_parts(starts, percent)
                nodes, shown = [node_of(s) if len(s) else None for s in sets], []
                for s, node, i in zip(sets, nodes, part["doc_id"].isna()):
                    fresh = node is not None and not i and node not in met
                    met.update([node] if fresh else [])
                    shown.append(signatures(s, starts, classes).view(np.int64) if fresh else none)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64"), "n": [len(s) for s in sets], "node": pd.array(nodes, dtype="Int64"),
                    **{f"signatures_{k}": [s[s % SLICES == k] for s in shown] for k in range(SLICES)}})

    columns = ", ".join(f"signatures_{k} array<long>" for k in range(SLICES))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, f"doc_id long, n long, node long, {columns}")


def _fragments(docs: DataFrame, words: int, cuts: int) -> DataFrame:
    """(node, part, shingles): each document's set, cut at `cuts` - 1 fixed places of the order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Shingler(words)
        for batch in batches:
            for at in range(0, len(batch), 512):
                sets = [make(t) for t in batch["text"].iloc[at : at + 512]]
                rows = []
                for s in sets:
                    part = ((s >> U64(32)) * U64(cuts)) >> U64(32)
                    cut = np.searchsorted(part, np.arange(cuts + 1, dtype=U64))
                    node = node_of(s)
                    rows += [(node, i, s[cut[i] : cut[i + 1]].view(np.int64)) for i in range(cuts)]
                yield pd.DataFrame(rows, columns=["node", "part", "shingles"])

    return docs.select("text").mapInPandas(run, "node long, part int, shingles array<long>")


def _linked(overlap, n, m, percent: int):
    return overlap * 100 >= (n + m - overlap) * percent


def _shared(shown: DataFrame, k: int) -> DataFrame:
    """(sig, node): the fragments of a slice that more than one row shows."""
    rows = shown.where("node is not null").select("node", F.explode(f"signatures_{k}").alias("sig"))
    # Counted map-side first; the join back is left to AQE, which may split a hot fragment.
    twice = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("sig")
    return rows.join(twice, "sig").distinct()


def _candidates(shared: DataFrame, made: DataFrame) -> DataFrame:
    """(hub, node, n, hub_n): the members of each hub's group, without the hub itself."""
    sizes = made.join(shared.select("node").distinct(), "node", "left_semi").select("node", "n").distinct()
    many = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    rated = shared.join(many, "sig")
    central = rated.groupBy("node").agg(F.sum(F.log2("many")).alias("central")).join(sizes, "node").select(
        "node", "n", (F.col("central") / F.col("n")).alias("central"))
    rated = rated.select("sig", "node").join(central, "node")
    hubs = rated.groupBy("sig").agg(F.max(F.struct("central", "node", "n")).alias("hub"))
    found = rated.join(hubs, "sig").select(F.col("hub.node").alias("hub"), "node", "n", F.col("hub.n").alias("hub_n")).where("hub <> node")
    return found.distinct()


def _pair_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that link: partial overlaps counted fragment after fragment, summed per pair."""
    fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    partial = []
    for part in range(CUTS):
        own = sets.where(F.col("part") == part).select("node", "shingles")
        right = own.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles"))
        partial.append(stage(pairs.where(fits).join(own, "node").join(right, "hub").select(
            "hub", "node", "n", "hub_n", F.size(F.array_intersect("shingles", "hub_shingles")).alias("overlap")), "overlaps"))
    whole = reduce(DataFrame.unionByName, partial).groupBy("hub", "node", "n", "hub_n").agg(F.sum("overlap").alias("overlap"))
    links = whole.where(_linked(F.col("overlap"), F.col("n"), F.col("hub_n"), percent)).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = stage(links, "links")
    discard(*partial)
    return links


def _side(table: pa.Table, left: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """Nodes, sizes, labels of one side of a block, and per part the row numbers and shingles."""
    rows = table.filter(pc.equal(table["left"], left))
    node = rows["node"].to_numpy()
    nodes, first, at = np.unique(node, return_index=True, return_inverse=True)
    part = rows["part"].to_numpy()
    lists = rows["shingles"].combine_chunks()
    bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    cells = {}
    for p in np.unique(part):
        mine = np.flatnonzero(part == p)
        cells[int(p)] = (np.repeat(at[mine], (bounds[1:] - bounds[:-1])[mine]),
                         np.concatenate([values[bounds[i] : bounds[i + 1]] for i in mine] or [np.empty(0, dtype=np.int64)]))
    return nodes, rows["n"].to_numpy()[first], rows["label"].to_numpy()[first], cells


def overlaps(left: dict, right: dict, shape: tuple[int, int]) -> np.ndarray:
    """Common shingles of every row on the left with every row on the right, summed over parts and slices of shingles."""
    total = np.zeros(shape, dtype=np.float32)
    for part in left.keys() & right.keys():
        (i, x), (j, y) = left[part], right[part]
        both = np.intersect1d(x, y)
        keep_x, keep_y = np.isin(x, both), np.isin(y, both)
        i, j = i[keep_x], j[keep_y]
        x, y = np.searchsorted(both, x[keep_x]), np.searchsorted(both, y[keep_y])
        for low in range(0, len(both), COLUMNS):
            width = min(COLUMNS, len(both) - low)
            a, b = np.zeros((shape[0], width), dtype=np.float32), np.zeros((shape[1], width), dtype=np.float32)
            in_x, in_y = (x >= low) & (x < low + width), (y >= low) & (y < low + width)
            a[i[in_x], x[in_x] - low] = 1
            b[j[in_y], y[in_y] - low] = 1
            total += a @ b.T
    return total


def _able(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the members (hub, node, n, label, apart) those that may link with a member of another label in their group.

    A member shares no more than it holds of shingles that other labels of the group hold too. The others, its own, are counted
    part after part of the sets; a member with too many leaves before the next part, and so does a group with nobody apart.
    """
    able = rows.withColumn("own", F.lit(0).cast("long"))
    for part in range(CUTS):
        groups = able.groupBy("hub").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("many"), F.max("apart").alias("open"))
        rows = able.join(groups.where("open and many > 1").select("hub", "least"), "hub")
        held = rows.join(sets.where(F.col("part") == part), "node").select("hub", "node", "label", F.explode("shingles").alias("shingle"))
        # Two shingles of one hash only seem common; a node may stand in `sets` twice.
        cells = held.select("hub", "node", "label", F.xxhash64("hub", "shingle").alias("cell"))
        own = cells.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low = high").select("cell")
        counted = cells.select("hub", "node", "cell").join(own, "cell").groupBy("hub", "node").agg(F.count_distinct("cell").alias("more"))
        rows = rows.join(counted, ["hub", "node"], "left").withColumn("own", F.col("own") + F.coalesce("more", F.lit(0)))
        # The partner has `least` shingles or more, and so many that the sizes may link.
        partner = F.greatest(100 * F.col("least"), percent * F.col("n"))
        after = stage(rows.where((F.col("n") - F.col("own")) * (100 + percent) * 100 >= (100 * F.col("n") + partner) * percent).select(
            "hub", "node", "n", "label", "apart", "own"), "able-members")
        discard(able)
        able = after
    return able


def _rest_links(groups: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between labels: members apart from their hub against the whole group, block by block."""
    members = groups.select("hub", "node", "n").unionByName(groups.select("hub", F.col("hub").alias("node"), F.col("hub_n").alias("n")).distinct())
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_hub = labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    labelled = labelled.join(of_hub, "hub", "left").withColumn("apart", F.col("label") != F.coalesce("hub_label", "hub"))
    # The hub was compared with all members; everyone else stands on the right.
    labelled = stage(labelled.where("node <> hub").select("hub", "node", "n", "label", "apart"), "labelled-groups")
    able = _able(labelled, sets, percent)
    discard(labelled)
    sizes = able.groupBy("hub").agg(F.count(F.lit(1)).alias("all"), F.sum(F.col("apart").cast("long")).alias("apart_rows"))
    open_groups = sizes.where("apart_rows > 0 and all > 1").select(
        "hub", F.ceil(F.col("apart_rows") / BLOCK).cast("int").alias("lefts"), F.ceil(F.col("all") / BLOCK).cast("int").alias("rights"))
    rows = able.join(open_groups, "hub")
    spot = F.xxhash64("node")
    left = rows.where("apart").withColumn("i", F.pmod(spot, "lefts").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
    right = rows.withColumn("j", F.pmod(spot, "rights").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
    columns = ["hub", "i", "j", "node", "n", "label"]
    blocks = left.select(*columns, F.lit(True).alias("left")).unionByName(right.select(*columns, F.lit(False).alias("left")))

    def compare(table: pa.Table) -> pa.Table:
        nodes, n, label, cells = _side(table, True)
        others, m, other_label, other_cells = _side(table, False)
        found = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not len(nodes) or not len(others):
            return found
        common = overlaps(cells, other_cells, (len(nodes), len(others)))
        hit = _linked(common, n[:, None].astype(np.float64), m[None, :], percent) & (label[:, None] != other_label[None, :])
        u, v = np.nonzero(hit)
        pairs = np.unique(np.stack([label[u], other_label[v]]), axis=1)
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    slot = F.pmod(F.xxhash64("hub", "i", "j"), F.lit(SLICES))
    found = [blocks.where(slot == k).join(sets, "node").groupBy("hub", "i", "j").applyInArrow(compare, "a long, b long") for k in range(SLICES)]
    return reduce(DataFrame.unionByName, [stage(links, "links") for links in found])


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document of (doc_id, text); other columns are not looked at.

    component_id is the smallest doc_id reachable by links. A text with fewer words than a shingle is one shingle; a null
    text or one without words has none and links with nothing. Rows with equal sets are one node, whatever their number;
    rows with null doc_id link others but name no component. An empty table gives an empty table.
    """
    shown = stage(_shingled(docs, words, percent), "shingled", "zstd")
    slices = [stage(_shared(shown, k), "shared-fragments") for k in range(SLICES)]
    shared = reduce(DataFrame.unionByName, slices)
    made = stage(shown.select("doc_id", "n", "node"), "sets")
    discard(shown)  # the signatures, the largest table here
    groups = stage(_candidates(shared, made.where("node is not null")), "candidate-groups")
    discard(*slices)
    full = made.where("node is not null")
    names = full.groupBy("node").agg(F.min("doc_id").alias("rep"))
    wanted = groups.select("node").unionByName(groups.select(F.col("hub").alias("node"))).distinct().join(names, "node")
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = stage(_fragments(texts.where("text is not null").dropDuplicates(["doc_id", "text"]), words, CUTS), "fragments")
    direct = _pair_links(groups, sets, percent)
    labels = components(direct)
    more = _rest_links(groups, labels, sets, percent)
    discard(sets, direct)
    merged = components(more).select(F.col("node").alias("label"), F.col("label").alias("merged"))
    labels = labels.join(merged, "label", "full").select(
        F.coalesce("node", "label").alias("node"), F.coalesce("merged", "label").alias("label"))
    named = names.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    result = made.select("doc_id", "n", "node").join(named.join(smallest, "label").select("node", "component_id"), "node", "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
