"""A Merkle manifest of a dataset, its tree labelled by nested intervals.

Rows in order have leaf ranks; a node of the tree carries the half-open interval of the ranks it covers. A node's interval
lies inside that of each of its ancestors, so ancestors are attached by containment: level by level from the root down, a
node meets the one node above it whose bucket (its position divided by the fanout) and interval hold its own. A parent keeps
its children with their intervals; what the parent covers less the node's own interval are the node's siblings, those that
end before it on its left, those that begin after it on its right. A proof is the list of (left, right) on the way up.

Every group has a tree of its own; the group roots, in order, are the leaves of one tree above them. No join key holds more
than `fanout` nodes, whatever the size of a group: rows of a hot group spread over its nodes.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.plans.keyed import number_rows
from growthloom.session import stage

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields: `-` for null, else UTF-8 byte count, `:` and the value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256)


def _joined(children: Column, keep) -> Column:
    return F.array_join(F.transform(F.filter(children, keep), lambda c: c["hash"]), "")


def _beside(children: Column, lo: Column, hi: Column) -> Column:
    """(left, right): the parent's children less the interval lo to hi."""
    return F.struct(_joined(children, lambda c: c["hi"] <= lo).alias("left"), _joined(children, lambda c: c["lo"] >= hi).alias("right"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


@dataclass
class Tree:
    """Staged tables. `units` hold the leaves, up to `fanout` each: (no, size, bucket, lo, hi, hash, rows). `levels[i]` are the nodes
    of groups above them, `uppers[i]` the nodes above the group roots `tops`: (no, size, bucket, lo, hi, hash, children)."""
    units: DataFrame
    levels: list[DataFrame]
    tops: DataFrame
    uppers: list[DataFrame]
    groups: int
    fanout: int


def _parents(nodes: DataFrame, fanout: int, keys: list[str]) -> DataFrame:
    """One node over each run of `fanout` nodes: at most that many come together in a group."""
    children = F.array_sort(F.collect_list(F.struct("lo", "hi", "hash")))
    return nodes.groupBy(*keys, F.floor(F.col("bucket") / fanout).alias("bucket")).agg(children.alias("children")).select(
        *keys, "bucket", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
        F.sha2(_joined(F.col("children"), lambda c: F.lit(True)), 256).alias("hash"), "children")


def build(rows: DataFrame, group: str, order: str, leaf: str = "leaf", fanout: int = FANOUT) -> Tree:
    """The tree over rows of (group, order, leaf digest, ...). Groups stand by UTF-8 bytes, null first.

    Leaves of a group ascend by `order`, null first, then by digest; rows with equal digests are interchangeable. Other columns
    ride along in `rows` of the units, so pass only small ones.
    """
    named = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("+"), F.col(group)))
    # The tie lets the sort split rows that repeat; it decides nothing between different ones.
    keyed = stage(rows.withColumns({"__group": named, "__tie": F.monotonically_increasing_id()}), "merkle-leaves")
    ranked = number_rows(keyed, [F.asc("__group"), F.asc_nulls_first(order), F.asc(leaf), F.asc("__tie")], "__rank")
    sizes = keyed.groupBy("__group").agg(F.count(F.lit(1)).alias("size"))
    first = ranked.groupBy("__group").agg(F.min("__rank").alias("__first"))
    groups = stage(number_rows(sizes.join(first, "__group"), [F.asc("__group")], "no"), "merkle-groups").withColumn("no", F.col("no") - 1)
    most, count = groups.agg(F.max("size"), F.count(F.lit(1))).first()
    placed = ranked.join(groups, "__group").withColumn("bucket", F.floor((F.col("__rank") - F.col("__first")) / fanout))
    kept = F.struct(F.col("__rank").alias("lo"), (F.col("__rank") + 1).alias("hi"), F.col(leaf).alias("hash"),
                    *[c for c in rows.columns if c not in (group, leaf)])
    units = placed.groupBy("no", "size", "bucket").agg(F.array_sort(F.collect_list(kept)).alias("rows")).select(
        "no", "size", "bucket", F.col("rows")[0]["lo"].alias("lo"), F.element_at("rows", -1)["hi"].alias("hi"),
        F.when(F.col("size") == 1, F.col("rows")[0]["hash"]).otherwise(F.sha2(_joined(F.col("rows"), lambda c: F.lit(True)), 256)).alias("hash"),
        "rows")
    units = stage(units, "merkle-units")
    levels, nodes, width = [], units, fanout
    tops = units.where(F.col("size") <= width).select("no", "lo", "hi", "hash")
    while width < (most or 0):  # one small job per level: the logarithm of the largest group to the base of the fanout
        nodes = stage(_parents(nodes.where(F.col("size") > width), fanout, ["no", "size"]), "merkle-level")
        levels.append(nodes)
        width *= fanout
        tops = tops.unionByName(nodes.where(F.col("size") <= width).select("no", "lo", "hi", "hash"))
    tops = stage(tops, "merkle-tops")
    uppers, nodes, left = [], tops.withColumn("bucket", F.col("no")), count
    while left > 1:
        nodes = stage(_parents(nodes, fanout, []), "merkle-upper")
        uppers.append(nodes)
        left = -(-left // fanout)
    return Tree(units, levels, tops, uppers, count, fanout)


def _under(nodes: DataFrame, above: DataFrame, fanout: int, keys: list[str], carried: list[str]) -> DataFrame:
    """Nodes with the path of the node above that contains them, their own step in front."""
    up = above.select(*keys, F.col("bucket").alias("__above"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                      F.col("children").alias("__children"), F.col("path").alias("__path"), *carried)
    held = nodes.withColumn("__above", F.floor(F.col("bucket") / fanout)).join(up, [*keys, "__above"])
    held = held.where((F.col("__lo") <= F.col("lo")) & (F.col("hi") <= F.col("__hi")))
    step = _beside(F.col("__children"), F.col("lo"), F.col("hi"))
    return held.select(*nodes.columns, F.concat(F.array(step), "__path").alias("path"), *carried)


def prove(tree: Tree) -> DataFrame:
    """Every leaf with its own columns, leaf, path (siblings from the leaf to the root), subroot and root."""
    none = F.array().cast(PATH)
    if tree.uppers:
        above = tree.uppers[-1].select("*", none.alias("path"), F.col("hash").alias("root"))
        for nodes in reversed(tree.uppers[:-1]):
            above = stage(_under(nodes, above, tree.fanout, [], ["root"]), "merkle-paths")
        tops = _under(tree.tops.withColumn("bucket", F.col("no")), above, tree.fanout, [], ["root"])
    else:
        tops = tree.tops.select("*", none.alias("path"), F.col("hash").alias("root"))
    tops = stage(tops.select("no", "path", "root", F.col("hash").alias("subroot")), "merkle-paths")
    above, width = None, tree.fanout ** (len(tree.levels) + 1)
    for nodes in [*reversed(tree.levels), tree.units]:
        # Nodes that are the root of their group hang under the upper tree, the others under a node of their group.
        found = nodes.where(F.col("size") <= width).join(tops, "no")
        if above is not None:
            inner = _under(nodes.where(F.col("size") > width), above, tree.fanout, ["no"], ["root", "subroot"])
            found = found.unionByName(inner)
        above = found if nodes is tree.units else stage(found, "merkle-paths")
        width //= tree.fanout
    leaves = above.select("size", "path", "subroot", "root", "rows", F.inline("rows"))
    own = F.when(F.col("size") == 1, F.col("path")).otherwise(F.concat(F.array(_beside(F.col("rows"), F.col("lo"), F.col("hi"))), "path"))
    extra = [c for c in leaves.columns if c not in ("size", "path", "subroot", "root", "rows", "lo", "hi", "hash")]
    return leaves.select(*extra, F.col("hash").alias("leaf"), own.alias("path"), "subroot", "root")


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, path) of every document; groups are sources, leaves ascend by doc_id.

    Null ids come first in their source, nulls count as `-` in a leaf, a repeated row is a leaf of its own, very long texts are
    hashed like others, an empty table gives no rows. Columns other than those of FIELDS are not looked at.
    """
    leaves = docs.select("doc_id", "source", digest([F.col(c) for c in FIELDS]).alias("leaf"))
    return prove(build(leaves, "source", "doc_id"))


def tampered(text: Column) -> Column:
    """The text with A-Z lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame) -> DataFrame:
    """Every document's proof, and whether it holds after tampering with the texts of ids whose CRC-32 five divides.

    Gives doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Rows without id are left as they are; the rest of
    the edge cases is as in `manifest`.
    """
    fields = [F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    after = digest([*fields[:-1], tampered(F.col("text"))])
    leaves = docs.select("doc_id", "source", digest(fields).alias("leaf"), F.when(hit, after).alias("changed"))
    proved = prove(build(leaves, "source", "doc_id"))
    folded = proved.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
