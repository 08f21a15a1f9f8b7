"""Ordered per-key computations that stay exact when one key is very large.

A plain `Window.partitionBy(key)` sends all rows of a key to one task.  Here a
key with more than about `rows` rows is cut into slices along its order and tie
columns, and the rows are dealt out by key and slice, in one shuffle.  Each slice
is computed on its own and then corrected by a carry, the summary of the slices
before it.

Slices are equally deep: their bounds are every so-manieth row of a sample that a
hash of the row picks, so bursts and rows of one instant are cut too, and every
evaluation of the plan cuts the same slices.  Bounds and carries together hold at
most a few entries per `rows` input rows (about one per two million by default);
that bound is why they are broadcast.  Without a hot key there are no bounds, and
AQE drops both joins.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from growthloom.session import stage

HOT_ROWS = 4_000_000
SAMPLED = 32  # sampled rows of a key per `rows` rows; every SAMPLED / 2 of them is a bound


def micros(ts: Column) -> Column:
    """Timestamp as a long that keeps its order."""
    return F.unix_micros(ts.cast("timestamp"))


def _same(names: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"{prefix}{n}"))
    return cond


def _place(df: DataFrame, order: str, tie: Sequence[str], descending: bool = False) -> Column:
    """A row's place in the scan as one comparable value; rows without an order value come first, or last when descending."""
    at = F.col(order) if dict(df.dtypes)[order] in ("bigint", "int") else micros(F.col(order))
    first = [at.isNull().alias("last"), (-at).alias("at")] if descending else [at.alias("at")]
    return F.struct(*first, *[F.col(c).alias(f"tie{n}") for n, c in enumerate(tie)])


def slice_bounds(df: DataFrame, keys: Sequence[str], place: Column, rows: int = HOT_ROWS) -> DataFrame:
    """(keys as _h_*, _bounds): the first places of the slices of every key with more than about `rows` rows."""
    per = max(1, min(SAMPLED, rows))
    step = max(1, per // 2)
    picked = df.select(*[F.col(k).alias(f"_h_{k}") for k in keys], place.alias("_x"))
    hot = [f"_h_{k}" for k in keys]
    picked = picked.where(F.pmod(F.xxhash64(*hot, "_x"), F.lit(max(1, rows // per))) == 0)
    whole = Window.partitionBy(*hot)
    nth = picked.withColumns({"_nth": F.row_number().over(whole.orderBy("_x")), "_all": F.count(F.lit(1)).over(whole)})
    return nth.where((F.col("_all") > per) & (F.col("_nth") % step == 0)).groupBy(*hot).agg(
        F.array_sort(F.collect_list("_x")).alias("_bounds"))


def _slice_of(bounds: Column, place: Column) -> Column:
    """How many bounds lie at or before the place, by halving steps."""
    steps = F.array(*[F.lit(1 << b) for b in range(30, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(bounds, n + step - 1) <= place, n + step).otherwise(n))


def slice_hot_keys(df: DataFrame, keys: Sequence[str], order: str, rows: int = HOT_ROWS, tie: Sequence[str] = (),
                   descending: bool = False) -> DataFrame:
    """Add `_hot` and `_slice`: 0 for ordinary keys, a slice true to (order, tie) for hot ones.

    `order` is a timestamp or a whole number; rows that are equal in `order` and `tie` stay together.
    """
    place = _place(df, order, tie, descending)
    bounds = slice_bounds(df, keys, place, rows)
    return (
        df.join(F.broadcast(bounds), _same(keys, "_h_"), "left")
        .withColumn("_hot", F.col("_bounds").isNotNull())
        .withColumn("_slice", F.when(F.col("_hot"), _slice_of(F.col("_bounds"), place)).otherwise(F.lit(0)).cast("long"))
        .drop("_bounds", *[f"_h_{k}" for k in keys])
    )


RUNNING = {"sum": F.sum, "max": F.max, "min": F.min, "max_before": F.max}


def scan_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: Sequence[str],
    outputs: dict[str, tuple[str, str | Column]],
    rows: int = HOT_ROWS,
    descending: bool = False,
) -> DataFrame:
    """Ordered scan of every key.

    `order` names a timestamp or whole-number column; `tie` makes the order total.
    `outputs` maps a new column to (kind, value), kind one of lag, rownum, sum,
    max, min, max_before; sum, max and min include the row itself, max_before
    does not.  Plain column names as
    values add nothing to the shuffle.
    """
    keys, values, work = list(keys), {}, df
    for name, (kind, value) in outputs.items():
        if kind not in ("lag", "rownum", *RUNNING):
            raise ValueError(f"unknown kind {kind}")
        if isinstance(value, str):
            values[name] = value
        else:
            values[name] = f"_v_{name}"
            work = work.withColumn(values[name], value)
    work = slice_hot_keys(work, keys, order, rows, tie, descending)

    at = Window.partitionBy(*keys, "_slice").orderBy((F.desc if descending else F.asc)(order), *tie)
    upto = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = at.rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_slice")
    all_before = before.rowsBetween(Window.unboundedPreceding, -1)
    # The last row of a slice in scan order, as an aggregate.
    place = F.struct(order, *tie)

    local, totals, carries = [F.row_number().over(at).cast("long").alias("_rn")], [], []
    for name, (kind, _) in outputs.items():
        value, total = F.col(values[name]), F.col(f"_t_{name}")
        if kind == "lag":
            if descending:
                raise ValueError("lag runs forward only")
            local.append(F.lag(value).over(at).alias(f"_l_{name}"))
            totals.append(F.max_by(F.struct(value.alias("x")), place).alias(f"_t_{name}"))
            carries.append(F.lag(total).over(before)["x"].alias(f"_c_{name}"))
        elif kind == "rownum":
            totals.append(F.count(F.lit(1)).alias(f"_t_{name}"))
            carries.append(F.sum(total).over(all_before).alias(f"_c_{name}"))
        else:
            local.append(RUNNING[kind](value).over(ahead if kind == "max_before" else upto).alias(f"_l_{name}"))
            totals.append(RUNNING[kind](value).alias(f"_t_{name}"))
            carries.append(RUNNING[kind](total).over(all_before).alias(f"_c_{name}"))

    carry = (
        work.where("_hot")
        .groupBy(*keys, "_slice")
        .agg(*totals)
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_k__slice"), *carries)
    )
    out = work.select("*", *local).join(F.broadcast(carry), _same([*keys, "_slice"], "_k_"), "left")
    for name, (kind, _) in outputs.items():
        here, past = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "lag":
            value = F.when(F.col("_rn") == 1, past).otherwise(here)
        elif kind == "rownum":
            value = F.col("_rn") + F.coalesce(past, F.lit(0))
        elif kind == "sum":
            value = F.when(here.isNull(), past).otherwise(here + F.coalesce(past, F.lit(0)))
        else:
            value = (F.least if kind == "min" else F.greatest)(here, past)
        out = out.withColumn(name, value)
    return out.select(*df.columns, *outputs)


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows 1..n in a total order without gathering them in one task.

    The sorted rows are staged, so that the partition offsets and the rows they
    belong to can never come from two different sort runs.
    """
    tagged = df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id())
    fixed = stage(tagged, "numbered")
    part, offset = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = fixed.groupBy(part.alias("_part")).agg((F.max(offset) + 1).alias("_size"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition, so at most spark.sql.shuffle.partitions rows.
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_start"))
    return (
        fixed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + offset + 1)
        .select(*df.columns, name)
    )


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest in `order`; combines map-side, so no key gathers."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(packed.alias("_r")).select(*keys, "_r.*")
