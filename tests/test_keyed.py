"""Ordered scans must be exact for ordinary and for very large keys alike."""
from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from growthloom.operators import joins as J
from growthloom.plans import keyed

T0 = datetime(2024, 1, 1)


def make(seed: int, n: int):
    """A third of the rows share one key; some keys are NULL; times tie."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
        at = T0 + timedelta(minutes=rnd.randrange(n // 2))
        out.append((i, key, at, rnd.choice([None, rnd.randrange(-50, 50)])))
    return out


def brute(data):
    want = {}
    for key in {r[1] for r in data}:
        total, low, high, prev = None, None, None, None
        for n, (i, _, at, v) in enumerate(sorted((r for r in data if r[1] == key), key=lambda r: (r[2], r[0])), 1):
            if v is not None:
                total = v if total is None else total + v
                low, high = (v if low is None else min(low, v)), (v if high is None else max(high, v))
            want[i] = (n, prev, total, low, high)
            prev = v
    return want


@pytest.mark.parametrize("limit", [5, 40, keyed.HOT_ROWS])
@pytest.mark.parametrize("seed", [1, 2])
def test_scan_equals_brute_force(frame, limit, seed):
    data = make(seed, 300)
    df = frame(data, "id long, key string, at timestamp_ntz, v long")
    out = keyed.scan_by_key(
        df, ["key"], "at", ["id"],
        {"n": ("rownum", "key"), "prev": ("lag", "v"), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", F.col("v"))},
        rows=limit,
    )
    got = {r["id"]: (r["n"], r["prev"], r["total"], r["low"], r["high"]) for r in out.collect()}
    assert got == brute(data)


def slices_of(df, keys, **options):
    cut = keyed.slice_hot_keys(df, keys, "at", tie=["id"], **options).select(*keys, "at", "id", "_hot", "_slice").collect()
    return [(tuple(r[k] for k in keys), r["at"], r["id"], r["_hot"], r["_slice"]) for r in cut]


def test_hot_key_is_cut_into_several_slices(frame):
    got = slices_of(frame(make(3, 400), "id long, key string, at timestamp_ntz, v long"), ["key"], rows=100)
    assert len({s for (k,), _, _, hot, s in got if k == "hot" and hot}) >= 2
    ordinary = [k for (k,), _, _, hot, _ in got if not hot]
    assert all(ordinary.count(k) <= 130 for k in set(ordinary)) and "hot" not in ordinary


@pytest.mark.parametrize("descending", [False, True])
def test_bursts_and_rows_of_one_instant_are_cut_in_order(frame, descending):
    # 190 of 200 rows at one instant, 900 of 1000 within three days of a month, and rows without a time.
    data = [(i, "one", T0 + timedelta(days=i if i < 10 else 5)) for i in range(200)]
    data += [(i, "burst", T0 + timedelta(days=i % 30, minutes=i)) for i in range(1000, 1100)]
    data += [(i, "burst", T0 + timedelta(days=15, seconds=288 * (i - 1100))) for i in range(1100, 2000)]
    data += [(i, "none", None) for i in range(3000, 3100)] + [(4000, "few", T0), (4001, None, T0)]
    got = slices_of(frame(data, "id long, key string, at timestamp_ntz"), ["key"], rows=40, descending=descending)
    depth, spread = {}, {}
    for (k,), _, _, _, s in got:
        depth[k, s] = depth.get((k, s), 0) + 1
    assert max(depth.values()) <= 60
    for (k,), at, i, _, s in got:
        spread.setdefault(k, []).append(((at is None) == descending, (0 if at is None else (at - T0).total_seconds() * (-1 if descending else 1)), i, s))
    for k, places in spread.items():
        assert [p[-1] for p in sorted(places)] == sorted(p[-1] for p in places), k
    assert len({s for (k,), at, _, _, s in got if k == "one" and at == T0 + timedelta(days=5)}) >= 4


def test_slices_of_a_hot_key_are_dealt_to_several_tasks(spark, frame):
    data = make(6, 600)
    df = frame(data, "id long, key string, at timestamp_ntz, v long")
    out = keyed.scan_by_key(df, ["key"], "at", ["id"], {"n": ("rownum", "key")}, rows=20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = out.where("key = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = sum(r["count"] for r in tasks)
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < hot / 2


@pytest.mark.parametrize("limit", [4, keyed.HOT_ROWS])
def test_attribution_equals_brute_force(frame, limit):
    data = make(5, 240)
    clicks = [(k, i, at) for i, k, at, _ in data if i % 2 == 0]
    buys = [(k, i, at) for i, k, at, _ in data if i % 2 == 1]
    ddl = "key string, id long, at timestamp_ntz"
    out = J.attribute(frame(clicks, ddl), frame(buys, ddl), ["key"], 0, limit)
    assert all(c is None or ca == at for _, _, at, c, ca in rows(out))
    out = J.attribute(frame(clicks, ddl), frame(buys, ddl), ["key"], 1, limit)
    got = {r["id"]: r["click_id"] for r in out.collect()}
    want = {}
    for k, i, at in buys:
        near = [(ca, ci) for ck, ci, ca in clicks if ck == k and ca <= at]
        best = max(near, default=None)
        want[i] = best[1] if best and best[0] >= at - timedelta(days=1) else None
    assert got == want


@pytest.mark.parametrize("limit", [4, keyed.HOT_ROWS])
def test_next_buy_equals_brute_force(frame, limit):
    data = make(7, 240)
    starts = [(k, i, at) for i, k, at, _ in data if i % 3]
    buys = [(k, i, at) for i, k, at, _ in data if i % 3 == 0]
    ddl = "key string, id long, at timestamp_ntz"
    out = J.next_buy(frame(starts, ddl), frame(buys, ddl), "key", limit)
    got = {r["id"]: r["next_at"] for r in out.collect()}
    assert got == {i: min((b for bk, _, b in buys if bk == k and b >= at), default=None) for k, i, at in starts}


def test_abandoned_steps_at_the_edges(frame):
    ddl = "person string, id long, at timestamp_ntz"
    now = datetime(2024, 1, 10)
    starts = [("a", 1, now - timedelta(hours=h)) for h in (0,)] + [
        ("b", 2, now - timedelta(hours=1)), ("c", 3, now - timedelta(hours=24)), ("d", 4, now - timedelta(hours=48)),
        ("e", 5, now - timedelta(hours=60)), ("f", 6, now - timedelta(hours=60)), ("g", 7, now - timedelta(hours=60)),
    ]
    buys = [("e", 8, now - timedelta(hours=12)), ("f", 9, now - timedelta(hours=11, minutes=59)), ("g", 10, now - timedelta(hours=61))]
    out = J.abandoned(frame(starts, ddl), frame(buys, ddl), "person", F.lit(str(now)).cast("timestamp_ntz"))
    # e bought after exactly 48 hours: finished; f a minute later, g before: not.
    assert rows(out, "person", "step") == [("a", 0), ("b", 1), ("c", 2), ("d", 3), ("f", 3), ("g", 3)]


def test_number_rows_is_total_and_gap_free(spark):
    df = spark.range(0, 5000, 1, 17).select("id", (F.col("id") % 3).alias("g"))
    out = keyed.number_rows(df, [F.desc("g"), F.asc("id")], "n")
    got = [(r["n"], r["g"], r["id"]) for r in out.orderBy("n").collect()]
    assert [g[0] for g in got] == list(range(1, 5001))
    assert [g[1:] for g in got] == sorted(((i % 3, i) for i in range(5000)), key=lambda x: (-x[0], x[1]))


def test_zip_rows_keeps_the_shorter_side(frame):
    a, b = frame([(3,), (1,), (2,)], "x long"), frame([("p",), ("q",)], "y string")
    assert rows(J.zip_rows(a, b, [F.asc("x")], [F.desc("y")]), "position", "x", "y") == [(1, 1, "q"), (2, 2, "p")]


def test_latest_by_breaks_ties(frame):
    df = frame([("a", 1, 5, "x"), ("a", 2, 5, "y"), ("b", 1, 1, None)], "k string, id long, t long, v string")
    assert rows(keyed.latest_by(df, ["k"], ["t", "id"]), "k", "id", "v") == [("a", 2, "y"), ("b", 1, None)]
