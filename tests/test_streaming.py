"""Streams cut into many micro-batches must agree with the batch result."""
from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from growthloom.operators import funnel, joins as J, members, ops
from growthloom.session import scratch_path
from growthloom.streaming import jobs, sinks
from growthloom.streaming.runner import run_append, run_update
from growthloom.sources.fixtures import RAW
from growthloom.streaming.sources import read_stream

T0 = datetime(2024, 1, 1)
DDL = "key string, id long, at timestamp, kind int"


def events(seed: int, n: int, disorder_minutes: int = 0):
    """Arrival order is time order up to the given disorder; one key has a third of all."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        at = T0 + timedelta(minutes=7 * i, seconds=rnd.randrange(60))
        out.append((rnd.choice(["hot", "a", "b"]) if i % 3 else "hot", i, at, rnd.choice([0, 1, 1, 2])))
    return sorted(out, key=lambda r: r[2] + timedelta(minutes=rnd.uniform(-1, 1) * disorder_minutes))


@pytest.fixture
def feed(spark):
    """Write chunks as files that arrive one per micro-batch."""

    def make(data, chunks, ddl=DDL):
        path = scratch_path(spark, "feed")
        size = -(-len(data) // chunks)
        for c in range(chunks):
            part = data[c * size:(c + 1) * size]
            spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)

    return make


@pytest.mark.parametrize("disorder,limit", [(0, 4_000_000), (25, 4_000_000), (25, 10)])
def test_attribution_over_many_batches(spark, frame, feed, disorder, limit):
    data = events(1, 150, disorder)
    make = lambda p: sinks.AttributionSink(p, "key", 1, "1 hour", limit)
    got = sinks.run_attribution(feed(data, 6), make, "t-attr")
    both = frame(data, DDL)
    want = {}
    for k, i, at, kind in data:
        if kind == 1:
            near = [(ca, ci) for ck, ci, ca, kk in data if kk == 0 and ck == k and at - timedelta(days=1) <= ca <= at]
            want[i] = max(near, default=(None, None))[1]
    found = got.collect()
    assert {r["id"]: r["click_id"] for r in found} == want and len(found) == len(want)
    batch = J.attribute(both.where("kind = 0"), both.where("kind = 1"), ["key"], 1)
    assert rows(batch, "id", "click_id") == rows(got, "id", "click_id")


def test_a_click_one_batch_after_its_purchase_is_credited(feed):
    minutes = lambda n: T0 + timedelta(minutes=n)
    data = [("a", 1, minutes(0), 0), ("a", 2, minutes(30), 1), ("a", 3, minutes(20), 0), ("a", 4, minutes(200), 2), ("a", 5, minutes(201), 1),
            ("b", 6, None, 1)]
    got = sinks.run_attribution(feed(data, 6), lambda p: sinks.AttributionSink(p, "key", 1), "t-attr")
    assert rows(got, "id", "click_id") == [(2, 3), (5, 3), (6, None)]


@pytest.mark.parametrize("disorder", [0, 4])
def test_abandoned_over_many_batches(feed, disorder):
    data = events(2, 150, disorder)
    got = sinks.run_sink(feed(data, 6), lambda p: sinks.AbandonedSink(p, "key", "1 hour", "10 minutes"), "t-aband", "abandoned")
    end = max(r[2] for r in data) - timedelta(minutes=10)
    hour = timedelta(hours=1)
    want = [
        (i,) for k, i, at, kind in data
        if kind == 1 and at + hour <= end
        and not any(kk == 0 and bk == k and at <= b <= at + hour for bk, _, b, kk in data)
    ]
    assert rows(got, "id") == sorted(want, key=repr)


def test_drip_over_many_batches(feed):
    data = events(3, 900)
    stream = feed(data, 6).select(F.xxhash64("key").alias("subscriber_id"), "at", (F.col("kind") == 1).alias("is_start"))
    got = sinks.run_sink(stream, sinks.DripSink, "t-drip", "steps")
    first = {}
    for k, _, at, kind in data:
        if kind == 1:
            first[k] = min(first.get(k, at), at)
    end = max(r[2] for r in data) - timedelta(hours=1)
    want = sorted((n + 1, t + timedelta(hours=24 * n)) for t in first.values() for n in range(5) if t + timedelta(hours=24 * n) <= end)
    assert sorted((r["step"], r["send_at"]) for r in got.collect()) == want


def test_drip_begins_once_with_the_earliest_start_and_keeps_a_calendar(feed, spark):
    start = [("a", 1, T0 + timedelta(minutes=50), 1), ("a", 2, T0 + timedelta(minutes=30), 1), ("b", 3, T0 + timedelta(hours=5), 1), ("c", 4, T0 + timedelta(hours=5), 0)]
    later = [("c", 5, T0 + timedelta(hours=30), 0), ("a", 6, T0 + timedelta(hours=31), 1), ("c", 7, T0 + timedelta(hours=200), 0), ("a", 8, T0 + timedelta(hours=201), 1), ("c", 9, T0 + timedelta(hours=300), 0)]
    stream = feed(start + later, 9).select(F.col("key").alias("subscriber_id"), "at", (F.col("kind") == 1).alias("is_start"))
    path = scratch_path(spark, "t-drip")
    sinks.run_batches(stream, sinks.DripSink(path), f"{path}-checkpoint")
    want = [(w, n + 1, t + timedelta(hours=24 * n)) for w, t in (("a", T0 + timedelta(minutes=30)), ("b", T0 + timedelta(hours=5))) for n in range(5)]
    assert rows(spark.read.parquet(f"{path}/steps"), "subscriber_id", "step", "send_at") == sorted(want, key=repr)
    assert rows(spark.read.parquet(f"{path}/began"), "subscriber_id") == [("a",), ("b",)]


def test_transitions_are_taken_back_for_any_order_of_arrival(spark, frame, feed):
    rnd = random.Random(17)
    ddl = "who string, price long, at timestamp, id long"
    data = [(rnd.choice(["hot", "hot", "a", "b"]), rnd.choice([100, 150, 160, 400, 90]), T0 + timedelta(days=rnd.randrange(900)), i) for i in range(60)]
    rnd.shuffle(data)
    sent = data + rnd.sample(data, 10)  # some come again
    path = scratch_path(spark, "t-transitions")
    sink = sinks.TransitionSink(path, "who", "price", "at", "id", buckets=4)
    last = sinks.run_batches(feed(sent, 7, ddl), sink, f"{path}-checkpoint")
    want = members.transitions(frame(data, ddl), "who", "price", "at", "id")
    assert last >= 5 and rows(sink.read(spark), *want.columns) == rows(want)
    assert spark.read.parquet(f"{path}/changes").where("sign < 0").count() > 0
    chunk = -(-len(sent) // 7)
    sink(frame(sent[2 * chunk : 3 * chunk], ddl), 2)  # a replay writes the same changes
    assert rows(sink.read(spark), *want.columns) == rows(want)


def test_late_splitter(feed, spark):
    data = [("a", 1, T0, 0), ("a", 2, T0 + timedelta(days=5), 0), ("a", 3, T0 + timedelta(days=1), 0),
            ("a", 4, T0 + timedelta(days=2), 0), ("a", 5, T0 + timedelta(days=6), 0), ("a", 6, T0 + timedelta(days=2, seconds=1), 0)]
    path = scratch_path(spark, "t-late")
    sinks.run_batches(feed(data, 6), sinks.LateSplitter(path, "3 days"), f"{path}-checkpoint")
    late = spark.read.parquet(f"{path}/late").select("id")
    ok = spark.read.parquet(f"{path}/ok").select("id")
    # 4 lies exactly on the limit (in time); 6 is late against the newer clock.
    assert rows(late) == [(3,), (6,)] and rows(ok) == [(1,), (2,), (4,), (5,)]


def test_upsert_mart_over_many_batches(feed, frame):
    data = events(4, 120)
    ddl = "key string, id long, at timestamp, kind int"
    rows_in = feed(data, 5, ddl)
    agg = rows_in.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
    path = scratch_path(agg.sparkSession, "t-upsert")
    sink = sinks.MartUpsert(path, ["key"], ["n", "last"], compact_every=2)
    last = sinks.run_batches(agg, sink, f"{path}-checkpoint", "update")
    got = sink.read(agg.sparkSession.read.parquet(sink.at("delta", last)), last)
    assert last >= 4
    want = frame(data, ddl).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
    assert rows(got, "key", "n", "last") == rows(want, "key", "n", "last")


def test_replayed_batch_changes_nothing(spark, frame):
    path = scratch_path(spark, "t-replay")
    first, second = frame([("a", 1), ("b", 2)], "k string, v long"), frame([("b", 5), ("c", 6)], "k string, v long")
    for every in (1, 2, 20):
        sink = sinks.MartUpsert(f"{path}-{every}", ["k"], ["v"], compact_every=every)
        sink(first, 0), sink(second, 1)
        once = rows(sink.read(first, 1))
        sink(second, 1)
        assert rows(sink.read(first, 1)) == once == [("a", 1), ("b", 5), ("c", 6)]


def test_failure_counts_over_many_batches(feed, frame):
    data = events(5, 200)
    ddl = "workflow_id string, id long, started_at timestamp, kind int"
    def shape(df):
        return df.withColumn("status", F.when(F.col("kind") == 0, "failed").otherwise("success"))

    counts = run_update(jobs.stream_failure_counts(shape(feed(data, 5, ddl))), "t-alerts", ["workflow_id", "window_start"])
    batch = ops.failure_alerts(shape(frame(data, ddl)), "1 hour", "5 minutes")
    cols = ["workflow_id", "window_start", "failures", "runs", "reason"]
    assert rows(ops.alerts(counts), *cols) == rows(batch, *cols)


def test_membership_state_ignores_arrival_order(feed):
    ddl = "stripe_subscription_id string, id long, received_at timestamp, status string, price_cents long, current_period_start timestamp"
    msgs = [("s1", 1, T0, "active", 10, T0), ("s1", 3, T0 + timedelta(days=2), "canceled", 10, T0),
            ("s1", 2, T0 + timedelta(days=1), "past_due", 12, T0), ("s2", 4, T0, "active", 5, T0), ("s2", 5, T0, "trialing", 5, T0)]
    for order in (msgs, msgs[::-1]):
        out = run_update(jobs.stream_members(feed(order, 5, ddl)), "t-members", ["stripe_subscription_id"])
        assert rows(out, "stripe_subscription_id", "status", "last_id", "messages") == [("s1", "canceled", 3, 3), ("s2", "trialing", 5, 2)]


def test_dedup_within_three_days(feed):
    ddl = "id long, at timestamp"
    data = [(1, T0), (2, T0 + timedelta(hours=1)), (1, T0 + timedelta(days=2)), (1, T0 + timedelta(days=2)), (2, T0 + timedelta(days=2, hours=23))]
    out = run_append(jobs.stream_dedup(feed(data, 5, ddl), "id", "at"), "t-dedup")
    assert rows(out, "id") == [(1,), (2,)]


def test_sessions_in_batch_and_stream(feed, frame):
    gap = timedelta(minutes=30)
    times = [T0, T0 + timedelta(minutes=29), T0 + timedelta(minutes=58), T0 + timedelta(minutes=89), T0 + timedelta(hours=5)]
    data = [("p", n, t, n) for n, t in enumerate(times)]
    ddl = "key string, id long, at timestamp, kind int"
    batch = funnel.sessions(frame(data, "key string, id long, at timestamp_ntz, kind int"), "key", "at", "kind", "id")
    got = rows(batch, "session_no", "events", "landing_page", "duration_seconds")
    assert got == [(1, 3, 0, 58 * 60), (2, 1, 3, 0), (3, 1, 4, 0)]
    closed = run_append(jobs.stream_sessions(feed(data, 3, ddl), "key", "at"), "t-sessions")
    assert rows(closed, "events") == [(1,), (3,)]  # the last one is still open
    assert gap.seconds == 1800


def test_session_gap_edge(frame):
    """Exactly thirty minutes of silence stay in one visit, a microsecond more does not."""
    ddl = "key string, id long, at timestamp_ntz, page string"
    half = timedelta(minutes=30)
    data = [("a", 1, T0, "x"), ("a", 2, T0 + half, "y"), ("b", 3, T0, "x"), ("b", 4, T0 + half + timedelta(microseconds=1), "y")]
    out = funnel.sessions(frame(data, ddl), "key", "at", "page", "id")
    assert rows(out, "key", "session_no", "events") == [("a", 1, 2), ("b", 1, 1), ("b", 2, 1)]


def test_read_stream_makes_zoned_times(spark, sf):
    df = read_stream(spark, f"{sf}/events.parquet", RAW["events"], "ts")
    assert df.isStreaming and dict(df.dtypes)["ts"] == "timestamp"


def test_leads_over_many_batches(spark, frame, feed):
    """An address is new once, across batches and against the subscribers there before."""
    ddl = "id long, received_at timestamp, body string"
    mails = ["a@x.y", "B@x.y ", "a@x.y", "old@x.y", "b@x.y", "bad", "c@x.y", "a@x.y"]
    data = [(i, T0 + timedelta(hours=i), '{"email": "%s"}' % m) for i, m in enumerate(mails)]
    path = scratch_path(spark, "t-leads")
    sink = sinks.LeadSink(path, frame([("old@x.y",)], "email string"))
    last = sinks.run_batches(feed(data, 4, ddl), sink, f"{path}-checkpoint")
    new = spark.read.parquet(f"{path}/new_subscribers")
    assert last == 3 and rows(new, "email", "created_at") == [("a@x.y", T0), ("b@x.y", T0 + timedelta(hours=1)), ("c@x.y", T0 + timedelta(hours=6))]
    assert rows(spark.read.parquet(f"{path}/invalid"), "id") == [(5,)]
    # A replay of the second batch must find its own addresses new again.
    sink(frame(data[2:4], ddl), 1)
    assert rows(spark.read.parquet(f"{path}/new_subscribers"), "email") == [("a@x.y",), ("b@x.y",), ("c@x.y",)]
    sink(frame([(0, T0, '{"email": "a@x.y"}')], ddl), 0)
    assert rows(spark.read.parquet(f"{path}/new_subscribers/batch_id=0"), "email") == [("a@x.y",)]


def test_intake_over_many_batches(spark, frame, feed):
    def body(kind, mode, price):
        return ('{"type": "%s", "data": {"object": {"id": "cs", "mode": "%s", "amount_total": 2700, "customer_details": {"email": "a@b.c"},'
                ' "metadata": {"price_id": "%s"}}}}' % (kind, mode, price))

    done = "checkout.session.completed"
    data = [(1, T0, body(done, "payment", "p1"), 5), (2, T0, body(done, "subscription", "p1"), None), (3, T0, body("ping", "payment", "p1"), 5),
            (4, T0, body(done, "payment", "p2"), 6), (5, T0, body(done, "payment", "p1"), None), (6, T0, "{", None)]
    prods = frame([(10, "p1", "tripwire"), (11, "p2", "membership")], "id long, stripe_price_id string, product_type string")
    profs = frame([(7, "a@b.c")], "id long, email string")
    affs = frame([(5, "premium", 30.0, True), (6, "standard", 30.0, False)], "id long, tier string, commission_pct double, is_active boolean")
    path = scratch_path(spark, "t-intake")
    sink = sinks.IntakeSink(path, prods, profs, affs)
    sinks.run_batches(feed(data, 3, "id long, received_at timestamp, body string, affiliate_id long"), sink, f"{path}-checkpoint")

    def table(name, *cols):
        return rows(spark.read.parquet(f"{path}/{name}"), *cols)

    assert table("purchases", "id", "product_id", "profile_id") == [(1, 10, 7), (4, 11, 7), (5, 10, 7)]
    assert table("subscriptions", "id") == [(2,)] and table("skipped", "id") == [(3,), (6,)]
    assert table("commissions", "purchase_id", "amount_cents") == [(1, 1188)]  # 6 is not active


def test_upsert_of_an_empty_stream(spark):
    path = scratch_path(spark, "empty")
    spark.createDataFrame([], "k string, v long").write.parquet(path)
    stream = spark.readStream.schema("k string, v long").parquet(path)
    assert sinks.run_upsert(stream, "t-empty", ["k"], ["v"], mode="append").count() == 0
