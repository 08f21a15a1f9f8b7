"""The mart by signed changes against a full rebuild."""
from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows
from growthloom.plans import delta_mart
from growthloom.plans.daily import ADDITIVE, Sources
from growthloom.session import scratch_path
from growthloom.streaming import sinks
from growthloom.streaming.sources import replay

T0 = datetime(2024, 1, 1)


def buys(frame, data):
    return Sources(purchases=frame(data, "id long, product_id long, amount_cents long, status string, created_at timestamp_ntz"),
                   products=frame([(1, "tripwire"), (2, "membership")], "id long, product_type string"))


def days_of(spark, path, column):
    return dict(rows(delta_mart.read(spark, path), "metric_date", column))


def test_refunds_and_old_events_touch_their_days_only(spark, frame):
    path = scratch_path(spark, "t-mart")
    data = [(i, 1 + i % 2, 100 + i, "completed", T0 + timedelta(days=i % 400)) for i in range(800)]
    assert len(delta_mart.apply(delta_mart.changes(buys(frame, data)), path, 0)) == 400
    before = days_of(spark, path, "total_revenue_cents")
    # A sale of a year ago is refunded and another one of that day turns up.
    old, new = [data[3]], [(*data[3][:3], "refunded", data[3][4]), (9000, 2, 7, "completed", data[3][4])]
    touched = delta_mart.apply(delta_mart.changes(buys(frame, new), buys(frame, old)), path, 1)
    assert touched == [date(2024, 1, 4)]
    after = days_of(spark, path, "total_revenue_cents")
    assert {d for d in after if after[d] != before[d]} == {date(2024, 1, 4)} and after[touched[0]] == before[touched[0]] - 103 + 7
    batches = days_of(spark, path, "last_batch")
    assert [d for d, b in batches.items() if b == 1] == touched
    # Equal to a rebuild; and a change that cancels out writes nothing.
    again = scratch_path(spark, "t-mart")
    delta_mart.apply(delta_mart.changes(buys(frame, [r for r in data if r[0] != 3] + new)), again, 0)
    same = lambda p: rows(delta_mart.read(spark, p).drop("last_batch"))
    assert same(path) == same(again)
    assert delta_mart.apply(delta_mart.changes(buys(frame, old), buys(frame, old)), path, 2) == []


def test_a_batch_that_runs_again_adds_nothing(spark, frame):
    path = scratch_path(spark, "t-mart")
    one = delta_mart.changes(buys(frame, [(1, 1, 5, "completed", T0), (2, 1, 6, "completed", T0 + timedelta(days=1))]))
    delta_mart.apply(one, path, 0)
    delta_mart.apply(one, path, 1)
    delta_mart.apply(one, path, 1)
    assert days_of(spark, path, "tripwire_revenue_cents") == {date(2024, 1, 1): 10, date(2024, 1, 2): 12}
    assert set(delta_mart.read(spark, path).columns) == {*ADDITIVE, "last_batch", "metric_date"}


def test_late_stream_equals_the_rebuild(spark, frame):
    rnd = random.Random(5)
    data = [(i, rnd.choice(["profile_visit", "landing_page_view"]), T0 + timedelta(hours=i), T0 + timedelta(hours=i + (100 if i % 10 == 0 else 0))) for i in range(300)]
    events = frame(data, "id long, stage string, created_at timestamp_ntz, arrives timestamp_ntz").withColumn("at", F.col("created_at"))
    path = scratch_path(spark, "t-mart")
    sink = sinks.MartSink(path, "2 days", lambda df: Sources(funnel=df))
    last = sinks.run_batches(replay(events, "arrives", 6), sink, f"{path}-checkpoint")
    assert last >= 4
    late = {r["id"] for r in spark.read.parquet(f"{path}/late").select("id").collect()}
    assert late and late <= set(range(0, 300, 10))
    want = scratch_path(spark, "t-mart")
    delta_mart.apply(delta_mart.changes(Sources(funnel=events)), want, 0)
    assert rows(delta_mart.read(spark, sink.mart).drop("last_batch")) == rows(delta_mart.read(spark, want).drop("last_batch"))
