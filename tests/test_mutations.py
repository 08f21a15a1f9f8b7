"""Upserts, quality rules and visibility on hand-made rows."""
from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from growthloom import schemas
from growthloom.plans import drafts
from growthloom.operators import access, filters, quality as Q, upsert as U
from growthloom.sources import layout, sinks, tables
from growthloom.sources.fixtures import RAW
from growthloom.session import scratch_path, stage

DDL = "k string, v long, w string, t long"


@pytest.fixture
def target(frame):
    return frame([("a", 1, "x", 0), ("b", 2, None, 0), ("c", 3, "z", 0)], DDL)


@pytest.fixture
def source(frame):
    # "b" comes twice, the later row counts; "d" is new; "a" sets a value to NULL.
    return frame([("b", 20, "q", 1), ("b", 21, "r", 2), ("d", 40, "s", 1), ("a", None, "n", 1)], DDL)


def test_upsert(target, source):
    out = U.upsert(target, source, ["k"], ["v", "t"], ["t"])
    assert rows(out) == sorted(
        [("a", None, "x", 1), ("b", 21, None, 2), ("c", 3, "z", 0), ("d", 40, "s", 1)], key=repr
    )


def test_upsert_is_idempotent(target, source):
    once = U.upsert(target, source, ["k"], ["v", "t"], ["t"])
    assert rows(U.upsert(once, source, ["k"], ["v", "t"], ["t"])) == rows(once)


def test_insert_ignore(target, source):
    out = U.insert_ignore(target, source, ["k"], ["t"])
    assert rows(out) == sorted([*rows(target), ("d", 40, "s", 1)], key=repr)
    assert rows(U.insert_ignore(out, source, ["k"], ["t"])) == rows(out)
    new = {r[0] for r in rows(U.new_rows(target, source, ["k"], ["t"]))}
    clash = {r[0] for r in rows(source)} & {r[0] for r in rows(target)}
    assert new | clash == {r[0] for r in rows(source)} and not new & clash


def test_deltas_sum_before_they_are_added(target, frame):
    deltas = frame([("a", 5), ("a", 6), ("zz", 1), (None, 9)], "k string, d long")
    assert rows(U.apply_deltas(target, deltas, "k", {"v": "d"}), "k", "v") == [("a", 12), ("b", 2), ("c", 3)]


def test_update_from_keeps_unmatched(target, frame):
    src = frame([("a", 9), ("c", None)], "k string, n long")
    out = U.update_from(target, src, ["k"], {"v": F.col("n"), "seen": F.lit(True)})
    assert rows(out, "k", "v", "seen") == sorted([("a", 9, True), ("b", 2, None), ("c", None, True)], key=repr)


def test_tags(frame):
    tags = frame([(1, "s"), (2, "s"), (3, "other")], "subscriber_id long, tag string")
    who = frame([(1,), (1,), (3,)], "subscriber_id long")
    assert rows(U.tag(tags, who, "s")) == [(1, "s"), (2, "s"), (3, "other"), (3, "s")]
    assert rows(U.swap_tag(tags, who, "s", "done")) == [(1, "done"), (2, "s"), (3, "done"), (3, "other")]


def test_touch(frame):
    df = frame([(1, 10, True), (2, 20, False), (3, 30, None)], "id long, updated_at long, changed boolean")
    assert rows(U.touch(df, F.col("changed"), F.lit(99).cast("long")), "id", "updated_at") == [(1, 99), (2, 20), (3, 30)]


def test_split_keeps_every_row(frame):
    df = frame([(1, "view", 5), (2, None, 5), (3, "odd", -1), (4, "odd", None)], "id long, stage string, n long")
    rules = {"stage_known": F.col("stage").isin("view"), "n_positive": F.col("n") > 0}
    ok, bad = Q.split_rules(df, rules)
    assert rows(ok, "id") == [(1,), (2,)]  # a NULL breaks no domain rule
    assert {r["id"]: r["failed_rules"] for r in bad.collect()} == {3: ["stage_known", "n_positive"], 4: ["stage_known"]}


def test_enum_domains_are_complete():
    assert len(schemas.TABLES) == 28 and len(schemas.ENUMS) == 24
    for table, column in schemas.ENUMS:
        assert column in schemas.schema_of(table).fieldNames()
    for table, cols in schemas.DEFAULTS.items():
        assert set(cols) <= set(schemas.schema_of(table).fieldNames())


def test_enum_rule(frame):
    df = frame([("gold",), ("elite",), (None,)], "tier string")
    assert rows(df.select(Q.enum_rule("affiliates", "tier"))) == [(False,), (True,), (True,)]


def test_unique_ignores_null_keys(frame):
    df = frame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", None), ("b", None)], "k string, n long")
    assert rows(Q.violations_unique(df, ["k", "n"])) == [("a", 1, 2)]


def test_fk_ignores_null_links(frame):
    child, parent = frame([(1, "p"), (2, "q"), (3, None)], "id long, link string"), frame([("p",), (None,)], "key string")
    assert rows(Q.violations_fk(child, parent, "link", "key"), "id") == [(2,)]


def test_range_edges(frame):
    df = frame([(0,), (1,), (10,), (11,), (None,)], "n long")
    assert rows(Q.violations_range(df, "n", 0, 10)) == [(11,)]
    assert rows(Q.violations_range(df, "n", 0, 10, open_low=True)) == [(0,), (11,)]


def test_hook_import(frame):
    new = frame([(1, "h1", "Money", 11.5), (2, "h1", "Money", 3.0), (3, "h2", "Odd", 5.0), (4, "h3", "Money", -2.0), (5, "old", "Money", 5.0)],
                "id long, hook_text string, category string, estimated_performance double")
    old = frame([("old",)], "hook_text string")
    out = Q.import_hooks(new, old, ["Money"])
    assert rows(out, "hook_text", "id", "estimated_performance") == [("h1", 1, 10.0), ("h3", 4, 0.0)]


def test_defaults_fill_only_gaps(frame):
    df = frame([(None, None, None), ("eur", 7, "paid")], "currency string, fee_cents long, status string")
    assert rows(tables.with_defaults(df, "purchases")) == [("eur", 7, "paid"), ("usd", 0, "pending")]


def test_typed_scan_adds_computed_columns(spark, frame):
    path = scratch_path(spark, "items")
    frame([("i", "p", "x", 3, 250)], "id string, purchase_id string, product_id string, quantity int, unit_price_cents long").write.parquet(path)
    got = tables.read_table(spark, "purchase_items", path)
    assert got.first()["total_cents"] == 750 and got.first()["access_granted"] is None


def test_gate_and_route(frame):
    df = frame([(1, "invoice.payment_failed"), (2, "ping"), (3, None)], "id long, type string")
    gated = filters.gate(df, "type")
    skipped, kept = filters.route(gated, F.col("skip"))
    assert rows(skipped, "id") == [(2,), (3,)] and rows(kept, "id", "reason") == [(1, None)]
    yes, no = filters.route(df, F.col("type") == "ping")
    assert rows(yes, "id") == [(2,)] and rows(no, "id") == [(1,), (3,)]


def test_lookback_has_both_edges(frame):
    df = frame([(i, f"2024-01-0{i} 00:00:00") for i in range(1, 6)], "id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    now = F.lit("2024-01-04").cast("timestamp_ntz")
    assert rows(filters.lookback(df, "ts", now, "2 days"), "id") == [(2,), (3,), (4,)]
    assert rows(filters.due_within(df, "ts", now, 1), "id") == [(4,), (5,)]
    assert rows(filters.on_day(df, "ts", "2024-01-03"), "id") == [(3,)]


def test_visibility(frame):
    profiles = frame([(1, "u1"), (2, "u2")], "id long, auth_id string")
    purchases = frame([(10, 1), (11, 2), (12, None)], "id long, profile_id long")
    items = frame([(100, 10), (101, 11), (102, 12)], "id long, purchase_id long")
    videos = frame([(1, "draft"), (2, "published")], "id long, status string")
    plans = frame([(1, True), (2, False), (3, None)], "id long, is_active boolean")
    t = {"profiles": profiles, "purchases": purchases, "purchase_items": items, "content_videos": videos, "membership_plans": plans}
    assert rows(access.visible(t, "profiles")) == [] and rows(access.visible(t, "purchases", "anon")) == []
    assert rows(access.visible(t, "content_videos"), "id") == [(2,)]
    assert rows(access.visible(t, "membership_plans"), "id") == [(1,)]
    assert rows(access.visible(t, "profiles", "authenticated", "u1"), "id") == [(1,)]
    assert rows(access.visible(t, "purchases", "authenticated", "u1"), "id") == [(10,)]
    assert rows(access.visible(t, "purchase_items", "authenticated", "u2"), "id") == [(101,)]
    assert rows(access.visible(t, "purchase_items", "authenticated", "nobody"), "id") == []
    assert rows(access.visible(t, "purchases", "service_role"), "id") == [(10,), (11,), (12,)]


def test_write_rules(frame):
    profiles = frame([(1, "u1"), (2, "u2")], "id long, auth_id string")
    ev = frame([(1, 1), (2, 2), (3, None)], "id long, profile_id long")

    def ok(table, role, uid=None):
        return rows(access.check_writes(ev, profiles, table, role, uid).where("accepted"), "id")

    assert ok("analytics_funnel_events", "anon") == [(3,)] and ok("analytics_page_views", "anon") == [(3,)]
    assert ok("analytics_funnel_events", "authenticated", "u1") == [(1,), (3,)]
    me = access.check_writes(profiles, profiles, "profiles", "authenticated", "u2")
    assert rows(me.where("accepted"), "id") == [(2,)]
    assert ok("analytics_page_views", "authenticated", "u1") == [(1,), (3,)]
    assert ok("purchases", "authenticated", "u1") == [] and ok("purchases", "service_role") == [(1,), (2,), (3,)]


def test_partition_overwrite_touches_only_given_days(spark, frame):
    path = scratch_path(spark, "mart")
    sinks.overwrite_partitions(frame([("d1", 1), ("d2", 2)], "day string, n long"), path, "day")
    sinks.overwrite_partitions(frame([("d2", 20)], "day string, n long"), path, "day")
    sinks.overwrite_partitions(frame([("d2", 20)], "day string, n long"), path, "day")
    assert rows(spark.read.parquet(path), "day", "n") == [("d1", 1), ("d2", 20)]


def test_csv_and_append(spark, frame):
    path = scratch_path(spark, "csv")
    sinks.write_csv(frame([("t", 3)], "table_name string, row_count long"), path)
    assert spark.read.option("header", True).csv(path).first()["row_count"] == "3"
    out = scratch_path(spark, "append")
    df = frame([(1, "x")], "a long, b string")
    sinks.append(df, out, ["a"]), sinks.append(df, out, ["a"])
    assert rows(spark.read.parquet(out)) == [(1,), (1,)]


def test_stage_cuts_lineage(spark):
    df = stage(spark.range(3).withColumn("r", F.rand()), "t")
    assert rows(df) == rows(df)
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(RAW))
def test_declared_schemas_are_those_of_the_files(spark, sf, name):
    found = spark.read.parquet(f"{sf}/{name}.parquet").schema
    assert [(f.name, f.dataType) for f in T.StructType.fromDDL(RAW[name])] == [(f.name, f.dataType) for f in found]


def test_delete_with_rules_follows_every_link(frame):
    tables = {
        "profiles": frame([(1, None), (2, 1), (3, 2)], "id long, referred_by long"),
        "memberships": frame([(10, 1, 5), (11, 2, 5)], "id long, profile_id long, plan_id long"),
        "membership_events": frame([(100, 10, 1), (101, 11, 2), (102, 11, 1)], "id long, membership_id long, profile_id long"),
        "purchases": frame([(20, 1), (21, 2), (22, None)], "id long, profile_id long"),
        "membership_plans": frame([(5,), (6,)], "id long"),
    }
    after, refused = Q.delete_with_rules(tables, "profiles", frame([(1,), (1,), (99,)], "id long"))
    assert rows(after["profiles"]) == sorted([(2, None), (3, 2)], key=repr)
    assert rows(after["memberships"], "id") == [(11,)]
    assert rows(after["membership_events"], "id") == [(101,)]  # 100 by membership, 102 by profile
    assert rows(after["purchases"]) == sorted([(20, None), (21, 2), (22, None)], key=repr)
    assert rows(refused) == [] and rows(after["membership_plans"]) == [(5,), (6,)]
    after, refused = Q.delete_with_rules(tables, "membership_plans", frame([(5,), (6,)], "id long"))
    assert rows(refused) == [(5, 2)] and rows(after["membership_plans"]) == [(5,)]


def test_declared_links_name_real_columns():
    for child, link, parent, rule in schemas.LINKS:
        assert link in schemas.schema_of(child).fieldNames() and parent in schemas.TABLES
        assert rule in ("cascade", "set null", "restrict")
    for table, cols in schemas.REQUIRED.items():
        assert set(cols) <= set(schemas.schema_of(table).fieldNames())
    assert set(schemas.REQUIRED) == set(schemas.TABLES)


def test_table_rules(frame):
    df = frame([(1, None, "n", 5), (2, "s", "n", 0), (3, "s", None, 7)], "id long, slug string, name string, price_cents long")
    out = Q.apply_rules(df, Q.table_rules("membership_plans", df.columns))
    assert {r["id"]: r["failed_rules"] for r in out.collect()} == {1: ["slug_required"], 2: ["price_cents_range"], 3: ["name_required"]}


def test_layout_prunes_days_and_replaces_only_written_days(spark, frame):
    path = scratch_path(spark, "layout")
    ddl = "id string, stage string, created_at timestamp, revenue_cents long"
    at = lambda d: datetime(2024, 1, d, 12)
    layout.write_table(frame([("a", "s", at(1), 1), ("b", "s", at(2), 2), ("c", "r", at(2), 3)], ddl), "analytics_funnel_events", path)
    layout.write_table(frame([("d", "s", at(2), 4)], ddl), "analytics_funnel_events", path)
    got = layout.read_days(spark, "analytics_funnel_events", path, "2024-01-01", "2024-01-03")
    assert rows(got, "id", "revenue_cents") == [("a", 1), ("d", 4)]
    plan = layout.read_days(spark, "analytics_funnel_events", path, "2024-01-02", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_mutations_leave_other_rows_alone(frame):
    items = frame([(1, 5, True, "2020-01-01", "old"), (2, 5, False, None, None), (3, 5, True, "2020-01-01", "old")],
                  "purchase_id long, product_id long, access_granted boolean, access_granted_at string, download_url string")
    products = frame([(5, '[{"url": "new"}]')], "id long, file_urls string")
    got = U.grant_access(items, products, frame([(2,), (3,)], "purchase_id long"), F.lit("2024-01-01"))
    assert rows(got, "purchase_id", "access_granted", "access_granted_at", "download_url") == [
        (1, True, "2020-01-01", "old"), (2, True, "2024-01-01", "new"), (3, True, "2020-01-01", "old")]
    flows = frame([(1, "a", "ok"), (2, "b", "ok")], "id long, last_run_at string, last_run_status string")
    logs = frame([(9, 1, "c", "failed")], "id long, workflow_id long, started_at string, status string")
    assert rows(U.refresh_last_run(flows, logs)) == [(1, "c", "failed"), (2, "b", "ok")]
    hooks = frame([(1, 3, "x"), (2, 3, "x")], "id long, times_used long, last_used_at string")
    assert rows(drafts.count_usage(hooks, frame([(2,)], "hook_id long"), F.lit("y"))) == [(1, 3, "x"), (2, 4, "y")]
