"""Known counts of the domain tables."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from growthloom.operators import filters, members, ops
from growthloom.sources.fixtures import AS_OF_ORDERS, Tables, as_ts

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF001)


def test_membership_events(t):
    out = members.transitions(t.orders, "o_custkey", "price_cents", "o_orderdate", "o_orderkey")
    got = {r["event_type"]: r["count"] for r in out.groupBy("event_type").count().collect()}
    assert got == {"created": 1500, "upgraded": 4480, "downgraded": 4449, "reactivated": 856, "renewed": 3715}


@pytest.mark.parametrize("sf,want", [("0.001", 3), ("0.01", 22), ("0.1", 254)])
def test_members_due_in_five_days(spark, sf, want):
    m = Tables(spark, f"/root/testdata/sf{sf}").memberships.where("status = 'active'")
    assert filters.due_within(m, "current_period_end", as_ts(AS_OF_ORDERS), 5).count() == want


def test_content_rows(t):
    assert t.content_events.count() == 6034


def test_hours_with_three_failures(t):
    counts = ops.failure_counts(t.execution_logs)
    assert counts.where("failures >= 3").count() == 35


def test_affiliate_tiers(t):
    got = {r["tier"]: r["count"] for r in t.affiliates.groupBy("tier").count().collect()}
    assert got == {"standard": 38, "premium": 34, "elite": 28}
    assert t.affiliates.where("not is_active").count() == 6


def test_quick_conversions(t):
    days = F.datediff("converted_at", "clicked_at")
    assert t.referrals.where(days.between(0, 60)).count() == 1483


def test_orphans_and_duplicate_lines(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    lines = t.purchase_items
    assert t.purchases_hist.join(lines, F.col("id") == F.col("purchase_id"), "left_anti").count() == 257
    assert lines.select("purchase_id", "line_no").distinct().count() == 45832
