"""Attribution with clicks that last differently long, the affiliate run, and the one-shuffle funnel."""
from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from growthloom.operators import funnel, joins as J
from growthloom.plans import affiliate as AP, keyed

T0 = datetime(2024, 1, 1)
CLICK = "who string, id long, at timestamp_ntz, by long, days int"
BUY = "who string, id long, at timestamp_ntz"


def brute_each(clicks, buys):
    out = {}
    for who, i, at in buys:
        alive = [(c_at, c, by) for w, c, c_at, by, days in clicks if w == who and who is not None and c_at <= at <= c_at + timedelta(days=days)]
        best = max(alive, default=(None, None, None))
        out[i] = (best[1], best[2])
    return out


@pytest.mark.parametrize("limit", [4, 30, keyed.HOT_ROWS])
@pytest.mark.parametrize("seed", [1, 2])
def test_each_click_lasts_its_own_days(frame, limit, seed):
    rnd = random.Random(seed)
    who = lambda: "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", None])
    at = lambda: T0 + timedelta(hours=12 * rnd.randrange(80)) if rnd.random() < 0.7 else T0 + timedelta(days=20)
    clicks = [(who(), i, at(), rnd.randrange(5), rnd.choice([0, 1, 3, 10, 30])) for i in range(150)]
    buys = [(who(), 1000 + i, at()) for i in range(150)] + [("nobody", 2000, T0)]
    got = J.attribute_each(frame(clicks, CLICK), frame(buys, BUY), ["who"], limit).collect()
    assert {r["id"]: (r["click_id"], r["by"]) for r in got} == brute_each(clicks, buys) and len(got) == len(buys)


def test_an_older_click_with_a_longer_life_wins_over_one_that_ran_out(frame):
    clicks = [("a", 1, T0, 7, 90), ("a", 2, T0 + timedelta(days=10), 8, 30)]
    buys = [("a", 10, T0 + timedelta(days=5)), ("a", 11, T0 + timedelta(days=40)), ("a", 12, T0 + timedelta(days=41)), ("a", 13, T0 + timedelta(days=91))]
    got = J.attribute_each(frame(clicks, CLICK), frame(buys, BUY), ["who"])
    assert rows(got, "id", "by") == [(10, 7), (11, 8), (12, 7), (13, None)]


AFFILIATES = "id long, referral_code string, tier string, commission_pct double, is_active boolean, total_earned_cents long, total_paid_cents long, pending_cents long"


def people(frame):
    return frame([(1, "ONE", "standard", 30.0, True, 100, 0, 100), (2, "TWO", "premium", 30.0, True, 0, 0, 0), (3, "THREE", "elite", 25.0, True, 0, 0, 0),
                  (4, "FOUR", "elite", 30.0, False, 0, 0, 0)], AFFILIATES)


def inbox(frame, bodies):
    return frame([(n, T0 + timedelta(minutes=n), b if isinstance(b, str) else json.dumps(b)) for n, b in enumerate(bodies)], "id long, received_at timestamp_ntz, body string")


def test_commission_table(frame):
    """The documented rates: product by tier."""
    want = {("tripwire", 1): 40.0, ("tripwire", 2): 44.0, ("tripwire", 3): 50.0, ("membership", 1): 30.0, ("membership", 2): 33.0, ("membership", 3): 37.5,
            ("automation_package", 1): 20.0, ("automation_package", 2): 22.0, ("automation_package", 3): 25.0}
    sent = inbox(frame, [{"purchase_id": f"{kind}{who}", "affiliate_id": str(who), "amount_cents": 100_000, "product_type": kind, "customer_email": "b@x.io"} for kind, who in want])
    got = {r["source_purchase_id"]: r["effective_pct"] for r in AP.affiliate_sync(sent, people(frame)).commissions.collect()}
    assert got == {f"{kind}{who}": pct for (kind, who), pct in want.items()}


def test_lookup_rates_defaults_and_redelivery(frame):
    sent = inbox(frame, [
        {"purchase_id": "p1", "affiliate_id": "1", "referral_code": "TWO", "amount_cents": 2700, "commission_pct": 10, "customer_email": " A@X.io "},  # id before code, own rate
        {"purchase_id": "p2", "referral_code": "THREE", "amount_cents": 2000, "product_type": "course", "commission_pct": 0, "is_recurring": True, "membership_id": "m"},
        {"purchase_id": "p3", "affiliate_id": "4", "amount_cents": 2000}, {"purchase_id": "p4", "referral_code": "NONE", "amount_cents": 2000}, {"purchase_id": "p5", "amount_cents": 1},
        {"purchase_id": "p6", "affiliate_id": "2"}, {"purchase_id": "p1", "affiliate_id": "1", "amount_cents": 999_999}, "not json", {"affiliate_id": "1", "amount_cents": 5}])
    out = AP.affiliate_sync(sent, people(frame))
    assert rows(out.rejected, "purchase_id", "reason") == [("p3", "inactive"), ("p4", "unknown"), ("p5", "unknown")]
    assert rows(out.commissions, "source_purchase_id", "affiliate_id", "amount_cents", "rate_pct", "commission_type", "effective_pct") == [
        ("p1", 1, 270, 10.0, "one_time", 10.0), ("p2", 3, 625, 25.0, "recurring", 31.25), ("p6", 2, 0, 40.0, "one_time", None)]
    assert rows(out.referrals, "purchase_id", "referred_email", "purchase_amount_cents", "commission_cents") == [("p1", "a@x.io", 2700, 270), ("p2", "", 2000, 625), ("p6", "", 0, 0)]
    assert rows(out.affiliates, "id", "total_earned_cents", "pending_cents") == [(1, 370, 370), (2, 0, 0), (3, 625, 625), (4, 0, 0)]
    linked = out.commissions.join(out.referrals.select(F.col("id").alias("referral_id")), "referral_id").count()
    assert linked == 3 and rows(AP.number_recurring(out.commissions), "source_purchase_id", "recurrence_number") == [("p2", 1)]


def brute_funnel(events, stages):
    reached = []
    for who in {e[0] for e in events if e[0] is not None}:
        n, t = 0, None
        for at, stage in sorted((e[3], e[1]) for e in events if e[0] == who and e[3] is not None):
            if n < len(stages) and stage == stages[n] and (t is None or at > t):
                n, t = n + 1, at
        reached.append(n)
    return [(p, s, sum(n >= p for n in reached)) for p, s in enumerate(stages, 1)]


@pytest.mark.parametrize("limit", [2, 7, 40, funnel.FUNNEL_ROWS])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_funnel_of_hot_persons_equals_brute_force(frame, limit, seed):
    rnd = random.Random(seed)
    stages = ["s1", "s2", "s3", "s2", "s5", "s6"] if seed == 3 else ["s1", "s2", "s3", "s4"]
    events = [(rnd.choice(["hot", "hot", "a", "b", "c", "d", None]), rnd.choice(["s1", "s2", "s3", "s4", "s5", "s6", "zz"]), i,
               T0 + timedelta(minutes=rnd.choice([5, rnd.randrange(60)]))) for i in range(260)] + [("x", "s1", 999, None)]
    got = funnel.strict_funnel(frame(events, "person string, stage string, id long, created_at timestamp_ntz"), stages, limit).collect()
    assert [(r["position"], r["stage"], r["persons"]) for r in got] == brute_funnel(events, stages)


def test_funnel_scans_and_shuffles_the_events_once(spark, sf):
    from growthloom.sources.fixtures import Tables

    out = funnel.strict_funnel(Tables(spark, sf).funnel_events, ["content_view", "landing_page_view", "lead_magnet_download"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "SortMergeJoin" not in final and "CartesianProduct" not in final


def test_funnel_of_nobody(frame):
    got = funnel.strict_funnel(frame([], "person string, stage string, id long, created_at timestamp_ntz"), ["s1", "s2"])
    assert rows(got, "stage", "persons") == [("s1", 0), ("s2", 0)]
