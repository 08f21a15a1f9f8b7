"""Content files, packages, templates and reports on small literals."""
from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from growthloom import schemas
from growthloom.functions import exprs as X
from growthloom.operators import affiliates as AF, content as C, email as E, funnel, joins as J, members, ops, revenue
from growthloom.plans import drafts, leads, membership, packages, purchases as P, welcome
from growthloom.session import scratch_path
from growthloom.sources import documents as D, sinks


def put(spark, *texts):
    """One file per text."""
    path = scratch_path(spark, "docs")
    for t in texts:
        spark.createDataFrame([(t,)], "value string").coalesce(1).write.mode("append").text(path)
    return path


def test_hooks_file(spark):
    doc = {"hooks": [{"text": "One.", "category": "Money", "trigger": "Insight", "estimated_performance": 9.1},
                     {"text": "Two\nlines", "category": "Health", "trigger": "Urgency", "estimated_performance": 8}]}
    path = put(spark, json.dumps(doc, indent=1))
    got = rows(D.read_hooks(spark, path), "ordinal", "text", "category", "estimated_performance")
    assert got == [(0, "One.", "Money", 9.1), (1, "Two\nlines", "Health", 8.0)]


def test_grouped_hooks_file(spark):
    doc = {"categories": [{"category": "A", "description": "d", "hooks": ["x", "y"]}, {"category": "B", "hooks": []}]}
    assert rows(D.read_grouped_hooks(spark, put(spark, json.dumps(doc))), "category", "ordinal", "text") == [("A", 0, "x"), ("A", 1, "y")]


def test_script_batches(spark):
    def script(i):
        return {"id": i, "hook": "h", "template": "t", "pillar": "Money", "performance_score": 9.5,
                "voiceover": {"model": "m", "settings": {"stability": 0.35, "clarity": 0.75}, "tone": "x", "script": ["a b", "c"]},
                "visuals": [{"line": 1, "b_roll": "b", "text_overlay": "OV", "position": "center"}],
                "cta": {"text": "go", "placement": "end"}, "thumbnail_concept": "c"}

    path = put(spark, json.dumps([script("s1"), script("s2")], indent=1), json.dumps([script("s3")]))
    df = D.read_scripts(spark, path)
    assert rows(df, "id") == [("s1",), ("s2",), ("s3",)]
    lines = D.explode_lines(df.select("id", F.col("voiceover.script").alias("lines")), "id", "lines")
    assert rows(lines.where("id = 's1'"), "line_no", "line") == [(1, "a b"), (2, "c")]


def test_markdown_sections(spark):
    text = """# Templates
intro
## 1. First (A)
- **Hook:** "Everyone says X."
- **Point 1:** Explain.
- **Point 3:** Show: it.
- **CTA:** "Follow us."
## Notes
ignored
## 12. Twelfth
- **Point 2:** Only this."""
    got = rows(D.read_sections(spark, put(spark, text)), "section_no", "name", "point1", "point2", "point3", "cta")
    assert got == [(1, "First (A)", "Explain.", None, "Show: it.", "Follow us."), (12, "Twelfth", None, "Only this.", None, None)]


def test_inbox_keeps_bad_records(spark):
    path = put(spark, '{"email": "a@b.c", "double_opt_in": true}', '{"email": ', '{"email": 5, "extra": 1}')
    for stream in (False,):
        df = D.read_inbox(spark, path, schemas.LEAD_MESSAGE, stream)
        bad = df.where(F.col("msg._corrupt_record").isNotNull())
        assert rows(bad, "body") == [('{"email": ',)] and df.count() == 3
    assert D.read_inbox(spark, path, schemas.LEAD_MESSAGE, True).isStreaming


def test_timecodes_and_alignment(frame):
    df = frame([("s", ["one two three", "", "four five"], ["V1 a", "V2 b c"])], "id string, lines array<string>, visuals array<string>")
    got = rows(C.timecodes(df, ["id"], "lines", "visuals"), "line_no", "start_s", "end_s", "visual")
    assert got == [(1, 0.0, 1.35, "V1 a"), (2, 1.35, 1.35, "V2 b c"), (3, 1.35, 2.25, "V2 b c")]
    none = frame([("s", ["x"], [])], "id string, lines array<string>, visuals array<string>")
    assert rows(J.align(none, ["id"], "lines", "visuals"), "line_no", "visual") == [(1, None)]
    assert rows(C.timecodes(none, ["id"], "lines", "visuals"), "line_no", "end_s", "visual") == [(1, 0.45, None)]
    empty = frame([("s", [], ["V"]), ("t", None, None)], "id string, lines array<string>, visuals array<string>")
    assert C.timecodes(empty, ["id"], "lines", "visuals").count() == 0


def test_no_text_is_shuffled_for_time_codes(frame):
    df = frame([("s", "Money", ["a b", "c"], 9.5, "a b")], "id string, category string, lines array<string>, score double, hook_text string")
    for made in (packages.packages(df), C.timecodes(df, ["id"], "lines")):
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_package(spark, frame):
    df = frame([("s", "Money", ["a b", "c"], 9.5, "a b")], "id string, category string, lines array<string>, score double, hook_text string")
    row = packages.packages(df, "acme").first()
    assert row["priority"] == "High" and row["total_s"] == 1.35 and row["hashtags"]["instagram"][0] == "#acme"
    assert [(x["line_no"], x["text_overlay"]) for x in row["lines"]] == [(1, "A B"), (2, "C")]
    path = scratch_path(spark, "pk")
    made = packages.packages(df).withColumn("batch", F.lit(1))
    sinks.write_packages(made, path)
    assert spark.read.json(path).first()["lines"][1]["line"] == "c"


# Score of each catalog position, and the positions scripts have used already.
SCORES = [9.2, 9.5, 8.8, 9.1, 8.7, 9.0, 8.5, 9.3, 9.4, 8.9, 9.2, 9.0]
USED = {1, 4, 8}


def test_next_hooks_keep_catalog_order_on_ties(frame):
    hooks = frame([(i, f"hook {i}", s) for i, s in enumerate(SCORES)], "id long, hook_text string, estimated_performance double")
    used = hooks.where(F.col("id").isin(list(USED)))
    picked = C.next_hooks(hooks, used, 5)
    named = C.assign_templates(picked, [F.desc("estimated_performance"), F.asc("id")])
    got = [(r["id"], r["script_id"], r["template_no"], r["voice"]) for r in named.orderBy("position").collect()]
    assert got == [(7, "script-041", "1", "Adam (v2)"), (0, "script-042", "2", "Antoni"), (10, "script-043", "3", "Adam (v2)"),
                   (3, "script-044", "9", "Antoni"), (5, "script-045", "1", "Adam (v2)")]


# Scores of the fifty seed hooks in catalog order, the positions that
# scripts have used, and the published order of the next twenty.
SEED_SCORES = [
    9.2, 9.5, 8.8, 9.1, 8.7, 9.0, 8.5, 9.3, 9.4, 8.9, 8.6, 8.9, 8.8, 9.6, 9.0, 9.2, 9.1, 8.7, 8.9, 9.3, 9.0, 9.2, 9.4, 8.8, 9.5,
    8.7, 8.9, 9.1, 9.3, 9.5, 9.2, 8.6, 9.0, 9.4, 9.1, 8.5, 8.7, 9.6, 8.8, 8.4, 9.5, 8.9, 9.0, 8.7, 9.2, 9.3, 8.9, 9.1, 9.0, 9.7,
]
SEED_USED = [1, 2, 4, 5, 6, 8, 9, 10, 11, 12, 14, 15, 17, 18, 20, 21, 22, 23, 24, 25, 26, 28, 30, 31, 33, 34, 36, 38, 40, 42]
PUBLISHED = [49, 13, 37, 29, 7, 19, 45, 0, 44, 3, 16, 27, 47, 32, 48, 41, 46, 43, 35, 39]


def test_published_order_of_the_seed_hooks(frame):
    ddl = "id long, hook_text string, category string, estimated_performance double"
    hooks = frame([(i, f"hook {i}", "Money", s) for i, s in enumerate(SEED_SCORES)], ddl)
    picked = C.next_hooks(hooks, hooks.where(F.col("id").isin(SEED_USED)), 20)
    order = [F.desc("estimated_performance"), F.asc("id")]
    named = C.assign_templates(picked, order, prefix="s-")
    scored = named.withColumn("score", F.col("estimated_performance")).withColumn("priority", packages.X.priority("score"))
    rows_ = scored.select("id", "hook_text", "category", "score", "priority", "script_id", "template_no").orderBy("script_id").collect()
    assert [r["id"] for r in rows_] == PUBLISHED
    assert [r["script_id"] for r in rows_] == [f"s-{n:03}" for n in range(41, 61)]
    assert [r["priority"] for r in rows_] == ["High"] * 7 + ["Medium"] * 13
    assert [r["template_no"] for r in rows_] == ["1", "2", "3", "9"] * 5
    numbered = packages.manifest(scored, order)
    lines = packages.manifest_lines(numbered).orderBy("order_no").collect()
    assert lines[0]["line"] == "| 49 | hook 49 | Money | 9.7 | High | 1 |" and lines[19]["order_no"] == 20


def test_random_pick_is_repeatable(spark):
    df = spark.range(100).repartition(7)
    a, b = C.random_pick(df, "id", 5, 1), C.random_pick(df.repartition(3), "id", 5, 1)
    assert rows(a) == rows(b) and rows(a) != rows(C.random_pick(df, "id", 5, 2)) and a.count() == 5


def test_winner_of_variant_groups(frame):
    df = frame([(1, "g", 8.0), (2, "g", 9.0), (3, "g", 9.0), (4, "h", None)], "id long, variant_group string, actual_performance double")
    assert rows(J.pick_winner(df), "id", "winning_variant_id") == [(1, 2), (2, 2), (3, 2), (4, None)]


def test_version_chain(frame):
    links = [(i, i - 1 if i else None) for i in range(40)] + [(100, 999), (101, 100)]
    got = {r["id"]: (r["root"], r["depth"]) for r in J.version_lineage(frame(links, "id long, previous_version_id long")).collect()}
    assert got == {**{i: (0, i) for i in range(40)}, 100: (100, 0), 101: (100, 1)}


def test_version_cycle_is_an_error(frame):
    with pytest.raises(ValueError):
        J.version_lineage(frame([(1, 2), (2, 1)], "id long, previous_version_id long"), max_depth=16).collect()


def test_or_lookup_prefers_the_first_key(frame):
    left = frame([(1, "a", "y"), (2, None, "y"), (3, "zz", "x"), (4, None, None)], "n long, k1 string, k2 string")
    right = frame([(10, "a", "x"), (20, "b", "y"), (30, None, None)], "pid long, r1 string, r2 string")
    got = rows(J.or_lookup(left, right, [("k1", "r1"), ("k2", "r2")], ["pid"]), "n", "pid", "matched_on")
    assert got == [(1, 10, "k1"), (2, 20, "k2"), (3, 10, "k2"), (4, None, None)]


def test_audience(frame):
    camps = frame([(1, ["t", "u"], ["x"]), (2, ["u"], [])], "campaign_id long, target_tags array<string>, exclude_tags array<string>")
    tags = frame([(7, "t"), (7, "u"), (8, "u"), (8, "x"), (9, "x")], "subscriber_id long, tag string")
    assert rows(J.audience(camps, tags), "campaign_id", "subscriber_id") == [(1, 7), (2, 7), (2, 8)]


def test_idle_workflow_stays(frame):
    wf, logs = frame([(1, "a"), (2, "b")], "id long, name string"), frame([(5, 1, "failed", 0), (6, 1, "success", 9)], "id long, workflow_id long, status string, t long")
    got = rows(J.workflow_logs(wf, logs, F.col("t") > 5), "id", "run_id")
    assert got == [(1, 6), (2, None)]
    assert rows(J.workflow_logs(wf, logs, F.col("t") > 5, keep_idle=False), "id") == [(1,)]


def test_health_gate(frame):
    logs = frame([(i, 1 if i < 20 else 2, "failed" if i in (0, 25) else "success", datetime(2024, 1, 1)) for i in range(30)],
                 "id long, workflow_id long, status string, started_at timestamp_ntz")
    wf = frame([(1, "a"), (2, "b"), (3, "idle")], "id long, name string")
    report = ops.health(wf, logs, F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    got = rows(ops.health_gate(report), "name", "success_rate", "below_floor", "band", "all_pass")
    assert got == sorted([("a", 95.0, False, "warning", False), ("b", 90.0, True, "critical", False), ("idle", None, False, None, False)], key=repr)


def test_alert_rule(frame):
    counts = frame([(1, 3, 100), (2, 2, 100), (3, 1, 2), (4, 1, 3), (5, 0, 0)], "w long, failures long, runs long")
    assert rows(ops.alerts(counts), "w", "reason") == [(1, "failure_count"), (3, "failure_share")]


def test_latency_from_daily_sketches(frame):
    logs = frame([(1, datetime(2024, 1, 1 + s % 7), float(s)) for s in range(1, 101)] + [(2, datetime(2024, 1, 1), None)],
                 "workflow_id long, started_at timestamp_ntz, s double")
    days = ops.latency_by_day(logs, F.col("s"))
    assert days.count() == 8
    got = {r["workflow_id"]: r for r in ops.latency(days).collect()}
    assert (got[1]["p50_s"], got[1]["p95_s"], got[1]["max_s"], got[1]["fast_share"]) == (50.0, 95.0, 100.0, 0.29)
    assert got[2]["p50_s"] is None and got[2]["runs"] == 1


def test_sketches_of_many_values_keep_ranks_and_size(spark):
    n = 300_000
    logs = spark.range(n).select(F.lit(1).alias("workflow_id"), (F.col("id") % 9 * F.expr("interval 1 day") + F.lit(datetime(2024, 1, 1))).alias("started_at"),
                                 (F.pmod(F.col("id") * 7919, F.lit(n)) / 10).alias("s"))
    days = ops.latency_by_day(logs, F.col("s"))
    got = ops.latency(days).first()
    assert abs(got["p50_s"] * 10 / n - 0.5) < 0.01 and abs(got["p95_s"] * 10 / n - 0.95) < 0.01 and got["runs"] == n
    assert days.agg(F.max(F.length("times"))).first()[0] < 200_000


def test_latency_is_exact_and_interpolated(frame):
    times = [float((n * 7919) % 20_011) / 4 for n in range(20_000)]
    logs = frame([(1, s) for s in times] + [(1, None), (None, 2.0), (None, 5.0), (3, None), (4, 29.99), (4, 29.99), (4, 30.0)], "workflow_id long, s double")
    for cut in (4_000_000, 50):
        got = {r["workflow_id"]: r for r in ops.latency_exact(logs, F.col("s"), cut).collect()}
        low = sorted(times)
        want = [low[int(x)] * (1 - x % 1) + low[int(x) + 1] * (x % 1) for x in (0.5 * 19_999, 0.95 * 19_999)]
        assert all(abs(got[1][c] - w) < 0.00051 for c, w in zip(("p50_s", "p95_s"), want)) and got[1]["runs"] == 20_001 and got[1]["max_s"] == low[-1]
        assert (got[None]["p50_s"], got[None]["p95_s"], got[None]["runs"]) == (3.5, 4.85, 2)
        assert (got[3]["p50_s"], got[3]["runs"], got[3]["fast_share"]) == (None, 1, 0.0)
        assert (got[4]["p50_s"], got[4]["p95_s"], got[4]["fast_share"]) == (29.99, 29.999, 0.6667)


def test_running_sums_of_a_long_script(frame):
    lines = [("w " * (n % 5)).strip() for n in range(5000)]
    got = [(r["start_s"], r["end_s"]) for r in C.timecodes(frame([("s", lines)], "id string, lines array<string>"), ["id"], "lines").orderBy("line_no").collect()]
    ends = [0]
    for line in lines:
        ends.append(ends[-1] + len(line.split()))
    assert got == [(round(a * 45 / 100, 2), round(b * 45 / 100, 2)) for a, b in zip(ends, ends[1:])]


def test_funnel_report_with_empty_base(frame):
    ev = frame([("content_view",)] * 100 + [("profile_visit",)] * 5, "stage string")
    got = {r["stage"]: (r["volume"], r["conversion_pct"], r["health"]) for r in funnel.funnel_table(ev).collect()}
    assert got["profile_visits"] == (5, 5.0, "optimal") and got["lp_visits"] == (0, 0.0, "blocked")
    assert got["email_optins"] == (0, None, "blocked") and got["content_views"] == (100, None, None)


def test_strict_funnel_needs_time_order(frame):
    t = [datetime(2024, 1, 1, h) for h in range(10)]
    ev = frame([("a", "s1", 1, t[1]), ("a", "s2", 2, t[2]), ("a", "s3", 3, t[3]), ("b", "s2", 4, t[1]), ("b", "s1", 5, t[2]),
                ("c", "s1", 6, t[1]), ("c", "s2", 7, t[1]), ("c", "s3", 8, t[5])], "person string, stage string, id long, created_at timestamp_ntz")
    assert rows(funnel.strict_funnel(ev, ["s1", "s2", "s3"]), "stage", "persons") == [("s1", 3), ("s2", 1), ("s3", 1)]


def test_revenue_without_any_rows(frame):
    buys = frame([], "product_id long, amount_cents long, status string")
    prods = frame([(1, "membership")], "id long, product_type string")
    assert tuple(revenue.revenue(buys, prods).first()) == (0, 0, 0, 0)


def test_mrr_counts_each_started_month(frame):
    ts = lambda s: datetime.fromisoformat(s)
    m = frame([("month", 1900, ts("2024-01-15"), None), ("year", 19000, ts("2024-02-01"), None), ("month", 1000, ts("2024-01-01"), ts("2024-02-10"))],
              "plan string, price_cents long, created_at timestamp_ntz, ended_at timestamp_ntz")
    got = rows(members.mrr(m, F.lit("2024-03-20").cast("timestamp_ntz")), "month", "mrr_cents", "members")
    assert got == [(date(2024, 1, 1), 2900, 2), (date(2024, 2, 1), 4483, 3), (date(2024, 3, 1), 3483, 2)]


def test_churn_of_nobody(frame):
    m = frame([], "created_at timestamp_ntz, ended_at timestamp_ntz")
    lo, hi = F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz")
    assert members.churn(m, lo, hi).first().asDict() == {"members_at_start": 0, "churned": 0, "active_members": 0, "churn_rate": None}


def test_payout_threshold(frame):
    c = frame([(1, 3000, "approved", datetime(2024, 1, 5)), (1, 2000, "approved", datetime(2024, 1, 31)), (2, 4999, "approved", datetime(2024, 1, 1)),
               (3, 9000, "pending", datetime(2024, 1, 1)), (4, 9000, "approved", datetime(2024, 2, 1))],
              "affiliate_id long, amount_cents long, status string, created_at timestamp_ntz")
    assert rows(AF.payouts(c, "2024-02-01"), "affiliate_id", "payout_cents") == [(1, 5000)]


def test_inactive_affiliates_earn_nothing(frame):
    buys = frame([(1, 10, 7, 2700, 5, datetime(2024, 1, 1)), (2, 10, 7, 2700, 6, datetime(2024, 1, 1)), (3, 10, 7, 0, 5, datetime(2024, 1, 1))],
                 "id long, product_id long, profile_id long, amount_cents long, affiliate_id long, created_at timestamp_ntz")
    aff = frame([(5, "premium", 30.0, True), (6, "elite", 30.0, False)], "id long, tier string, commission_pct double, is_active boolean")
    prods = frame([(10, "tripwire")], "id long, product_type string")
    got = rows(AF.affiliate_run(buys, aff, prods), "purchase_id", "amount_cents", "effective_pct")
    assert got == [(1, 1188, 44.0), (3, 0, None)]


def test_drip_edges(frame):
    starts = frame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2023, 1, 1))], "subscriber_id long, started_at timestamp_ntz")
    now = F.lit("2024-01-02").cast("timestamp_ntz")
    assert rows(E.next_step(starts, "subscriber_id", "started_at", now), "subscriber_id", "sent_steps", "next_step", "completed") == [
        (1, 2, 3, False), (2, 1, 2, False), (3, 5, None, True)]
    tags = frame([(9, "x")], "subscriber_id long, tag string")
    out = welcome.welcome_run(starts, tags, now - F.expr("interval 1 day"), now)
    assert rows(out.due, "subscriber_id", "step") == [(1, 2), (2, 1)]
    assert rows(out.tags) == [(1, "welcome-started"), (2, "welcome-started"), (3, "welcome-completed"), (9, "x")]


def test_lead_capture(frame):
    now = datetime(2024, 1, 1)
    bodies = ['{"email": " Old@X.com "}', '{"email": "new@x.com", "name": "N1", "source": "referral"}', '{"email": "NEW@x.com", "name": "later"}',
              '{"email": "bad"}', '{"name": "none"}', "not json"]
    msgs = frame([(i, now, b) for i, b in enumerate(bodies)], "id long, received_at timestamp_ntz, body string")
    subs = frame([("old@x.com",)], "email string")
    out = leads.lead_capture(msgs, subs)
    assert rows(out.new_subscribers, "email", "full_name", "source") == [("new@x.com", "N", "referral")]
    assert rows(out.invalid, "id") == [(3,), (4,), (5,)]
    assert out.leads.count() + out.invalid.count() == len(bodies)
    assert ("old@x.com", "lead-magnet") in rows(out.tags, "email", "tag") and ("new@x.com", "source-landing_page") in rows(out.tags, "email", "tag")


def test_checkout_routes(frame):
    def msg(kind, mode, pid=None, price=None):
        return json.dumps({"type": kind, "data": {"object": {"id": "cs", "mode": mode, "amount_total": 2700, "customer": "c1",
                           "customer_details": {"email": "A@b.c", "name": "n"}, "metadata": {"product_id": pid, "price_id": price}}}})

    done = "checkout.session.completed"
    msgs = frame([(1, datetime(2024, 1, 1), msg(done, "payment", "7", "p8")), (2, datetime(2024, 1, 1), msg(done, "subscription")),
                  (3, datetime(2024, 1, 1), msg("ping", "payment")), (4, datetime(2024, 1, 1), msg(done, None, None, "p8")), (5, datetime(2024, 1, 1), "{")],
                 "id long, received_at timestamp_ntz, body string")
    prods = frame([(7, "p7", "tripwire"), (8, "p8", "membership")], "id long, stripe_price_id string, product_type string")
    profs = frame([(1, "a@b.c")], "id long, email string")
    out = P.purchases_from(msgs, prods, profs)
    assert rows(out.purchases, "id", "product_id", "profile_id", "amount_cents") == [(1, 7, 1, 2700), (4, 8, 1, 2700)]
    assert rows(out.subscriptions, "id") == [(2,)] and rows(out.skipped, "id") == [(3,), (5,)]


def test_membership_sync_is_idempotent_and_keeps_first_price(frame):
    def msg(i, sub, start, price, status="active"):
        body = {"type": "customer.subscription.updated", "data": {"object": {"id": sub, "status": status, "customer": "c", "current_period_start": start,
                "current_period_end": start + 86400, "items": {"data": [{"price": {"unit_amount": price}}]}}}}
        return (i, datetime.fromtimestamp(start), json.dumps(body))

    msgs = frame([msg(1, "s1", 86400, 1900), msg(2, "s1", 2 * 86400, 2900, "past_due"), msg(3, "s2", 86400, 0), msg(4, "s3", 86400, 5, "mystery")],
                 "id long, received_at timestamp_ntz, body string")
    cols = "stripe_subscription_id string, status string, current_period_start timestamp_ntz, current_period_end timestamp_ntz, cancel_at_period_end boolean, ended_at timestamp_ntz, price_cents long"
    there = frame([("s1", "active", None, None, False, None, 1000)], cols)
    once = membership.membership_sync(there, msgs)
    assert rows(once, "stripe_subscription_id", "status", "price_cents") == [("s1", "past_due", 1000), ("s2", "active", 0)]
    assert rows(membership.membership_sync(once, msgs)) == rows(once)


def test_prompt_and_draft(frame):
    hooks = frame([(1, "Stop now.", "Money", "1")], "id long, hook_text string, category string, template_no string")
    tpl = frame([("1", "T", "p1", None, "p3", "go")], "template_no string, name string, point1 string, point2 string, point3 string, cta string")
    text = drafts.build_prompt(hooks, tpl, "V", "S").first()["prompt"]
    assert text.split("\n")[2:8] == ["Template: T", "Hook: Stop now.", "Point 1: p1", "Point 2: ", "Point 3: p3", "CTA: go"]
    assert drafts.fill_script(hooks, "Fix {topic} in {category} with {brand}", "Acme").first()["body_text"] == "Stop now.\nFix now in Money with Acme"


def test_posting_hours(frame):
    df = frame([("tiktok", datetime(2024, 1, 4, 23)), ("tiktok", datetime(2024, 1, 5)), ("instagram", datetime(2024, 1, 6))], "platform string, at timestamp_ntz")
    got = rows(C.schedule_posts(df, "at", "platform"), "platform", "post_at")
    assert got == [("instagram", datetime(2024, 1, 7, 10)), ("tiktok", datetime(2024, 1, 5, 19)), ("tiktok", datetime(2024, 1, 6, 21))]


def test_spec_limits(frame):
    texts = [" ".join(["w"] * n) for n in (66, 67, 133, 134, 200, 201)]
    df = frame([(i, t) for i, t in enumerate(texts)], "id long, body string")
    got = {(r["id"], r["platform"]): r["duration_ok"] for r in C.spec_check(df, "body").collect()}
    assert [got[(i, "tiktok")] for i in range(6)] == [False, True, True, True, True, False]
    assert [got[(i, "instagram")] for i in range(6)] == [False, True, True, False, False, False]
    assert [got[(i, "youtube")] for i in range(6)] == [True, True, True, False, False, False]


def test_answer_without_a_hook_keeps_the_one_asked_for(frame):
    df = frame([(1, "plain", "H"), (2, '{"hook": "own", "body": "b"}', "H"), (3, '{"body": "b"}', None)], "id long, text string, asked string")
    assert rows(drafts.ingest_completions(df, "text", ["id"], "asked"), "id", "hook_text", "body_text") == [
        (1, "H", "plain"), (2, "own", "b"), (3, "", "b")]


def test_brand_phrases(frame):
    df = frame([(1, "A Secret \n trick, very."), (2, "secret-trick"), (3, "my secret tricks"), (4, "insecret trick"), (5, None), (6, "trick secret trick just JUST")], "id long, t string")
    got = rows(C.lint(df, "t", X.GUIDE_FORBIDDEN, X.GUIDE_PREFERRED), "id", "forbidden_hits", "passed")
    assert got == [(1, 2, False), (2, 0, True), (3, 0, True), (4, 0, True), (5, 0, True), (6, 2, False)]
