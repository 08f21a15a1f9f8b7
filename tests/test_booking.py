"""Booking of checkout messages: once each, the same by batch and by stream, under replays and redelivery."""
from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest

from conftest import rows
from growthloom.plans import booking
from growthloom.session import scratch_path
from growthloom.streaming import sinks
from growthloom.streaming.sources import replay

T0 = datetime(2024, 1, 1)
DDL = "id long, received_at timestamp, body string"
DONE = "checkout.session.completed"


def body(email, amount, product=None, price=None, mode="payment", kind=DONE, customer="cus"):
    return json.dumps({"type": kind, "data": {"object": {
        "id": "cs", "mode": mode, "amount_total": amount, "customer": customer, "customer_details": {"email": email, "name": f"N {email}"},
        "metadata": {"product_id": product, "price_id": price}}}})


@pytest.fixture
def products(frame):
    return frame([(10, "p10", "tripwire", '[{"url": "u10"}]'), (11, "p11", "membership", None)], "id long, stripe_price_id string, product_type string, file_urls string")


@pytest.fixture
def books(frame):
    subs = frame([("s1", "a@x.io", "A", "lead_magnet", "active", None, 500, None), ("s2", "z@x.io", "Z", "manual", "unsubscribed", True, 0, T0)],
                 "id string, email string, full_name string, source string, status string, has_purchased boolean, ltv_cents long, updated_at timestamp")
    profs = frame([("q1", "b@x.io", "B", "old", None)], "id string, email string, full_name string, stripe_customer_id string, updated_at timestamp")
    return booking.Books(subs, profs, frame([("s1", "vip"), ("s1", "purchased-tripwire")], "subscriber_id string, tag string"))


def tables(added, after):
    return {**{n: rows(df.drop("batch_id")) for n, df in added.items() if n not in ("people", "amounts", "tags")},
            "subscribers": rows(after.subscribers), "profiles": rows(after.profiles), "tags": rows(after.tags)}


def test_one_message_over_all_tables(frame, products, books):
    added, after = booking.book_messages(frame([(1, T0, body(" A@x.io", 2700, "10", customer="new"))], DDL), products, books)
    got = tables(added, after)
    assert got["purchases"][0][:2] == (1, "cs") and got["items"] == [(1, 10, 1, 2700, True, T0, "u10")]
    assert ("s1", "a@x.io", "A", "lead_magnet", "active", True, 3200, T0) in got["subscribers"]
    assert ("s2", "z@x.io", "Z", "manual", "unsubscribed", True, 0, T0) in got["subscribers"]
    assert len(got["profiles"]) == 2 and any(p[1:] == ("a@x.io", "N  A@x.io", "new", T0) for p in got["profiles"])
    assert got["tags"] == [("s1", "purchased-tripwire"), ("s1", "vip")]


def test_edges(frame, products, books):
    sent = [(1, T0, body("b@x.io", 100, "10")), (2, T0, body("b@x.io", 50, None, "p11")), (3, T0, body("nobody", 70, "10")), (4, T0, body("n@x.io", 30, "99")),
            (5, T0, body("b@x.io", 9, "10", mode="subscription")), (6, T0, body("b@x.io", 9, "10", kind="ping")), (7, T0, "{"), (8, T0, None)]
    added, after = booking.book_messages(frame(sent, DDL), products, books)
    got = tables(added, after)
    new = booking.book_messages(frame([(1, T0, body("b@x.io", 1, "10"))], DDL), products, books)[0]["people"].first()["subscriber_id"]
    assert [p[0] for p in got["purchases"]] == [1, 2, 3, 4] and [i[0] for i in got["items"]] == [1, 2, 3]
    assert [s[0] for s in got["subscriptions"]] == [5] and [s[0] for s in got["skipped"]] == [6, 7, 8]
    assert [s[6] for s in got["subscribers"] if s[0] == new] == [150] and len(got["subscribers"]) == 4
    assert ("q1", "b@x.io", "B", "cus", T0) in got["profiles"]
    assert {t for s, t in got["tags"] if s == new} == {"purchased-tripwire", "purchased-membership"}


def test_stream_equals_batch_under_redelivery_and_replay(spark, frame, products, books):
    rnd = random.Random(6)
    sent = []
    for i in range(60):
        mail = "hot@x.io" if rnd.random() < 0.34 else rnd.choice(["a@x.io", "b@x.io", "z@x.io", "c@x.io", "bad"])
        sent.append((i, T0 + timedelta(hours=i), body(mail, rnd.randrange(1000), rnd.choice(["10", "11", None]), rnd.choice(["p10", None]), customer=f"c{i}")))
    again = [(i, at + timedelta(hours=rnd.randrange(1, 30)), b) for i, at, b in sent if rnd.random() < 0.4]
    data = frame(sent + again, DDL)
    added, after = booking.book_messages(data, products, books)
    path = scratch_path(spark, "t-booking")
    sink = sinks.BookingSink(path, products, books)
    last = sinks.run_batches(replay(data, "received_at", 7), sink, f"{path}-checkpoint")
    assert last >= 4
    want = tables(added, after)
    assert len(want["ledger"]) == 60 and tables(sink.added(spark), sink.read(spark)) == want
    # The third batch runs again, and so does the last: nothing is booked twice.
    for batch_id in (2, last):
        ids = [r["id"] for r in spark.read.parquet(f"{path}/ledger/batch_id={batch_id}").collect()]
        sink(data.where(data["id"].isin(ids)), batch_id)
    assert tables(sink.added(spark), sink.read(spark)) == want


def test_replay_gives_the_rows_in_order(spark, frame):
    df = frame([(i, T0 + timedelta(minutes=i * 37 % 100)) for i in range(100)], "id long, at timestamp")
    seen = []
    sinks.run_batches(replay(df, "at", 5), lambda b, n: seen.append([r["at"] for r in b.collect()]), scratch_path(spark, "t-replay"))
    assert len(seen) >= 4 and all(max(a) < min(b) for a, b in zip(seen, seen[1:])) and sum(map(len, seen)) == 100
