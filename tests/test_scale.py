from __future__ import annotations

import random
import time
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from growthloom.operators import joins as J, members
from growthloom.operators.affiliates import affiliate_run
from growthloom.plans.booking import Books
from growthloom.session import stage

T0 = datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_do_not_gather_their_tables(frame):
    left = frame([(1, "a", "x"), (2, "b", "y"), (3, None, "y")], "n long, k string, j string")
    right = frame([("a", "z", 7), ("c", "y", 8)], "r string, s string, pid long")
    found = J.or_lookup(left, right, [("k", "r"), ("j", "s")], ["pid"])
    assert "Broadcast" not in plan(found)
    assert rows(found, "n", "pid", "matched_on") == [(1, 7, "k"), (2, 8, "j"), (3, 8, "j")]


def test_booked_tables_do_not_gather_people(frame):
    subs = frame([("1", "a@b.c", "A", "lead", "active", False, 5, None)],
                 "id string, email string, full_name string, source string, status string, has_purchased boolean, ltv_cents long, updated_at timestamp_ntz")
    profs = frame([("1", "a@b.c", "A", "cus", None)], "id string, email string, full_name string, stripe_customer_id string, updated_at timestamp_ntz")
    people = frame([("a@b.c", "1", "1", "A", "cus", T0, T0), ("n@b.c", "9", "9", "N", "new", T0, T0)],
                   "email string, subscriber_id string, profile_id string, full_name string, stripe_customer_id string, created_at timestamp_ntz, updated_at timestamp_ntz")
    added = {"people": people, "amounts": frame([("1", 10), ("9", 3)], "subscriber_id string, amount_cents long"), "tags": frame([], "subscriber_id string, tag string")}
    after = Books(subs, profs, frame([], "subscriber_id string, tag string")).after(added)
    assert "Broadcast" not in plan(after.subscribers) and "Broadcast" not in plan(after.profiles)
    assert rows(after.subscribers, "id", "has_purchased", "ltv_cents") == [("1", True, 15), ("9", True, 3)]


def test_commissions_do_not_gather_products(frame):
    bought = frame([(1, 3, 5, 2, 1000, T0), (2, 4, 6, 2, 1000, T0)], "id long, product_id long, profile_id long, affiliate_id long, amount_cents long, created_at timestamp_ntz")
    made = affiliate_run(bought, frame([(2, "standard", 30.0, True)], "id long, tier string, commission_pct double, is_active boolean"),
                         frame([(3, "membership"), (4, "tripwire")], "id long, product_type string"))
    assert "Broadcast" not in plan(made) and rows(made, "purchase_id", "amount_cents") == [(1, 300), (2, 400)]


def test_changes_of_transitions_are_the_difference(frame):
    rnd, ddl = random.Random(5), "who string, price long, at timestamp, id long"
    data = [(rnd.choice(["hot", "hot", "a", None]), rnd.choice([100, 160, 400, None]), rnd.choice([None, T0 + timedelta(days=rnd.randrange(900))]), i) for i in range(90)]
    rnd.shuffle(data)
    columns = ["who", "price", "at", "id"]
    for cut, size in ((0, 4_000_000), (50, 4_000_000), (50, 6)):
        past, fresh = frame(data[:cut], ddl), frame(data[cut:], ddl)
        before, after = members.transitions(past, *columns), members.transitions(frame(data, ddl), *columns)
        want = after.exceptAll(before).withColumn("sign", F.lit(1)).unionByName(before.exceptAll(after).withColumn("sign", F.lit(-1)))
        got = members.transition_changes(past, fresh, *columns, size)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_a_staged_table_leaves_no_shuffle_files(spark):
    def files() -> set[str]:
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in found.mkString(" ").split(" ") if "/shuffle_" in f}

    before = files()
    out = stage(spark.range(10_000).repartition(4, "id").groupBy(F.col("id") % 7).count(), "t-clean")
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before and out.count() == 7
