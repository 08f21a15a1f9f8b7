from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from growthloom.functions import exprs as X


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


def test_commission_table(spark):
    """Rate table: base, premium and elite per cent of each product type."""
    want = {"tripwire": (40.0, 44.0, 50.0), "membership": (30.0, 33.0, 37.5), "automation_package": (20.0, 22.0, 25.0)}
    for kind, pcts in want.items():
        for tier, p in zip(("standard", "premium", "elite"), pcts):
            got = one(spark, X.commission_cents(F.lit(10_000), X.base_rate(F.lit(kind)), F.lit(tier)))
            assert got == p * 100


@pytest.mark.parametrize("amount,rate,tier,want", [
    (1900, 30.0, "elite", 713),  # 570 then 712.5 rounds up
    (50, 29.0, "standard", 14),  # 14.499999999999998 in double
    (0, 40.0, "elite", 0), (5, 10.0, "standard", 1), (2700, 40.0, None, 1080),
])
def test_commission_rounds_twice(spark, amount, rate, tier, want):
    assert one(spark, X.commission_cents(F.lit(amount), F.lit(rate), F.lit(tier))) == want


def test_commission_rate_precedence(spark):
    assert one(spark, X.commission_rate(F.lit(25), F.lit("membership"), F.lit(30.0))) == 25.0
    assert one(spark, X.commission_rate(F.lit(None), F.lit("membership"), F.lit(35.0))) == 30.0
    assert one(spark, X.commission_rate(F.lit(None), F.lit("mystery"), F.lit(35.0))) == 35.0


def test_rates_of_nothing_are_null(spark):
    assert one(spark, X.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, X.pct(F.lit(1), F.lit(0))) is None
    assert one(spark, X.pct(F.lit(1), F.lit(None).cast("long"))) is None


@pytest.mark.parametrize("text,want", [
    ("  A.B@Ex.COM ", True), ("a@b", False), ("a b@c.d", False), ("@c.d", False), ("", False), (None, False), ("a@b.c", True),
])
def test_email(spark, text, want):
    assert one(spark, X.valid_email(X.normalize_email(F.lit(text).cast("string")))) is want


@pytest.mark.parametrize("name,mail,want", [
    ("Ann 7 Lee", "x@y.z", "Ann  Lee"), ("", "bob42@y.z", "bob"), (None, "bob42@y.z", "bob"), ("123", "x@y.z", ""),
])
def test_display_name(spark, name, mail, want):
    assert one(spark, X.display_name(F.lit(name).cast("string"), F.lit(mail))) == want


def test_or_default(spark):
    assert one(spark, X.or_default(F.lit(""), "d")) == "d"
    assert one(spark, X.or_default(F.lit(None).cast("string"), "d")) == "d"
    assert one(spark, X.or_default(F.lit(0), 40, "number")) == 40
    assert one(spark, X.or_default(F.lit(3), 40, "number")) == 3


@pytest.mark.parametrize("cents,want", [(0, "0.00"), (5, "0.05"), (1234, "12.34"), (-7, "-0.07"), (-1234, "-12.34"), (None, None),
                                        (10**15, "10000000000000.00")])
def test_to_fixed(spark, cents, want):
    assert one(spark, X.to_fixed(F.lit(cents).cast("long"))) == want


@pytest.mark.parametrize("text,words,over,topic", [
    ("one two  three.", 3, "ONE TWO", "three"), ("  lead", 1, "LEAD", "lead"), ("", 0, "", ""), ("   ", 0, "", ""),
    ("...odd...", 1, "...ODD...", "odd"), ("tab\tnew\nline", 3, "TAB NEW", "line"),
])
def test_words(spark, text, words, over, topic):
    assert one(spark, X.word_count(F.lit(text))) == words
    assert one(spark, X.overlay(F.lit(text))) == over
    assert one(spark, X.topic(F.lit(text))) == topic


def test_speech_seconds(spark):
    assert [one(spark, X.speech_seconds(F.lit(n))) for n in (0, 1, 3, 140)] == [0.0, 0.45, 1.35, 63.0]


def test_session_seconds(spark):
    a, b = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 00:00:02.5").cast("timestamp_ntz")
    assert one(spark, X.session_seconds(a, b)) == 3
    assert one(spark, X.session_seconds(a, F.lit(None).cast("timestamp_ntz"))) is None


# Decision table of the lifecycle event: first matching line wins.
@pytest.mark.parametrize("kind,status,flag,price,prev,prev_status,moved,want", [
    ("deleted", "canceled", False, 1, 2, "active", True, "canceled"),
    ("created", "active", True, 1, None, None, False, "created"),
    ("updated", "active", True, 9, 2, "active", True, "canceled"),
    ("updated", "active", False, 9, 2, "canceled", True, "upgraded"),
    ("updated", "active", False, 1, 2, "canceled", True, "downgraded"),
    ("updated", "active", False, 2, 2, "canceled", True, "reactivated"),
    ("updated", "past_due", False, 2, 2, "active", True, "renewed"),
    ("updated", "past_due", False, 2, 2, "active", False, "payment_failed"),
    ("updated", "past_due", None, 2, None, None, False, "payment_failed"),
    ("updated", "active", False, 2, 2, "active", False, None),
])
def test_lifecycle_event(spark, kind, status, flag, price, prev, prev_status, moved, want):
    now, before = F.lit(200), F.lit(100) if moved else F.lit(200)
    got = X.lifecycle_event(
        F.lit(f"customer.subscription.{kind}"), F.lit(status), F.lit(flag).cast("boolean"), F.lit(price),
        F.lit(prev).cast("int"), F.lit(prev_status).cast("string"), now, before,
    )
    assert one(spark, got) == want


def test_member_state(spark):
    since, now = F.lit("2020-01-01").cast("timestamp_ntz"), F.lit("2024-01-01").cast("timestamp_ntz")
    assert one(spark, X.map_status(F.lit("odd"))) == "active"
    assert one(spark, X.map_status(F.lit(None).cast("string"), "incomplete")) == "incomplete"
    assert one(spark, X.is_member(F.lit("trialing"))) is True
    assert one(spark, X.is_member(F.lit(None).cast("string"))) is False
    assert one(spark, X.member_since(F.lit("active"), F.lit(False), since, now)).year == 2024
    assert one(spark, X.member_since(F.lit("active"), F.lit(True), since, now)).year == 2020
    assert one(spark, X.member_since(F.lit("canceled"), F.lit(False), since, now)).year == 2020


@pytest.mark.parametrize("text,hook,body,words", [
    ('Sure: {"hook": "h", "body": "b c", "word_count": 7} bye', "h", "b c", 7),
    ('{"hook": "h", "body": "", "cta": "x"}', "h", '{"hook": "h", "body": "", "cta": "x"}', 6),
    ("no document here", "", "no document here", 3), ("broken { text } end", "", "broken { text } end", 5),
    ('{"hook": "a\nb"', "", '{"hook": "a\nb"', 3),
])
def test_parse_completion(spark, text, hook, body, words):
    got = one(spark, X.parse_completion(F.lit(text)))
    assert (got["hook"], got["body"], got["word_count"]) == (hook, body, words)


@pytest.mark.parametrize("score,want", [(9.2, "Medium"), (9.3, "High"), (None, "Medium")])
def test_priority(spark, score, want):
    assert one(spark, X.priority(F.lit(score).cast("double"))) == want


def test_url_parts(spark):
    cols = X.parse_url(F.lit("https://shop.example.com/vault?utm_source=tiktok&x=1&utm_content=bio#top"))
    assert one(spark, cols["host"]) == "shop.example.com" and one(spark, cols["path"]) == "/vault"
    assert one(spark, cols["utm_source"]) == "tiktok" and one(spark, cols["utm_medium"]) is None
    assert one(spark, cols["utm_content"]) == "bio"
    assert one(spark, X.parse_url(F.lit("not a url %%"))["host"]) is None


@pytest.mark.parametrize("agent,want", [
    ("Mozilla (iPhone; CPU) Mobile", "mobile"), ("Mozilla (Linux; Android 14) Mobile", "mobile"),
    ("Mozilla (Linux; Android 14)", "tablet"), ("Mozilla (iPad)", "tablet"), ("Mozilla (Windows NT 10.0)", "desktop"),
    ("", None), (None, None),
])
def test_device(spark, agent, want):
    assert one(spark, X.device_class(F.lit(agent).cast("string"))) == want


def test_health_band(spark):
    got = [one(spark, X.health_band(F.lit(r).cast("double"))) for r in (94.99, 95.0, 98.0, 98.01, None)]
    assert got == ["critical", "warning", "warning", "ok", None]


def test_vocabulary_counts_whole_words(spark):
    text = F.lit("Just TRY it: justice, easy-peasy, easy!")
    assert one(spark, X.vocabulary_hits(text, X.FORBIDDEN_WORDS)) == 3


def test_hashtags(spark):
    assert len(one(spark, X.hashtags(F.lit("tiktok")))) == 5
    assert one(spark, X.hashtags(F.lit("instagram"), "acme"))[0] == "#acme"
    assert one(spark, X.hashtags(F.lit("other"))) is None


def test_fill(spark):
    got = one(spark, X.fill("{a}-{b}-{a}-{c}", {"a": F.lit("x"), "b": F.lit(None).cast("string")}))
    assert got == "x--x-{c}"
