"""Column-to-Column expressions.  All stay inside whole-stage code generation."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values ---------------------------------------------------------------
EMAIL_PATTERN = r"^[^\s@]+@[^\s@]+\.[^\s@]+\z"
SECONDS_PER_WORD = 0.45
HIGH_SCORE = 9.2
VIRAL_VIEWS = 10_000
TIER_FACTOR = {"premium": 1.1, "elite": 1.25}
BASE_RATE = {
    "lead_magnet": 40.0,
    "tripwire": 40.0,
    "bundle": 40.0,
    "membership": 30.0,
    "automation_package": 20.0,
}
SUBSCRIPTION_STATUS = ["trialing", "active", "past_due", "canceled", "incomplete", "incomplete_expired"]
HANDLED_TYPES = [
    "checkout.session.completed",
    "checkout.session.async_payment_succeeded",
    "customer.subscription.created",
    "customer.subscription.updated",
    "customer.subscription.deleted",
    "invoice.payment_succeeded",
    "invoice.payment_failed",
]
FORBIDDEN_WORDS = ["amazing", "unbelievable", "secret", "hack", "just", "try", "hope", "motivation", "easy"]
PREFERRED_WORDS = [
    "framework", "protocol", "sovereignty", "friction", "asymmetric",
    "system", "cognitive", "primal", "discipline", "velocity",
]
# The brand guide's own vocabulary
GUIDE_FORBIDDEN = ["amazing", "unbelievable", "just", "very", "literally", "crazy", "secret trick"]
GUIDE_PREFERRED = ["essential", "critical", "framework", "discipline", "sovereignty", "clarity", "asymmetric"]
PLATFORM_HASHTAGS = {
    "tiktok": ["#productivity", "#stoicism", "#discipline", "#mindset", "#motivation"],
    "instagram": ["#deepwork", "#stoicmindset", "#productivitytips"],
    "youtube": ["#shorts", "#productivity", "#success", "#discipline"],
}
# (platform, shortest seconds, longest seconds, longest is allowed)
VIDEO_LIMITS = [("tiktok", 30, 90, True), ("instagram", 30, 60, True), ("youtube", 0, 60, False)]
SCRIPT_WORDS = (130, 180)
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col) -> Column:
    """Money in units to whole cents."""
    return F.round(_c(col) * 100).cast("long")


def dollars(col) -> Column:
    return _c(col) / F.lit(100.0)


def ratio(num, den, digits: int = 4) -> Column:
    """num/den rounded; NULL when the denominator is 0."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), digits)


def pct(num, den, digits: int = 2) -> Column:
    return F.round(F.try_divide(_c(num) * F.lit(100.0), _c(den).cast("double")), digits)


def session_seconds(start, end) -> Column:
    """Whole seconds between two times, NULL while open."""
    span = (F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))) / F.lit(1e6)
    return F.round(span).cast("long")


def stripped(col) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(_c(col), r"^\s+|\s+\z", "")


def normalize_email(col) -> Column:
    return F.lower(stripped(_c(col)))


def valid_email(col) -> Column:
    return F.coalesce(_c(col).rlike(EMAIL_PATTERN), F.lit(False))


def display_name(name, email) -> Column:
    """Name, or the mailbox part when blank, without digits."""
    given = F.nullif(_c(name), F.lit(""))
    return stripped(F.regexp_replace(F.coalesce(given, F.split_part(_c(email), F.lit("@"), F.lit(1))), "[0-9]", ""))


def or_default(col, default, kind: str = "string") -> Column:
    """Default for NULL and for the type's empty value ('' or 0)."""
    c = _c(col)
    empty = c == ("" if kind == "string" else 0)
    return F.when(c.isNull() | empty, F.lit(default)).otherwise(c)


def epoch_ts(col) -> Column:
    return F.timestamp_seconds(_c(col))


def json_get(col, path: str) -> Column:
    return F.get_json_object(_c(col), path)


def lifecycle_event(kind, status, cancel_flag, price, prev_price, prev_status, period_start, prev_period_start) -> Column:
    """Message plus the state before it -> lifecycle event, NULL when nothing changed."""
    price, prev_price = _c(price), _c(prev_price)
    return (
        F.when(F.endswith(_c(kind), F.lit(".deleted")), "canceled")
        .when(F.endswith(_c(kind), F.lit(".created")), "created")
        .when(F.coalesce(_c(cancel_flag), F.lit(False)), "canceled")
        .when(price > prev_price, "upgraded")
        .when(price < prev_price, "downgraded")
        .when(_c(prev_status) == "canceled", "reactivated")
        .when(_c(period_start) > _c(prev_period_start), "renewed")
        .when(_c(status) == "past_due", "payment_failed")
    )


def map_status(col, default="active") -> Column:
    known = F.create_map(*[F.lit(x) for s in SUBSCRIPTION_STATUS for x in (s, s)])
    return F.coalesce(F.try_element_at(known, F.coalesce(_c(col), F.lit(""))), F.lit(default))


def is_member(status) -> Column:
    return F.coalesce(_c(status).isin("active", "trialing"), F.lit(False))


def member_since(status, was_member, since, now) -> Column:
    """Start time on the first switch to member, else what was there."""
    starts = is_member(status) & ~F.coalesce(_c(was_member), F.lit(False))
    return F.when(starts, _c(now)).otherwise(_c(since))


def _half_up(col: Column) -> Column:
    return F.floor(col + F.lit(0.5))


def commission_cents(amount, rate_pct, tier) -> Column:
    """Rate rounded to cents, then the tier bonus rounded again."""
    base = _half_up(_c(amount) * (_c(rate_pct) / F.lit(100.0)))
    out = base
    for name, factor in TIER_FACTOR.items():
        out = F.when(_c(tier) == name, _half_up(base * F.lit(factor))).otherwise(out)
    return out.cast("long")


def base_rate(product_type) -> Column:
    rates = F.create_map(*[F.lit(x) for kv in BASE_RATE.items() for x in kv])
    return F.try_element_at(rates, F.coalesce(_c(product_type), F.lit("")))


def commission_rate(message_rate, product_type, affiliate_rate) -> Column:
    return F.coalesce(_c(message_rate).cast("double"), base_rate(product_type), _c(affiliate_rate).cast("double"))


def to_fixed(cents_col) -> Column:
    """Cents as text with two decimals, from integers only."""
    c = _c(cents_col)
    whole = F.floor(F.abs(c) / 100)
    sign = F.when(c < 0, "-").otherwise("")
    return F.concat(sign, whole.cast("string"), F.lit("."), F.lpad((F.abs(c) % 100).cast("string"), 2, "0"))


def _words(col) -> Column:
    return F.array_remove(F.split(_c(col), r"\s+"), "")


def word_count(col) -> Column:
    return F.coalesce(F.size(_words(col)), F.lit(0)).cast("long")


def speech_seconds(words) -> Column:
    return F.round(_c(words) * F.lit(SECONDS_PER_WORD).cast("decimal(4,2)"), 2).cast("double")


def overlay(col) -> Column:
    """First two words, upper case."""
    return F.upper(F.array_join(F.slice(_words(col), 1, 2), " "))


def clip(col, n: int) -> Column:
    return F.concat(F.substring(_c(col), 1, n), F.lit("..."))


def topic(col) -> Column:
    """Last word without dots around it."""
    last = F.coalesce(F.try_element_at(_words(col), F.lit(-1)), F.lit(""))
    return F.regexp_replace(last, r"^\.+|\.+$", "")


def fill(template, values: dict[str, Column | str]) -> Column:
    """Replace {name} placeholders."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(_c(value).cast("string"), F.lit("")))
    return out


COMPLETION_SCHEMA = "hook string, body string, cta string, word_count long"


def parse_completion(col) -> Column:
    """Struct read from the widest {...} in the text; the whole text is the body when there is none."""
    text = _c(col)
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    doc = F.from_json(F.nullif(found, F.lit("")), COMPLETION_SCHEMA)
    return F.struct(
        F.coalesce(doc["hook"], F.lit("")).alias("hook"),
        F.coalesce(F.nullif(doc["body"], F.lit("")), text).alias("body"),
        F.coalesce(doc["cta"], F.lit("")).alias("cta"),
        F.coalesce(doc["word_count"], word_count(text)).alias("word_count"),
    )


def priority(score) -> Column:
    return F.when(_c(score) > HIGH_SCORE, "High").otherwise("Medium")


UTM_FIELDS = ["utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term"]


def parse_url(col) -> dict[str, Column]:
    url = _c(col)
    out = {
        "host": F.try_parse_url(url, F.lit("HOST")),
        "path": F.coalesce(F.nullif(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/")),
    }
    out.update({f: F.try_parse_url(url, F.lit("QUERY"), F.lit(f)) for f in UTM_FIELDS})
    return out


def device_class(user_agent) -> Column:
    ua = F.lower(_c(user_agent))
    return (
        F.when(ua.isNull() | (ua == ""), F.lit(None).cast("string"))
        .when(ua.rlike("ipad|tablet|kindle"), "tablet")
        .when(ua.contains("android") & ~ua.contains("mobile"), "tablet")
        .when(ua.rlike("mobile|iphone|ipod|android"), "mobile")
        .otherwise("desktop")
    )


def vocabulary_hits(col, words: list[str]) -> Column:
    """How many entries of a vocabulary occur in the text; an entry of several words may have any white space between them."""
    single, phrases = [w for w in words if " " not in w], [w.split() for w in words if " " in w]
    text = F.coalesce(F.lower(_c(col)), F.lit(""))
    found = F.array_intersect(F.split(text, "[^a-z]+"), F.array(*[F.lit(w) for w in single]).cast("array<string>"))
    hits = F.size(found)
    for phrase in phrases:
        hits = hits + text.rlike(r"(?<![a-z])" + r"\s+".join(phrase) + r"(?![a-z])").cast("int")
    return hits.cast("long")


def hashtags(platform, brand: str | None = None) -> Column:
    """Hashtag list of a platform; an own brand tag can lead the instagram list."""
    lists = {p: list(v) for p, v in PLATFORM_HASHTAGS.items()}
    if brand:
        lists["instagram"] = [f"#{brand}", *lists["instagram"]]
    table = F.create_map(*[x for p, v in lists.items() for x in (F.lit(p), F.array(*[F.lit(t) for t in v]))])
    return F.try_element_at(table, _c(platform))


def health_band(rate) -> Column:
    return F.when(_c(rate) < 95, "critical").when(_c(rate) <= 98, "warning").when(_c(rate).isNotNull(), "ok")


def day_before(as_of) -> Column:
    return F.date_sub(F.to_date(_c(as_of)), 1)


def discount_pct(price, compare_at) -> Column:
    return pct(_c(compare_at) - _c(price), compare_at)
