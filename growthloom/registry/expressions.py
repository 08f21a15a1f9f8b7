"""Queries for derived columns."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom.functions import exprs as X
from growthloom.operators import content as C
from growthloom.operators import upsert as U
from growthloom.plans import drafts
from growthloom.registry.core import op
from growthloom.registry.duck import ORDERS_AS_OF as OA
from growthloom.sources import tables
from growthloom.sources.documents import explode_lines
from growthloom.sources.fixtures import AS_OF_ORDERS, Tables, as_ts

WORDS = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda x: x <> '')"


@op("session_duration", """SELECT id, CASE WHEN status = 'success' THEN CAST(round(run_cs / 100.0::DOUBLE) AS BIGINT) END AS duration_seconds FROM lg""")
def _(t: Tables) -> DataFrame:
    runs = t.execution_logs.withColumn("ended_at", F.when(F.col("status") == "success", F.col("completed_at")))
    return tables.gen_duration(runs).select("id", "duration_seconds")


@op("performance_delta", "SELECT id, CAST(actual_performance - estimated_performance AS DOUBLE) AS performance_delta FROM ho")
def _(t: Tables) -> DataFrame:
    return tables.gen_delta(t.hooks).select("id", F.col("performance_delta").cast("double").alias("performance_delta"))


@op("net_revenue", "SELECT id, amount_cents - fee_cents AS net_revenue_cents FROM ph")
def _(t: Tables) -> DataFrame:
    return tables.gen_net(t.purchases_hist).select("id", "net_revenue_cents")


@op("item_total", "SELECT purchase_id, line_no, product_id, quantity * unit_price_cents AS total_cents FROM it")
def _(t: Tables) -> DataFrame:
    return tables.gen_total(t.purchase_items).select("purchase_id", "line_no", "product_id", "total_cents")


@op("touch_updated_at", f"SELECT id, CASE WHEN status = 'canceled' THEN {OA} ELSE created_at END AS updated_at FROM me")
def _(t: Tables) -> DataFrame:
    rows = t.memberships.withColumn("updated_at", F.col("created_at"))
    return U.touch(rows, F.col("status") == "canceled", as_ts(AS_OF_ORDERS)).select("id", "updated_at")


@op("normalize_email", r"""SELECT event_id AS id, 'customer.' || lpad(CAST(user_id AS VARCHAR), 9, '0') ||
    CASE WHEN event_id % 10 = 7 THEN '(at)' ELSE '@' END || 'example.com' AS email, event_id % 10 <> 7 AS valid
    FROM ev WHERE event_type = 'signup'""")
def _(t: Tables) -> DataFrame:
    # White space of several kinds around each address must not make another person.
    pad = F.element_at(F.array(*[F.lit(x) for x in ("", " ", "\t", "\n", "\r\n")]), (F.col("id") % 5 + 1).cast("int"))
    mail = X.normalize_email(F.concat(pad, F.upper(X.json_get("body", "$.email")), pad))
    return t.lead_messages.select("id", mail.alias("email")).withColumn("valid", X.valid_email("email"))


@op("display_name", r"""SELECT id, trim(regexp_replace(CASE WHEN acct_cents < 0 THEN split_part(email, '@', 1) ELSE full_name END,
    '[0-9]', '', 'g')) AS display_name FROM pr""")
def _(t: Tables) -> DataFrame:
    name = F.when(F.col("acct_cents") < 0, F.lit("")).otherwise(F.col("full_name"))
    return t.profiles.select("id", X.display_name(name, "email").alias("display_name"))


@op("js_default", """SELECT event_id AS id, CASE WHEN k = 0 THEN -1 ELSE k END AS k, CASE WHEN k < 50 THEN 'Lead 7 ' || k ELSE 'friend' END AS name,
    CASE WHEN k % 2 = 0 THEN 'referral' ELSE 'landing_page' END AS source FROM ev WHERE event_type = 'signup'""")
def _(t: Tables) -> DataFrame:
    leads = t.lead_messages.join(t.events.select(F.col("event_id").alias("id"), "k"), "id")
    return leads.select(
        "id", X.or_default("k", -1, "number").alias("k"),
        X.or_default(X.json_get("body", "$.name"), "friend").alias("name"),
        X.or_default(X.json_get("body", "$.source"), "landing_page").alias("source"),
    )


@op("epoch_to_ts", "SELECT o_orderkey AS id, o_orderdate AS period_start, o_orderdate + INTERVAL 30 DAY AS period_end FROM orders")
def _(t: Tables) -> DataFrame:
    def at(field: str):
        sec = X.json_get("body", f"$.data.object.{field}").cast("long")
        return X.epoch_ts(sec).cast("timestamp_ntz")

    return t.subscription_messages.select(
        "id", at("current_period_start").alias("period_start"), at("current_period_end").alias("period_end")
    )


@op("json_path", """SELECT CAST(event_id AS BIGINT) AS id, k, 'https://example.com/l/' || (k % 7) AS first_link FROM ev WHERE event_type = 'click'""")
def _(t: Tables) -> DataFrame:
    links = t.campaign_logs.where("clicked_at is not null").select("id", X.json_get("clicked_links", "$[0]").alias("first_link"))
    ks = t.raw("events").select(F.col("event_id").alias("id"), X.json_get("props", "$.k").cast("int").alias("k"))
    return links.join(ks, "id").select("id", "k", "first_link")


@op("classify_sub_event", """SELECT id, CASE WHEN id % 11 = 1 THEN 'canceled' WHEN id % 11 = 0 THEN 'created' WHEN id % 17 = 0 THEN 'canceled'
    WHEN price_cents > pp THEN 'upgraded' WHEN price_cents < pp THEN 'downgraded' WHEN pk % 11 = 1 THEN 'reactivated'
    WHEN created_at > pd THEN 'renewed' WHEN st = 'P' THEN 'payment_failed' END AS event_type, pp AS previous_price
    FROM (SELECT o_orderkey AS id, price_cents, o_orderdate AS created_at, o_orderstatus AS st,
      lag(price_cents) OVER w AS pp, lag(o_orderkey) OVER w AS pk, lag(o_orderdate) OVER w AS pd
      FROM orr WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))""")
def _(t: Tables) -> DataFrame:
    from growthloom.plans import membership

    rows = membership.subscription_rows(t.subscription_messages)
    return membership.lifecycle_log(rows).select("id", "event_type", "previous_price")


@op("map_status", """SELECT id, CASE WHEN status = 'past_due' THEN 'past_due' WHEN status = 'canceled' THEN 'canceled' ELSE 'active' END AS a,
    CASE o_st WHEN 'F' THEN 'trialing' ELSE 'incomplete' END AS b FROM me JOIN
    (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_st FROM orders GROUP BY 1) ON o_custkey = id""")
def _(t: Tables) -> DataFrame:
    last = t.raw("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("st"))
    named = F.when(F.col("st") == "F", "trialing").otherwise(F.lit("unheard"))
    odd = F.when(F.col("status") != "active", F.col("status")).otherwise(F.lit("not_a_status"))
    return t.memberships.select("id", "status").join(last, "id").select(
        "id", X.map_status(odd).alias("a"), X.map_status(named, "incomplete").alias("b")
    )


@op("member_flags", f"""SELECT p.id, m.status IS NOT NULL AND m.status = 'active' AS is_member,
    CASE WHEN m.status = 'active' THEN CASE WHEN p.acct_cents >= 500000 THEN NULL ELSE {OA} END END AS member_since
    FROM pr p LEFT JOIN me m ON m.profile_id = p.id WHERE m.id IS NOT NULL""")
def _(t: Tables) -> DataFrame:
    from growthloom.plans import membership

    state = t.profiles.select(
        "id", (F.col("acct_cents") >= 500_000).alias("is_member"), F.lit(None).cast("timestamp_ntz").alias("member_since")
    )
    flagged = membership.member_flags(state, t.memberships.select("profile_id", "status"), as_ts(AS_OF_ORDERS))
    known = t.memberships.select(F.col("profile_id").alias("id"))
    return flagged.join(known, "id", "left_semi").select("id", "is_member", "member_since")


@op("commission_cents", """SELECT id, CASE tier WHEN 'premium' THEN CAST(floor(base * 1.1::DOUBLE + 0.5) AS BIGINT)
      WHEN 'elite' THEN CAST(floor(base * 1.25::DOUBLE + 0.5) AS BIGINT) ELSE CAST(base AS BIGINT) END AS commission_cents,
      round(CASE tier WHEN 'premium' THEN floor(base * 1.1::DOUBLE + 0.5) WHEN 'elite' THEN floor(base * 1.25::DOUBLE + 0.5) ELSE base END
        * 100.0::DOUBLE / nullif(amount_cents, 0), 2) AS effective_pct
    FROM (SELECT pu.id, af.tier, pu.amount_cents, floor(CAST(pu.amount_cents AS DOUBLE) * (rate / 100.0::DOUBLE) + 0.5) AS base
      FROM (SELECT pu.*, CAST(CASE dp.product_type WHEN 'membership' THEN 30 WHEN 'automation_package' THEN 20 ELSE 40 END AS DOUBLE) AS rate
            FROM pu JOIN dp ON dp.id = pu.product_id) pu JOIN af ON af.id = pu.affiliate_id)""")
def _(t: Tables) -> DataFrame:
    sold = t.purchases.join(t.products.select(F.col("id").alias("product_id"), "product_type"), "product_id")
    sold = sold.join(t.affiliates.select(F.col("id").alias("affiliate_id"), "tier"), "affiliate_id")
    made = X.commission_cents("amount_cents", X.base_rate("product_type"), "tier")
    return sold.select("id", made.alias("commission_cents"), X.pct(made, "amount_cents").alias("effective_pct"))


@op("base_rate", """SELECT id, CAST(CASE product_type WHEN 'membership' THEN 30 WHEN 'automation_package' THEN 20 ELSE 40 END AS DOUBLE) AS rate FROM dp""")
def _(t: Tables) -> DataFrame:
    return t.products.select("id", X.base_rate("product_type").alias("rate"))


@op("to_fixed", """SELECT id, (amount_cents // 100) || '.' || lpad(CAST(amount_cents % 100 AS VARCHAR), 2, '0') AS amount,
    CASE WHEN fee_cents = 0 THEN '' ELSE '-' END || (fee_cents // 100) || '.' || lpad(CAST(fee_cents % 100 AS VARCHAR), 2, '0') AS fee FROM ph""")
def _(t: Tables) -> DataFrame:
    return t.purchases_hist.select(
        "id", X.to_fixed("amount_cents").alias("amount"), X.to_fixed(-F.col("fee_cents")).alias("fee")
    )


@op("word_count", f"SELECT id, CAST(len({WORDS.format('body_text')}) AS BIGINT) AS words FROM sc")
def _(t: Tables) -> DataFrame:
    return t.scripts.select("id", X.word_count("body_text").alias("words"))


@op("speech_duration", "SELECT id, line_no, CAST(words * 45 AS DOUBLE) / 100 AS seconds FROM wl")
def _(t: Tables) -> DataFrame:
    lines = explode_lines(t.scripts, "id", "lines")
    return lines.select("id", "line_no", X.speech_seconds(X.word_count("line")).alias("seconds"))


@op("overlay_text", f"SELECT id, line_no, upper(replace(array_to_string({WORDS.format('line')}[1:2], ' '), 'ß', 'SS')) AS overlay FROM wl")
def _(t: Tables) -> DataFrame:
    return explode_lines(t.scripts, "id", "lines").select("id", "line_no", X.overlay("line").alias("overlay"))


@op("clip_text", "SELECT id, line_no, left(line, 30) || '...' AS short_line FROM wl")
def _(t: Tables) -> DataFrame:
    return explode_lines(t.scripts, "id", "lines").select("id", "line_no", X.clip("line", 30).alias("short_line"))


@op("last_word_topic", rf"""SELECT id, trim(coalesce({WORDS.format('body_text')}[-1], ''), '.') AS topic FROM sc""")
def _(t: Tables) -> DataFrame:
    return t.scripts.select("id", X.topic("body_text").alias("topic"))


@op("fill_template", rf"""SELECT id, hook_text || chr(10) || 'Stop chasing ' || trim(coalesce({WORDS.format('hook_text')}[-1], ''), '.') || '.' || chr(10) ||
    'Acme rule for ' || category || '.' AS body_text FROM ho""")
def _(t: Tables) -> DataFrame:
    text = "Stop chasing {topic}.\n{brand} rule for {category}."
    return drafts.fill_script(t.hooks, text, "Acme").select("id", "body_text")


@op("build_prompt", """SELECT h.id, h.template_no, 'Voice' || chr(10) || 'Spec' || chr(10) || 'Template: ' || s.source || chr(10) || 'Hook: ' || h.hook_text || chr(10) ||
    'Point 1: ' || s.p1 || chr(10) || 'Point 2: ' || s.p2 || chr(10) || 'Point 3: ' || chr(10) || 'CTA: ' || s.cta || chr(10) ||
    'One sentence per line. 130-180 words.' AS prompt
    FROM (SELECT id, hook_text, CAST(id % 20 AS VARCHAR) AS template_no FROM ho) h
    JOIN (SELECT regexp_extract(source, '([0-9]+)$', 1) AS no, source, min(lang) AS p1, max(lang) AS p2, CAST(count(*) AS VARCHAR) AS cta
          FROM documents GROUP BY 1, 2) s ON s.no = h.template_no""")
def _(t: Tables) -> DataFrame:
    no = F.regexp_extract("source", "([0-9]+)$", 1)
    templates = t.raw("documents").groupBy(no.alias("template_no"), F.col("source").alias("name")).agg(
        F.min("lang").alias("point1"), F.max("lang").alias("point2"), F.count(F.lit(1)).cast("string").alias("cta")
    ).withColumn("point3", F.lit(None).cast("string"))
    hooks = t.hooks.select("id", "hook_text", (F.col("id") % 20).cast("string").alias("template_no"))
    return drafts.build_prompt(hooks, templates, "Voice", "Spec")


@op("parse_json_from_text", f"""SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN 'H' || turn ELSE '' END AS hook_text,
    CASE WHEN turn % 3 = 2 THEN 'So {{' || text ELSE text END AS body_text,
    CAST(CASE WHEN turn % 3 = 1 THEN turn ELSE len({WORDS.format("CASE WHEN turn % 3 = 2 THEN 'So {' || text ELSE text END")}) END AS BIGINT) AS word_count
    FROM conversations WHERE role = 'assistant'""")
def _(t: Tables) -> DataFrame:
    # By turn the answers hold a document, an unfinished one, or none.
    doc = F.to_json(F.struct(F.concat(F.lit("H"), F.col("turn")).alias("hook"), F.col("text").alias("body"), F.col("turn").alias("word_count")))
    answer = (
        F.when(F.col("turn") % 3 == 1, F.concat(F.lit("Here it is:\n"), doc, F.lit("\nEnjoy")))
        .when(F.col("turn") % 3 == 2, F.concat(F.lit("So {"), F.col("text")))
        .otherwise(F.col("text"))
    )
    parsed = drafts.ingest_completions(t.completions.withColumn("answer", answer), "answer", ["conv_id", "turn"])
    return parsed.select("conv_id", "turn", "hook_text", "body_text", "word_count")


@op("priority_band", "SELECT id, CASE WHEN estimated_performance > 9.2 THEN 'High' ELSE 'Medium' END AS priority FROM ho")
def _(t: Tables) -> DataFrame:
    return t.hooks.select("id", X.priority(F.col("estimated_performance").cast("double")).alias("priority"))


@op("utm_parse", """SELECT id, host, path, nullif(regexp_extract(query, '(?:^|&)utm_source=([^&]*)', 1), '') AS utm_source,
    nullif(regexp_extract(query, '(?:^|&)utm_medium=([^&]*)', 1), '') AS utm_medium FROM pv""")
def _(t: Tables) -> DataFrame:
    from growthloom.sources.documents import page_view_columns

    return page_view_columns(t.page_views).select("id", "host", "path", "utm_source", "utm_medium")


@op("device_class", "SELECT id, CASE WHEN host LIKE 'm.%' THEN 'mobile' WHEN host LIKE 'blog.%' THEN 'tablet' ELSE 'desktop' END AS device FROM pv")
def _(t: Tables) -> DataFrame:
    return t.page_views.select("id", X.device_class("user_agent").alias("device"))


_FORBID = "['the','les','and','der','que','las','mit']"
_PREFER = "['with','this','une','und','los','for']"


@op("brand_voice_lint", f"""SELECT id, CAST(len(list_intersect(w, {_FORBID})) AS BIGINT) AS forbidden_hits,
    CAST(len(list_intersect(w, {_PREFER})) AS BIGINT) AS preferred_hits, len(list_intersect(w, {_FORBID})) = 0 AS passed
    FROM (SELECT id, list_distinct(regexp_split_to_array(lower(body_text), '[^a-z]+')) AS w FROM sc)""")
def _(t: Tables) -> DataFrame:
    # The vocabulary is a parameter; these words occur in the given texts.
    bad, good = ["the", "les", "and", "der", "que", "las", "mit"], ["with", "this", "une", "und", "los", "for"]
    return C.lint(t.scripts, "body_text", bad, good).select("id", "forbidden_hits", "preferred_hits", "passed")


@op("brand_voice_default", """SELECT id, CAST(len(list_intersect(w, ['amazing','unbelievable','secret','hack','just','try','hope','motivation','easy'])) AS BIGINT)
      AS forbidden_hits, len(list_intersect(w, ['amazing','unbelievable','secret','hack','just','try','hope','motivation','easy'])) = 0 AS passed
    FROM (SELECT id, list_distinct(regexp_split_to_array(lower(body_text), '[^a-z]+')) AS w FROM sc)""")
def _(t: Tables) -> DataFrame:
    return C.lint(t.scripts, "body_text").select("id", "forbidden_hits", "passed")


def _hits_sql(words: list[str], phrases: list[str]) -> str:
    found = " + ".join(f"CAST(regexp_matches(t, '(^|[^a-z]){p.replace(' ', chr(92) + 's+')}($|[^a-z])') AS BIGINT)" for p in phrases)
    return f"CAST(len(list_intersect(w, {words})) AS BIGINT)" + (f" + {found}" if found else "")


@op("brand_voice_guide", f"""SELECT id, forbidden_hits, preferred_hits, forbidden_hits = 0 AS passed FROM
    (SELECT id, {_hits_sql(['amazing', 'unbelievable', 'just', 'very', 'literally', 'crazy'], ['secret trick'])} AS forbidden_hits,
      {_hits_sql(['essential', 'critical', 'framework', 'discipline', 'sovereignty', 'clarity', 'asymmetric'], [])} AS preferred_hits
     FROM (SELECT id, lower(body_text) AS t, list_distinct(regexp_split_to_array(lower(body_text), '[^a-z]+')) AS w FROM sc))""")
def _(t: Tables) -> DataFrame:
    return C.lint(t.scripts, "body_text", X.GUIDE_FORBIDDEN, X.GUIDE_PREFERRED).select("id", "forbidden_hits", "preferred_hits", "passed")


@op("brand_voice_phrases", f"""SELECT id, forbidden_hits, preferred_hits, forbidden_hits = 0 AS passed FROM
    (SELECT id, {_hits_sql(['les'], ['of the', 'to be', 'in the', 'de la'])} AS forbidden_hits, {_hits_sql(['with'], ['and the'])} AS preferred_hits
     FROM (SELECT id, lower(body_text) AS t, list_distinct(regexp_split_to_array(lower(body_text), '[^a-z]+')) AS w FROM sc))""")
def _(t: Tables) -> DataFrame:
    # Phrases that occur in the given texts.
    return C.lint(t.scripts, "body_text", ["les", "of the", "to be", "in the", "de la"], ["with", "and the"]).select(
        "id", "forbidden_hits", "preferred_hits", "passed")


@op("script_spec_check", f"""SELECT id, platform, words, words * 45 / 100.0::DOUBLE AS seconds,
    CASE platform WHEN 'tiktok' THEN words * 45 BETWEEN 3000 AND 9000 WHEN 'instagram' THEN words * 45 BETWEEN 3000 AND 6000
      ELSE words * 45 < 6000 END AS duration_ok, words BETWEEN 130 AND 180 AS words_ok
    FROM (SELECT id, CAST(len({WORDS.format('body_text')}) AS BIGINT) AS words FROM sc)
    CROSS JOIN (SELECT unnest(['tiktok','instagram','youtube']) AS platform)""")
def _(t: Tables) -> DataFrame:
    return C.spec_check(t.scripts.select("id", "body_text"), "body_text").drop("body_text")


@op("hashtag_map", """SELECT video_id, platform, CASE platform WHEN 'tiktok' THEN 5 WHEN 'instagram' THEN 4 ELSE 4 END AS n_tags,
    CASE platform WHEN 'tiktok' THEN '#productivity' WHEN 'instagram' THEN '#acme' ELSE '#shorts' END AS first_tag
    FROM (SELECT DISTINCT video_id, platform FROM ce)""")
def _(t: Tables) -> DataFrame:
    tags = X.hashtags("platform", "acme")
    shown = t.content_events.select("video_id", "platform").distinct()
    return shown.select("video_id", "platform", F.size(tags).alias("n_tags"), F.element_at(tags, 1).alias("first_tag"))


@op("health_band", """SELECT day, rate, CASE WHEN rate < 95 THEN 'critical' WHEN rate <= 98 THEN 'warning' ELSE 'ok' END AS band FROM
    (SELECT date_trunc('hour', started_at) AS day, workflow_id, round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 2) AS rate FROM lg
     GROUP BY 1, 2)""")
def _(t: Tables) -> DataFrame:
    hour = F.date_trunc("hour", F.col("started_at").cast("timestamp")).cast("timestamp_ntz")
    rates = t.execution_logs.groupBy(hour.alias("day"), "workflow_id").agg(
        X.pct(F.count_if(F.col("status") == "success"), F.count(F.lit(1))).alias("rate")
    )
    return rates.select("day", "rate", X.health_band("rate").alias("band"))


@op("iso_day", "SELECT event_id AS id, CAST(ts AS DATE) AS day, CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS yesterday FROM ev")
def _(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("id"), F.to_date("ts").alias("day"), X.day_before("ts").alias("yesterday")
    )


@op("discount_pct", """SELECT id, round((compare_at_price_cents - price_cents) * 100.0::DOUBLE / compare_at_price_cents, 2) AS discount_pct FROM dp""")
def _(t: Tables) -> DataFrame:
    return t.products.select("id", X.discount_pct("price_cents", "compare_at_price_cents").alias("discount_pct"))
