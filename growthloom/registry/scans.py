"""Queries for readers and writers."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from growthloom import schemas
from growthloom.operators import content as C
from growthloom.operators import ops, upsert as U
from growthloom.registry.core import op
from growthloom.registry.sources import mart
from growthloom.session import scratch_path
from growthloom.sources import documents as D
from growthloom.sources import layout, sinks, tables
from growthloom.sources.fixtures import Tables


@op("scan_table", """SELECT CAST(id AS VARCHAR) AS id, CAST(profile_id AS VARCHAR) AS profile_id, amount_cents, fee_cents, status,
    created_at, amount_cents - fee_cents AS net_revenue_cents FROM ph WHERE status = 'completed'""")
def _(t: Tables) -> DataFrame:
    declared = schemas.schema_of("purchases")
    have = t.purchases_hist
    typed = have.select(
        *[
            (F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in declared.fields
        ]
    )
    path = scratch_path(t.spark, "purchases")
    typed.write.parquet(path)
    df = tables.read_table(t.spark, "purchases", path).where("status = 'completed'")
    return df.select(
        "id", "profile_id", "amount_cents", "fee_cents", "status",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"), "net_revenue_cents",
    )


def _hook_file(df: DataFrame, key: str, parts) -> DataFrame:
    """A hooks document per row: one hook per part of the text, the row's key as category."""
    return df.select(
        F.to_json(
            F.struct(
                F.transform(
                    parts,
                    lambda p, i: F.struct(
                        p.alias("text"), F.col(key).cast("string").alias("category"), F.lit("Insight").alias("trigger"),
                        (i % 30 / 10.0 + 7).alias("estimated_performance"),
                    ),
                ).alias("hooks")
            )
        ).alias("body"),
    )


@op("scan_hooks_json", """SELECT item_id, CAST(i - 1 AS INTEGER) AS ordinal, parts[i] AS text,
    round(7 + ((i - 1) % 30) / 10.0::DOUBLE, 4) AS estimated_performance
    FROM (SELECT item_id, string_split(text, '. ') AS parts, unnest(range(1, len(string_split(text, '. ')) + 1)) AS i FROM benchmark)""")
def _(t: Tables) -> DataFrame:
    files = _hook_file(t.raw("benchmark"), "item_id", F.split("text", r"\. "))
    path = scratch_path(t.spark, "hook-files")
    files.write.text(path)
    read = D.read_hooks(t.spark, path, lines=True)
    return read.select(F.col("category").cast("long").alias("item_id"), "ordinal", "text", F.round("estimated_performance", 4).alias("estimated_performance"))


@op("scan_hooks_grouped", """SELECT conv_id, role AS category, text, turn FROM conversations""")
def _(t: Tables) -> DataFrame:
    # One document per turn: its category is the role, its only hook the text.
    files = t.raw("conversations").select(
        "conv_id", "turn",
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.col("role").alias("category"), F.lit("").alias("description"), F.array("text").alias("hooks")
                    )
                ).alias("categories")
            )
        ).alias("body"),
    )
    return D.parse_grouped_hooks(files, keep=("conv_id", "turn")).select("conv_id", "category", "text", "turn")


@op("scan_script_batches", """SELECT doc_id, 'doc-' || doc_id AS id, len(string_split(text, chr(10))) AS n_lines,
    string_split(text, chr(10))[-1] AS last_line FROM documents""")
def _(t: Tables) -> DataFrame:
    batch = t.scripts.select(
        F.col("id").alias("doc_id"),
        F.to_json(
            F.array(
                F.struct(
                    F.concat(F.lit("doc-"), F.col("id")).alias("id"),
                    F.struct(F.col("lines").alias("script")).alias("voiceover"),
                )
            )
        ).alias("body"),
    )
    lines = F.col("voiceover.script")
    return D.parse_scripts(batch, keep=("doc_id",)).select(
        "doc_id", "id", F.size(lines).cast("long").alias("n_lines"), F.element_at(lines, -1).alias("last_line")
    )


@op("script_lines", "SELECT id, line_no, line FROM wl")
def _(t: Tables) -> DataFrame:
    return D.explode_lines(t.scripts, "id", "lines")


@op("scan_templates_text", """SELECT id, CAST(line_no AS BIGINT) AS section_no, 'Part ' || line_no AS name, nullif(line, '') AS point1,
    nullif(split_part(line, '"', 1), '') AS cta FROM ln""")
def _(t: Tables) -> DataFrame:
    # Every document becomes a Markdown text with one numbered section per line.
    body = F.array_join(
        F.transform(
            "lines",
            lambda x, i: F.concat(
                F.lit("## "), (i + 1).cast("string"), F.lit(". Part "), (i + 1).cast("string"),
                F.lit("\n- **Point 1:** "), x, F.lit('\n- **CTA:** "'), x, F.lit('"'),
            ),
        ),
        "\n",
    )
    out = D.parse_sections(t.scripts.select("id", body.alias("md")), "id", "md")
    return out.select("id", "section_no", "name", "point1", "cta")


@op("ingest_webhook_inbox", """SELECT id, CASE WHEN event_type = 'error' THEN NULL ELSE email END AS email,
    event_type = 'error' AS is_bad FROM (SELECT event_id AS id, event_type, 'user' || user_id || '@example.com' AS email FROM ev)""")
def _(t: Tables) -> DataFrame:
    good = F.to_json(F.struct(F.concat(F.lit("user"), F.col("user_id"), F.lit("@example.com")).alias("email")))
    body = F.when(F.col("event_type") == "error", F.concat(F.lit('{"email": '), F.col("event_id"), F.lit(", broken")))
    inbox = t.events.select(F.col("event_id").alias("id"), F.coalesce(body, good).alias("body"))
    parsed = D.parse_messages(inbox, schemas.LEAD_MESSAGE)
    bad = F.col("msg._corrupt_record").isNotNull()
    return parsed.select("id", F.when(~bad, F.col("msg.email")).alias("email"), bad.alias("is_bad"))


@op("append_sink", "SELECT id, amount_cents, status, created_at FROM ph")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "appended")
    cols = ["id", "amount_cents", "status", "created_at"]
    done, rest = t.purchases_hist.where("status = 'completed'"), t.purchases_hist.where("status <> 'completed'")
    sinks.append(done, path, cols)
    sinks.append(rest, path, cols)
    return t.spark.read.parquet(path)


@op("seed_unique", """SELECT text AS hook_text, min(doc_id) AS id FROM documents
    WHERE text NOT IN (SELECT text FROM benchmark) GROUP BY text""")
def _(t: Tables) -> DataFrame:
    new = t.scripts.select(F.col("body_text").alias("hook_text"), "id")
    return U.new_rows(t.hooks.select("hook_text"), new, ["hook_text"], ["id"]).select("hook_text", "id")


@op("json_sink", """SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 10 + 1 AS BIGINT) AS batch, hook_text FROM ho""")
def _(t: Tables) -> DataFrame:
    rows = C.production_order(t.hooks, [F.col("id").asc()])
    path = scratch_path(t.spark, "packages")
    sinks.write_packages(rows.select("id", F.struct("category", "hook_text").alias("package"), "batch"), path)
    read = t.spark.read.schema("id long, package struct<category: string, hook_text: string>, batch long").json(path)
    return read.select("id", "batch", F.col("package.hook_text").alias("hook_text"))


@op("csv_sink", """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'part', count(*) FROM part""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "counts-csv")
    sinks.write_csv(tables.table_counts({n: t.raw(n) for n in ("customer", "events", "part")}), path)
    return t.spark.read.schema("table_name string, row_count long").option("header", True).csv(path)


@op("row_count_audit", """SELECT 'benchmark' AS table_name, count(*) AS row_count FROM benchmark
    UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'documents', count(*) FROM documents
    UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'supplier', count(*) FROM supplier ORDER BY 1""")
def _(t: Tables) -> DataFrame:
    names = ["benchmark", "customer", "documents", "events", "lineitem", "orders", "part", "supplier"]
    return tables.table_counts({n: t.raw(n) for n in names})


@op("report_text", """SELECT metric_date, strftime(metric_date, '%Y-%m-%d') || ' | revenue $' ||
    (total_revenue_cents // 100) || '.' || lpad(CAST(total_revenue_cents % 100 AS VARCHAR), 2, '0') ||
    ' | subscribers +' || new_subscribers || ' | views ' || total_content_views || ' | runs ' || workflows_run || ' ok, ' ||
    workflows_failed || ' failed' AS line FROM dm""")
def _(t: Tables) -> DataFrame:
    return ops.render_summary(mart(t))


@op("log_run", """SELECT CAST(user_id % 8 AS VARCHAR) AS workflow_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS input_data, '{"k":' || k || '}' AS output_data,
    'webhook' AS trigger_source, CAST(k AS VARCHAR) AS related_video_id, CAST(user_id AS VARCHAR) AS related_subscriber_id,
    CAST(NULL AS VARCHAR) AS related_purchase_id FROM ev""")
def _(t: Tables) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    return sinks.run_log(
        t.events, F.col("user_id") % 8, status, ["event_id", "user_id"], ["k"],
        {"related_video_id": "k", "related_subscriber_id": "user_id"}, "webhook",
    )


@op("table_layout", """SELECT CAST(id AS VARCHAR) AS id, person, stage, revenue_cents FROM (SELECT id, person, stage, revenue_cents, created_at FROM fe)
    WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "funnel-layout")
    have = t.funnel_events.withColumn("anonymous_id", F.col("person"))
    declared = schemas.schema_of("analytics_funnel_events")
    typed = have.select(
        *[(F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared.fields]
    )
    layout.write_table(typed, "analytics_funnel_events", path)
    days = layout.read_days(t.spark, "analytics_funnel_events", path, "2024-01-10", "2024-01-12")
    return days.select("id", F.col("anonymous_id").alias("person"), "stage", "revenue_cents")
