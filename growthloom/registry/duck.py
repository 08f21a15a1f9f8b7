"""The domain tables in DuckDB SQL, written against the raw tables on their own.

Dictionary order is dependency order.
"""

EVENTS_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
ORDERS_AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"

_CAT = "['Mindset','Productivity','Discipline','Money','Relationships','Health']"

CTES: dict[str, str] = {
    "ev": """SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        CAST(round(value * 100) AS BIGINT) AS val_cents FROM events""",
    "fe": """SELECT event_id AS id,
        CASE WHEN user_id % 10 <> 0 THEN user_id END AS profile_id,
        CASE WHEN user_id % 10 = 0 THEN 'a' || user_id END AS anonymous_id,
        CASE WHEN user_id % 10 = 0 THEN 'a' || user_id ELSE CAST(user_id AS VARCHAR) END AS person,
        CASE event_type
          WHEN 'view' THEN CASE WHEN k >= 95 THEN 'referral_click' WHEN k >= 50 THEN 'profile_visit' ELSE 'content_view' END
          WHEN 'click' THEN CASE WHEN k >= 90 THEN 'automation_package_view' WHEN k >= 75 THEN 'membership_view'
                                 WHEN k >= 50 THEN 'tripwire_view' ELSE 'landing_page_view' END
          WHEN 'signup' THEN CASE WHEN k >= 85 THEN 'affiliate_signup' WHEN k >= 70 THEN 'membership_started'
                                  ELSE 'lead_magnet_download' END
          WHEN 'purchase' THEN CASE WHEN k >= 90 THEN 'automation_package_purchase' WHEN k >= 60 THEN 'membership_purchased'
                                    ELSE 'tripwire_purchase' END END AS stage,
        k AS source_video_id,
        ['tiktok','instagram','youtube','email'][k % 4 + 1] AS utm_source,
        ['short_video','bio_link','newsletter'][k % 3 + 1] AS utm_medium, 'batch-' || (k % 5) AS utm_campaign,
        CASE WHEN event_type = 'purchase' THEN val_cents ELSE 0 END AS revenue_cents,
        ts AS created_at
        FROM ev WHERE event_type <> 'error'""",
    "pu": """SELECT event_id AS id, CAST(k AS BIGINT) AS product_id, user_id AS profile_id, val_cents AS amount_cents,
        val_cents // 20 AS fee_cents,
        CASE event_id % 10 WHEN 0 THEN 'refunded' WHEN 1 THEN 'pending' ELSE 'completed' END AS status,
        CASE WHEN event_id % 3 = 0 THEN event_id % (SELECT count(*) FROM supplier) END AS affiliate_id,
        k AS source_video_id, ['tiktok','instagram','youtube','email'][k % 4 + 1] AS utm_source,
        ['short_video','bio_link','newsletter'][k % 3 + 1] AS utm_medium, 'batch-' || (k % 5) AS utm_campaign, ts AS created_at
        FROM ev WHERE event_type = 'purchase'""",
    "dp": """SELECT p_partkey AS id, p_name AS name, p_brand AS brand,
        CASE p_type WHEN 'ECONOMY' THEN 'lead_magnet' WHEN 'SMALL' THEN 'tripwire' WHEN 'PROMO' THEN 'tripwire'
          WHEN 'MEDIUM' THEN 'membership' WHEN 'LARGE' THEN 'automation_package' ELSE 'bundle' END AS product_type,
        CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents,
        CAST(round(p_retailprice * 100) AS BIGINT) + p_size * 100 AS compare_at_price_cents,
        'price_' || p_partkey AS stripe_price_id,
        'https://files.example.com/' || p_partkey AS first_file,
        CAST(p_size AS BIGINT) * 1000 AS inventory_count, p_size <= 45 AS is_active FROM part""",
    "ce": """SELECT k AS video_id, ['tiktok','instagram','youtube'][user_id % 3 + 1] AS platform, CAST(ts AS DATE) AS event_date,
        count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS likes,
        count(*) FILTER (event_type = 'signup') AS saves, count(*) FILTER (event_type = 'purchase') AS shares,
        count(*) FILTER (event_type = 'error') AS comments,
        CAST(coalesce(sum(val_cents) FILTER (event_type = 'view'), 0) AS BIGINT) AS watch_cs,
        count(*) FILTER (event_type = 'signup' AND value >= 60) AS follower_gain,
        count(*) FILTER (event_type = 'view' AND event_id % 4 = 0) AS from_fyp,
        count(*) FILTER (event_type = 'view' AND event_id % 4 = 1) AS from_profile,
        count(*) FILTER (event_type = 'view' AND event_id % 4 = 2) AS from_search,
        count(*) FILTER (event_type = 'view' AND event_id % 4 = 3) AS from_hashtags
        FROM ev GROUP BY ALL""",
    "vi": f"""SELECT k AS id, min(ts) AS published_at, count(*) FILTER (event_type = 'view') AS total_views,
        count(*) FILTER (event_type = 'click') AS total_likes, count(*) FILTER (event_type = 'signup') AS total_saves,
        count(*) FILTER (event_type = 'purchase') AS total_shares, count(*) FILTER (event_type = 'error') AS total_comments,
        CAST(k % 40 AS BIGINT) AS hook_id,
        CASE k % 5 WHEN 0 THEN 'draft' WHEN 1 THEN 'scheduled' ELSE 'published' END AS status,
        CASE k % 3 WHEN 0 THEN ['tiktok'] WHEN 1 THEN ['tiktok','instagram'] ELSE ['youtube'] END AS platforms,
        {_CAT}[k % 6 + 1] AS category FROM ev GROUP BY k""",
    "pr": """SELECT c_custkey AS id, 'auth-' || c_custkey AS auth_id,
        lower(replace(c_name, '#', '.')) || '@example.com' AS email, c_name AS full_name,
        'cus_' || c_custkey AS stripe_customer_id,
        CASE WHEN c_custkey > 0 THEN c_custkey // 4 END AS referred_by,
        CAST(round(c_acctbal * 100) AS BIGINT) AS acct_cents, c_nationkey AS nation, c_mktsegment AS segment FROM customer""",
    "su": """SELECT p.id, p.email, p.full_name, p.id AS profile_id,
        CASE WHEN p.acct_cents < 0 THEN 'unsubscribed' ELSE 'active' END AS status,
        ['lead_magnet','purchase','tripwire','landing_page','manual','referral'][p.nation % 6 + 1] AS source,
        s.* EXCLUDE (user_id)
        FROM pr p JOIN (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS created_at,
          max(ts) FILTER (event_type = 'view') AS last_opened_at, max(ts) FILTER (event_type = 'click') AS last_clicked_at,
          count(*) FILTER (event_type = 'view') AS total_opens, count(*) FILTER (event_type = 'click') AS total_clicks,
          CAST(coalesce(sum(val_cents) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS ltv_cents,
          count(*) FILTER (event_type = 'purchase') > 0 AS has_purchased
          FROM ev GROUP BY user_id) s ON s.user_id = p.id""",
    "st": "SELECT DISTINCT user_id AS subscriber_id, event_type || '-' || (k // 5) AS tag FROM ev",
    "cl": """SELECT event_id AS id, CAST(k % 5 AS BIGINT) AS campaign_id, user_id AS subscriber_id,
        CASE WHEN event_type = 'signup' THEN ts END AS delivered_at, CASE WHEN event_type = 'view' THEN ts END AS opened_at,
        CASE WHEN event_type = 'click' THEN ts END AS clicked_at, CASE WHEN k >= 98 THEN ts END AS unsubscribed_at,
        ts AS sent_at, k, event_type FROM ev WHERE event_type IN ('view','click','signup')""",
    "pq": """SELECT event_id AS id, k AS video_id, ['tiktok','instagram','youtube'][user_id % 3 + 1] AS platform,
        ts AS scheduled_for, CASE event_type WHEN 'view' THEN 'published' WHEN 'click' THEN 'queued'
          WHEN 'signup' THEN 'processing' WHEN 'purchase' THEN 'skipped' ELSE 'failed' END AS status,
        event_id % 5 AS retry_count, 3 AS max_retries FROM ev""",
    "wf": "SELECT range AS id, 'workflow-' || range AS name FROM range(9)",
    "lg": """SELECT event_id AS id, user_id % 8 AS workflow_id,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, ts AS started_at,
        ts + to_microseconds(val_cents * 10000) AS completed_at, val_cents AS run_cs FROM ev""",
    "orr": "SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents FROM orders",
    "me": f"""SELECT o.profile_id AS id, o.profile_id, 'sub_' || o.profile_id AS stripe_subscription_id,
        CASE WHEN o.profile_id % 5 = 0 THEN 'year' ELSE 'month' END AS plan,
        CAST(CASE WHEN o.profile_id % 5 = 0 THEN 19000 ELSE 1900 END AS BIGINT) AS price_cents,
        CASE WHEN c.acct_cents < 0 THEN 'past_due' WHEN o.profile_id % 7 = 0 THEN 'canceled' ELSE 'active' END AS status,
        o.last_o AS current_period_start, o.last_o + INTERVAL 30 DAY AS current_period_end,
        CASE WHEN c.acct_cents >= 0 AND o.profile_id % 7 = 0
          THEN {ORDERS_AS_OF} - to_hours(CAST(o.profile_id % 72 AS BIGINT)) END AS ended_at,
        o.profile_id % 13 = 0 AS cancel_at_period_end,
        CASE WHEN c.acct_cents >= 0 AND o.profile_id % 7 = 0 THEN lower(c.segment) END AS cancellation_reason,
        o.first_o AS created_at
        FROM (SELECT o_custkey AS profile_id, max(o_orderdate) AS last_o, min(o_orderdate) AS first_o
              FROM orders GROUP BY 1) o JOIN pr c ON c.id = o.profile_id""",
    "ph": """SELECT o_orderkey AS id, o_custkey AS profile_id, price_cents AS amount_cents, price_cents // 20 AS fee_cents,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'partially_refunded' END AS status,
        lower(split_part(o_orderpriority, '-', 2)) AS utm_medium, o_orderdate AS created_at FROM orr""",
    "it": """SELECT l_orderkey AS purchase_id, l_partkey AS product_id, l_linenumber AS line_no,
        CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS line_cents,
        CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT) AS unit_price_cents, l_returnflag AS returnflag FROM lineitem""",
    "af": """SELECT s_suppkey AS id, s_suppkey AS profile_id, 'AFF' || s_suppkey AS referral_code, s_name AS full_name,
        CASE WHEN s_acctbal < 3000 THEN 'standard' WHEN s_acctbal < 7000 THEN 'premium' ELSE 'elite' END AS tier,
        CAST(30.0 AS DOUBLE) AS commission_pct, s_acctbal >= 0 AS is_active,
        CASE s_suppkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 365 ELSE 60 END AS cookie_days, s_suppkey * 100 AS total_earned_cents,
        s_suppkey * 40 AS total_paid_cents, s_suppkey * 60 AS pending_cents FROM supplier""",
    "am": """SELECT 'p' || event_id AS purchase_id, event_id, user_id, ts AS received_at,
        CASE WHEN event_id % 50 <> 0 THEN val_cents ELSE 0 END AS amount_cents,
        CASE WHEN k < 30 THEN 'tripwire' WHEN k < 60 THEN 'membership' WHEN k < 80 THEN 'automation_package' WHEN k < 90 THEN 'course' ELSE 'tripwire' END AS product_type,
        k >= 30 AND k < 60 AND event_id % 2 = 0 AS is_recurring, k % 4 = 0 AS own_rate,
        CASE WHEN event_id % 3 < 2 THEN event_id % (SELECT count(*) FROM supplier) END AS affiliate_id,
        'customer.' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.com' AS email FROM ev WHERE event_type = 'purchase'""",
    "ac": """SELECT am.*, af.tier, af.is_active, CASE tier WHEN 'premium' THEN CAST(floor(base * 1.1::DOUBLE + 0.5) AS BIGINT)
          WHEN 'elite' THEN CAST(floor(base * 1.25::DOUBLE + 0.5) AS BIGINT) ELSE CAST(base AS BIGINT) END AS commission_cents, rate
        FROM (SELECT *, floor(CAST(amount_cents AS DOUBLE) * (rate / 100.0::DOUBLE) + 0.5) AS base FROM
          (SELECT *, CASE WHEN own_rate THEN 45 ELSE CASE product_type WHEN 'membership' THEN 30 WHEN 'automation_package' THEN 20 WHEN 'tripwire' THEN 40 ELSE 30 END
             END::DOUBLE AS rate FROM am)) am JOIN af ON af.id = am.affiliate_id""",
    "rf": """SELECT l_suppkey AS affiliate_id, o_custkey AS profile_id, l_orderkey AS purchase_id, l_linenumber AS line_no,
        o_orderdate AS clicked_at, l_shipdate AS converted_at, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cm": """SELECT l_suppkey AS affiliate_id, l_orderkey AS purchase_id,
        CAST(floor(CAST(round(l_extendedprice * 100) AS DOUBLE) * (30.0::DOUBLE / 100.0::DOUBLE) + 0.5::DOUBLE) AS BIGINT) AS amount_cents,
        CASE WHEN l_returnflag = 'R' THEN 'refunded' WHEN l_linestatus = 'F' THEN 'paid'
          WHEN l_returnflag = 'A' THEN 'approved' ELSE 'pending' END AS status, l_shipdate AS created_at FROM lineitem""",
    "ho": f"""SELECT item_id AS id, text AS hook_text, {_CAT}[item_id % 6 + 1] AS category,
        ['Insight','Urgency','Authority','Curiosity'][item_id % 4 + 1] AS trigger_type,
        CAST((70 + (item_id * 7) % 30) / 10.0 AS DECIMAL(3,1)) AS estimated_performance,
        CASE WHEN item_id % 5 <> 0 THEN CAST((70 + (item_id * 7) % 30 + (item_id * 3) % 11 - 5) / 10.0 AS DECIMAL(3,1)) END
          AS actual_performance,
        item_id % 7 AS times_used, item_id % 8 AS variant_group FROM benchmark""",
    "sc": f"""SELECT doc_id AS id, text AS body_text, string_split(text, chr(10)) AS lines,
        CASE WHEN doc_id > 0 THEN doc_id // 3 END AS previous_version_id, {_CAT}[doc_id % 6 + 1] AS category, lang, source
        FROM documents""",
    "ln": """SELECT id, category, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM sc""",
    "wl": r"""SELECT id, category, line, CAST(line_no AS BIGINT) AS line_no,
        CAST(len(list_filter(regexp_split_to_array(line, '\s+'), lambda x: x <> '')) AS BIGINT) AS words FROM ln""",
    "pv": """SELECT page_id AS id, url, CASE WHEN host LIKE 'm.%' THEN 'Mozilla/5.0 (iPhone) Mobile'
          WHEN host LIKE 'blog.%' THEN 'Mozilla/5.0 (iPad)' ELSE 'Mozilla/5.0 (X11; Linux x86_64)' END AS user_agent,
        host, path, query, page_load_ms, ['US','DE','FR','GB','IN'][page_id % 5 + 1] AS country, CASE WHEN page_id % 9 > 0 THEN page_id * 37 % 300 END AS stay
        FROM (SELECT page_id, url, length(html) AS page_load_ms,
          regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
          CASE WHEN regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) = '' THEN '/'
               ELSE regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) END AS path,
          regexp_extract(url, '[?]([^#]*)', 1) AS query FROM pages)""",
    "dm": """SELECT d.metric_date,
        coalesce(s.profile_visits, 0) AS profile_visits, coalesce(s.landing_page_views, 0) AS landing_page_views,
        coalesce(s.lead_magnet_downloads, 0) AS lead_magnet_downloads, coalesce(s.tripwire_sales, 0) AS tripwire_sales,
        coalesce(s.membership_new_sales, 0) AS membership_new_sales,
        coalesce(s.automation_package_sales, 0) AS automation_package_sales,
        coalesce(m.tripwire_revenue_cents, 0) AS tripwire_revenue_cents,
        coalesce(m.membership_revenue_cents, 0) AS membership_revenue_cents,
        coalesce(m.automation_revenue_cents, 0) AS automation_revenue_cents,
        coalesce(m.total_revenue_cents, 0) AS total_revenue_cents,
        coalesce(n.new_subscribers, 0) AS new_subscribers, coalesce(v.videos_published, 0) AS videos_published,
        coalesce(c.total_content_views, 0) AS total_content_views, coalesce(c.total_engagement, 0) AS total_engagement,
        coalesce(c.new_followers, 0) AS new_followers,
        coalesce(r.workflows_run, 0) AS workflows_run, coalesce(r.workflows_failed, 0) AS workflows_failed,
        coalesce(r.workflow_total, 0) AS workflow_total,
        (SELECT count(*) FROM su WHERE status = 'active' AND (created_at IS NULL OR CAST(created_at AS DATE) <= d.metric_date)) AS total_subscribers,
        (SELECT CAST(coalesce(sum(follower_gain), 0) AS BIGINT) FROM ce WHERE event_date <= d.metric_date) AS total_followers,
        round(r.workflows_run * 100.0::DOUBLE / nullif(r.workflow_total, 0), 2) AS automation_uptime_pct
        FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS metric_date) d
        LEFT JOIN (SELECT CAST(created_at AS DATE) AS dd,
            count(*) FILTER (stage = 'profile_visit') AS profile_visits,
            count(*) FILTER (stage = 'landing_page_view') AS landing_page_views,
            count(*) FILTER (stage = 'lead_magnet_download') AS lead_magnet_downloads,
            count(*) FILTER (stage = 'tripwire_purchase') AS tripwire_sales,
            count(*) FILTER (stage = 'membership_purchased') AS membership_new_sales,
            count(*) FILTER (stage = 'automation_package_purchase') AS automation_package_sales
            FROM fe GROUP BY 1) s ON s.dd = d.metric_date
        LEFT JOIN (SELECT CAST(created_at AS DATE) AS dd,
            CAST(coalesce(sum(amount_cents) FILTER (product_type = 'tripwire'), 0) AS BIGINT) AS tripwire_revenue_cents,
            CAST(coalesce(sum(amount_cents) FILTER (product_type = 'membership'), 0) AS BIGINT) AS membership_revenue_cents,
            CAST(coalesce(sum(amount_cents) FILTER (product_type = 'automation_package'), 0) AS BIGINT) AS automation_revenue_cents,
            CAST(sum(amount_cents) AS BIGINT) AS total_revenue_cents
            FROM pu JOIN dp ON dp.id = pu.product_id WHERE pu.status = 'completed' GROUP BY 1) m ON m.dd = d.metric_date
        LEFT JOIN (SELECT CAST(created_at AS DATE) AS dd, count(*) AS new_subscribers FROM su GROUP BY 1) n ON n.dd = d.metric_date
        LEFT JOIN (SELECT CAST(published_at AS DATE) AS dd, count(*) AS videos_published FROM vi WHERE status = 'published'
            GROUP BY 1) v ON v.dd = d.metric_date
        LEFT JOIN (SELECT event_date AS dd, CAST(sum(views) AS BIGINT) AS total_content_views,
            CAST(sum(likes + shares + comments + saves) AS BIGINT) AS total_engagement,
            CAST(sum(follower_gain) AS BIGINT) AS new_followers FROM ce GROUP BY 1) c ON c.dd = d.metric_date
        LEFT JOIN (SELECT CAST(started_at AS DATE) AS dd, count(*) FILTER (status = 'success') AS workflows_run,
            count(*) FILTER (status = 'failed') AS workflows_failed, count(*) AS workflow_total FROM lg GROUP BY 1) r
          ON r.dd = d.metric_date""",
}
