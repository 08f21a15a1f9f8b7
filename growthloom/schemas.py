"""Declared table schemas, enum domains and keys.

Keys are strings unless a caller's own tables use other key types.  JSON
columns are strings; money is whole cents.
"""
from __future__ import annotations

from pyspark.sql import types as T

# The data model ------------------------------------------------
TABLES: dict[str, str] = {
    "profiles": """id string, auth_id string, email string, full_name string, avatar_url string, email_opt_in boolean,
        marketing_consent_granted_at timestamp, marketing_consent_ip string, is_member boolean, member_since timestamp,
        stripe_customer_id string, referred_by string, referral_code string, metadata string, created_at timestamp,
        updated_at timestamp""",
    "user_sessions": """id string, profile_id string, session_token string, user_agent string, ip_address string,
        referrer_url string, landing_page string, started_at timestamp, last_active_at timestamp, ended_at timestamp""",
    "email_tags": "id string, name string, slug string, description string, color string, created_at timestamp",
    "membership_plans": """id string, name string, slug string, description string, price_cents long, currency string,
        interval string, stripe_price_id string, stripe_product_id string, features string, is_active boolean,
        sort_order int, created_at timestamp, updated_at timestamp""",
    "digital_products": """id string, name string, slug string, description string, price_cents long, currency string,
        compare_at_price_cents long, product_type string, file_urls string, gumroad_product_id string,
        stripe_price_id string, affiliate_commission_pct decimal(5,2), inventory_count int, inventory_remaining int,
        is_active boolean, is_featured boolean, created_at timestamp, updated_at timestamp""",
    "content_templates": """id string, name string, slug string, description string, hook_format string,
        point_1_framework string, point_2_framework string, point_3_framework string, cta_framework string,
        category string, primary_trigger string, avg_performance decimal(3,1), times_used int, is_active boolean,
        created_at timestamp, updated_at timestamp""",
    "viral_hooks": """id string, hook_text string, category string, trigger_type string,
        estimated_performance decimal(3,1), actual_performance decimal(3,1), times_used int, last_used_at timestamp,
        variant_group string, winning_variant_id string, created_at timestamp, updated_at timestamp""",
    "content_scripts": """id string, title string, hook_text string, body_text string, cta_text string,
        ai_prompt string, ai_temperature decimal(3,2), ai_model string, tokens_used int, word_count int, version int,
        previous_version_id string, tags array<string>, category string, estimated_performance decimal(3,1),
        created_at timestamp, updated_at timestamp""",
    "content_videos": """id string, title string, slug string, hook_id string, template_id string, script_id string,
        script_text string, word_count int, platforms array<string>, published_at timestamp, scheduled_for timestamp,
        video_url string, thumbnail_url string, s3_storage_path string, duration_seconds int, ai_model string,
        ai_voice_id string, status string, total_views long, total_likes long, total_shares long, total_comments long,
        total_saves long, avg_watch_seconds decimal(5,2), cta_type string, cta_url string, cta_clicks long,
        seo_tags array<string>, seo_description string, created_at timestamp, updated_at timestamp""",
    "content_publishing_queue": """id string, video_id string, platform string, scheduled_for timestamp,
        published_at timestamp, status string, platform_post_id string, platform_url string, error_message string,
        retry_count int, max_retries int, created_at timestamp, updated_at timestamp""",
    "email_subscribers": """id string, email string, full_name string, profile_id string, source string,
        source_url string, source_video_id string, status string, unsubscribed_at timestamp, bounce_reason string,
        last_opened_at timestamp, last_clicked_at timestamp, total_opens int, total_clicks int, total_emails_sent int,
        has_purchased boolean, lifetime_value decimal(10,2), beehiiv_subscriber_id string,
        convertkit_subscriber_id string, double_opt_in_confirmed boolean, consent_ip string,
        consent_timestamp timestamp, created_at timestamp, updated_at timestamp""",
    "email_subscriber_tags": "subscriber_id string, tag_id string, applied_at timestamp",
    "email_campaigns": """id string, name string, sequence_name string, step_number int, subject string,
        preview_text string, body_html string, body_text string, target_tags array<string>, exclude_tags array<string>,
        delay_hours int, send_at timestamp, status string, total_sent int, total_opens int, total_clicks int,
        total_unsubs int, created_at timestamp, updated_at timestamp""",
    "email_campaign_logs": """id string, campaign_id string, subscriber_id string, sent_at timestamp,
        delivered_at timestamp, opened_at timestamp, clicked_at timestamp, unsubscribed_at timestamp, open_count int,
        click_count int, last_open_at timestamp, last_click_at timestamp, clicked_links string, status string,
        error_message string, message_id string, created_at timestamp""",
    "purchases": """id string, product_id string, profile_id string, subscriber_id string, customer_email string,
        customer_name string, amount_cents long, currency string, fee_cents long, processor string,
        processor_charge_id string, processor_payment_intent string, status string, refunded_at timestamp,
        refund_amount_cents long, affiliate_id string, affiliate_commission_cents long, source_video_id string,
        source_url string, utm_source string, utm_medium string, utm_campaign string, created_at timestamp,
        updated_at timestamp""",
    "purchase_items": """id string, purchase_id string, product_id string, quantity int, unit_price_cents long,
        download_url string, download_count int, access_granted boolean, access_granted_at timestamp,
        created_at timestamp""",
    "memberships": """id string, profile_id string, plan_id string, stripe_subscription_id string,
        stripe_customer_id string, status string, current_period_start timestamp, current_period_end timestamp,
        trial_start timestamp, trial_end timestamp, canceled_at timestamp, ended_at timestamp,
        cancel_at_period_end boolean, cancellation_reason string, cancellation_reason_detail string,
        price_cents_at_subscription long, referral_count int, lifetime_value_cents long, created_at timestamp,
        updated_at timestamp""",
    "membership_events": """id string, membership_id string, profile_id string, event_type string,
        previous_plan_id string, new_plan_id string, previous_price long, new_price long, metadata string,
        created_at timestamp""",
    "automation_membership_blueprints": """id string, name string, slug string, description string, platform string,
        category string, blueprint_json string, preview_image_url string, difficulty string,
        estimated_setup_minutes int, tools_required array<string>, is_featured boolean, download_count int,
        created_at timestamp, updated_at timestamp""",
    "analytics_page_views": """id string, profile_id string, session_id string, url string, path string,
        referrer_url string, utm_source string, utm_medium string, utm_campaign string, utm_content string,
        utm_term string, user_agent string, device_type string, browser string, os string, ip_address string,
        country string, page_load_ms int, time_on_page_seconds int, viewed_at timestamp""",
    "analytics_content_events": """id string, video_id string, platform string, event_date date, views long, likes long,
        shares long, comments long, saves long, avg_watch_seconds decimal(5,2), completion_rate decimal(5,4),
        follower_gain long, reach long, impressions long, from_fyp long, from_profile long, from_search long,
        from_hashtags long, created_at timestamp""",
    "analytics_funnel_events": """id string, profile_id string, anonymous_id string, session_id string, stage string,
        source_video_id string, source_url string, referrer_url string, utm_source string, utm_medium string,
        utm_campaign string, revenue_cents long, time_to_convert_seconds long, created_at timestamp""",
    "analytics_daily_metrics": """id string, metric_date date, videos_published long, total_content_views long,
        total_engagement long, new_followers long, total_followers long, profile_visits long, landing_page_views long,
        new_subscribers long, total_subscribers long, lead_magnet_downloads long, tripwire_sales long,
        tripwire_revenue_cents long, membership_new_sales long, membership_revenue_cents long,
        automation_package_sales long, automation_revenue_cents long, affiliate_payouts_cents long,
        total_revenue_cents long, active_members long, churned_members long, churn_rate decimal(5,4),
        membership_churn_rate decimal(5,4), workflows_run long, workflows_failed long,
        automation_uptime_pct decimal(5,2), created_at timestamp""",
    "affiliates": """id string, profile_id string, email string, full_name string, paypal_email string,
        wise_email string, referral_code string, referral_link string, cookie_days int, commission_pct decimal(5,2),
        lifetime_value_share boolean, tier string, total_earned_cents long, total_paid_cents long, pending_cents long,
        is_active boolean, approved_at timestamp, created_at timestamp, updated_at timestamp""",
    "affiliate_referrals": """id string, affiliate_id string, referred_email string, referred_profile_id string,
        source_url string, clicked_at timestamp, converted_at timestamp, converted boolean, purchase_id string,
        purchase_amount_cents long, commission_cents long, commission_paid boolean, commission_paid_at timestamp,
        created_at timestamp""",
    "affiliate_commissions": """id string, affiliate_id string, referral_id string, amount_cents long, currency string,
        commission_type string, recurrence_number int, source_purchase_id string, source_membership_id string,
        status string, payout_id string, paid_at timestamp, created_at timestamp, updated_at timestamp""",
    "automation_workflows": """id string, name string, slug string, description string, platform string,
        workflow_json string, external_id string, category string, trigger_type string, cron_expression string,
        is_active boolean, last_run_at timestamp, last_run_status string, alert_email string, max_retries int,
        version int, created_at timestamp, updated_at timestamp""",
    "automation_execution_logs": """id string, workflow_id string, execution_id string, started_at timestamp,
        completed_at timestamp, status string, error_message string, error_stack string, input_data string,
        output_data string, trigger_source string, trigger_detail string, related_video_id string,
        related_subscriber_id string, related_purchase_id string, created_at timestamp""",
}

STAGES = [
    "content_view", "profile_visit", "landing_page_view", "lead_magnet_download", "tripwire_view",
    "tripwire_purchase", "membership_view", "membership_started", "membership_purchased",
    "automation_package_view", "automation_package_purchase", "affiliate_signup", "referral_click",
]
PLATFORMS = ["tiktok", "instagram", "youtube"]
PRODUCT_TYPES = ["lead_magnet", "tripwire", "membership", "automation_package", "bundle"]

ENUMS: dict[tuple[str, str], list[str]] = {
    ("membership_plans", "interval"): ["month", "year"],
    ("digital_products", "product_type"): PRODUCT_TYPES,
    ("content_videos", "status"): ["draft", "rendering", "scheduled", "published", "failed", "archived"],
    ("content_publishing_queue", "platform"): PLATFORMS,
    ("content_publishing_queue", "status"): ["queued", "processing", "published", "failed", "skipped"],
    ("email_subscribers", "source"): ["lead_magnet", "purchase", "tripwire", "landing_page", "manual", "referral"],
    ("email_subscribers", "status"): ["active", "unsubscribed", "bounced", "spam"],
    ("email_campaigns", "status"): ["draft", "active", "sending", "completed", "paused", "archived"],
    ("email_campaign_logs", "status"): [
        "pending", "sent", "delivered", "opened", "clicked", "bounced", "failed", "unsubscribed",
    ],
    ("purchases", "processor"): ["stripe", "gumroad", "paypal"],
    ("purchases", "status"): ["pending", "completed", "refunded", "partially_refunded", "failed", "disputed"],
    ("memberships", "status"): ["trialing", "active", "past_due", "canceled", "incomplete", "incomplete_expired"],
    ("membership_events", "event_type"): [
        "created", "renewed", "upgraded", "downgraded", "canceled", "reactivated", "expired", "payment_failed",
    ],
    ("automation_membership_blueprints", "platform"): ["n8n", "make", "zapier"],
    ("automation_membership_blueprints", "category"): [
        "content_automation", "email_automation", "lead_generation", "data_processing", "social_media",
        "productivity", "ai_prompts", "analytics", "custom",
    ],
    ("automation_membership_blueprints", "difficulty"): ["beginner", "intermediate", "advanced"],
    ("analytics_content_events", "platform"): PLATFORMS,
    ("analytics_funnel_events", "stage"): STAGES,
    ("affiliates", "tier"): ["standard", "premium", "elite"],
    ("affiliate_commissions", "commission_type"): ["one_time", "recurring"],
    ("affiliate_commissions", "status"): ["pending", "approved", "paid", "cancelled", "refunded"],
    ("automation_workflows", "platform"): ["n8n", "make", "zapier", "custom"],
    ("automation_workflows", "category"): [
        "content_publishing", "email_marketing", "lead_capture", "payment_processing", "analytics", "affiliate",
        "community", "monitoring", "data_sync", "onboarding", "retention",
    ],
    ("automation_execution_logs", "status"): ["running", "success", "failed", "timeout", "cancelled"],
}

DEFAULTS: dict[str, dict[str, object]] = {
    "profiles": {"email_opt_in": True, "is_member": False, "metadata": "{}"},
    "email_tags": {"color": "#6366f1"},
    "membership_plans": {"currency": "usd", "features": "[]", "is_active": True, "sort_order": 0},
    "digital_products": {
        "currency": "usd", "file_urls": "[]", "affiliate_commission_pct": "0.00", "is_active": True,
        "is_featured": False,
    },
    "content_templates": {"avg_performance": "0.0", "times_used": 0, "is_active": True},
    "viral_hooks": {"times_used": 0},
    "content_scripts": {"ai_temperature": "0.70", "ai_model": "gpt-4", "version": 1},
    "content_videos": {
        "ai_model": "elevenlabs", "status": "draft", "total_views": 0, "total_likes": 0, "total_shares": 0,
        "total_comments": 0, "total_saves": 0, "cta_clicks": 0,
    },
    "content_publishing_queue": {"status": "queued", "retry_count": 0, "max_retries": 3},
    "email_subscribers": {
        "status": "active", "total_opens": 0, "total_clicks": 0, "total_emails_sent": 0, "has_purchased": False,
        "lifetime_value": "0.00", "double_opt_in_confirmed": False,
    },
    "email_campaigns": {
        "delay_hours": 0, "status": "draft", "total_sent": 0, "total_opens": 0, "total_clicks": 0, "total_unsubs": 0,
    },
    "email_campaign_logs": {"open_count": 0, "click_count": 0, "clicked_links": "[]", "status": "pending"},
    "purchases": {
        "currency": "usd", "fee_cents": 0, "processor": "stripe", "status": "pending",
        "affiliate_commission_cents": 0,
    },
    "purchase_items": {"quantity": 1, "download_count": 0, "access_granted": False},
    "memberships": {
        "status": "trialing", "cancel_at_period_end": False, "referral_count": 0, "lifetime_value_cents": 0,
    },
    "membership_events": {"metadata": "{}"},
    "automation_membership_blueprints": {"is_featured": False, "download_count": 0},
    "analytics_content_events": {"views": 0, "likes": 0, "shares": 0, "comments": 0, "saves": 0, "follower_gain": 0},
    "analytics_funnel_events": {"revenue_cents": 0},
    "affiliates": {
        "cookie_days": 60, "commission_pct": "30.00", "lifetime_value_share": False, "tier": "standard",
        "total_earned_cents": 0, "total_paid_cents": 0, "pending_cents": 0, "is_active": True,
    },
    "affiliate_referrals": {"converted": False, "commission_paid": False},
    "affiliate_commissions": {"currency": "usd", "status": "pending"},
    "automation_workflows": {"is_active": True, "max_retries": 3, "version": 1},
    "automation_execution_logs": {"status": "running", "trigger_detail": "{}"},
}

NATURAL_KEYS: dict[str, list[str]] = {
    "profiles": ["email"],
    "viral_hooks": ["hook_text"],
    "email_tags": ["slug"],
    "email_subscribers": ["email"],
    "email_subscriber_tags": ["subscriber_id", "tag_id"],
    "memberships": ["stripe_subscription_id"],
    "analytics_content_events": ["video_id", "platform", "event_date"],
    "analytics_daily_metrics": ["metric_date"],
    "affiliates": ["referral_code"],
}

REQUIRED: dict[str, list[str]] = {
    "profiles": ["email"],
    "user_sessions": ["profile_id", "session_token"],
    "email_tags": ["name", "slug"],
    "membership_plans": ["name", "slug", "price_cents", "interval"],
    "digital_products": ["name", "slug", "price_cents", "product_type"],
    "content_templates": [
        "name", "slug", "hook_format", "point_1_framework", "point_2_framework", "point_3_framework", "cta_framework",
        "category",
    ],
    "viral_hooks": ["hook_text", "category", "trigger_type", "estimated_performance"],
    "content_scripts": ["title", "hook_text", "body_text"],
    "content_videos": ["title", "slug", "script_text"],
    "content_publishing_queue": ["video_id", "platform", "scheduled_for"],
    "email_subscribers": ["email", "source"],
    "email_subscriber_tags": ["subscriber_id", "tag_id"],
    "email_campaigns": ["name", "sequence_name", "step_number", "subject"],
    "email_campaign_logs": ["campaign_id", "subscriber_id"],
    "purchases": ["product_id", "customer_email", "amount_cents"],
    "purchase_items": ["purchase_id", "product_id", "unit_price_cents"],
    "memberships": [
        "profile_id", "plan_id", "current_period_start", "current_period_end", "price_cents_at_subscription",
    ],
    "membership_events": ["membership_id", "profile_id", "event_type"],
    "automation_membership_blueprints": ["name", "slug", "platform", "category", "blueprint_json"],
    "analytics_page_views": ["url", "path"],
    "analytics_content_events": ["video_id", "platform", "event_date"],
    "analytics_funnel_events": ["stage"],
    "analytics_daily_metrics": ["metric_date"],
    "affiliates": ["email", "full_name", "referral_code", "referral_link"],
    "affiliate_referrals": ["affiliate_id", "referred_email"],
    "affiliate_commissions": ["affiliate_id", "amount_cents", "commission_type"],
    "automation_workflows": ["name", "slug", "platform", "category"],
    "automation_execution_logs": ["workflow_id"],
}

# (table, column) -> lowest, highest, lowest itself excluded
RANGES: dict[tuple[str, str], tuple[float | None, float | None, bool]] = {
    ("membership_plans", "price_cents"): (0, None, True),
    ("digital_products", "price_cents"): (0, None, False),
    ("viral_hooks", "estimated_performance"): (0, 10, False),
}

# child table, column, parent table, what a delete of the parent does
LINKS: list[tuple[str, str, str, str]] = [
    ("profiles", "referred_by", "profiles", "set null"),
    ("user_sessions", "profile_id", "profiles", "cascade"),
    ("viral_hooks", "winning_variant_id", "viral_hooks", "set null"),
    ("content_scripts", "previous_version_id", "content_scripts", "set null"),
    ("content_videos", "hook_id", "viral_hooks", "set null"),
    ("content_videos", "template_id", "content_templates", "set null"),
    ("content_videos", "script_id", "content_scripts", "set null"),
    ("content_publishing_queue", "video_id", "content_videos", "cascade"),
    ("email_subscribers", "profile_id", "profiles", "set null"),
    ("email_subscribers", "source_video_id", "content_videos", "set null"),
    ("email_subscriber_tags", "subscriber_id", "email_subscribers", "cascade"),
    ("email_subscriber_tags", "tag_id", "email_tags", "cascade"),
    ("email_campaign_logs", "campaign_id", "email_campaigns", "cascade"),
    ("email_campaign_logs", "subscriber_id", "email_subscribers", "cascade"),
    ("purchases", "product_id", "digital_products", "restrict"),
    ("purchases", "profile_id", "profiles", "set null"),
    ("purchases", "subscriber_id", "email_subscribers", "set null"),
    ("purchases", "affiliate_id", "affiliates", "set null"),
    ("purchases", "source_video_id", "content_videos", "set null"),
    ("purchase_items", "purchase_id", "purchases", "cascade"),
    ("purchase_items", "product_id", "digital_products", "restrict"),
    ("memberships", "profile_id", "profiles", "cascade"),
    ("memberships", "plan_id", "membership_plans", "restrict"),
    ("membership_events", "membership_id", "memberships", "cascade"),
    ("membership_events", "profile_id", "profiles", "cascade"),
    ("membership_events", "previous_plan_id", "membership_plans", "restrict"),
    ("membership_events", "new_plan_id", "membership_plans", "restrict"),
    ("analytics_page_views", "profile_id", "profiles", "set null"),
    ("analytics_page_views", "session_id", "user_sessions", "set null"),
    ("analytics_content_events", "video_id", "content_videos", "cascade"),
    ("analytics_funnel_events", "profile_id", "profiles", "set null"),
    ("analytics_funnel_events", "session_id", "user_sessions", "set null"),
    ("analytics_funnel_events", "source_video_id", "content_videos", "set null"),
    ("affiliates", "profile_id", "profiles", "cascade"),
    ("affiliate_referrals", "affiliate_id", "affiliates", "cascade"),
    ("affiliate_referrals", "referred_profile_id", "profiles", "set null"),
    ("affiliate_referrals", "purchase_id", "purchases", "set null"),
    ("affiliate_commissions", "affiliate_id", "affiliates", "cascade"),
    ("affiliate_commissions", "referral_id", "affiliate_referrals", "set null"),
    ("affiliate_commissions", "source_purchase_id", "purchases", "set null"),
    ("affiliate_commissions", "source_membership_id", "memberships", "set null"),
    ("automation_execution_logs", "workflow_id", "automation_workflows", "cascade"),
]

# Message bodies
LEAD_MESSAGE = """email string, name string, source string, source_url string, source_video_id string,
    double_opt_in boolean, ip string"""
CHECKOUT_MESSAGE = """type string, data struct<object: struct<id: string, mode: string, amount_total: bigint,
    currency: string, payment_status: string, customer: string, subscription: string, customer_email: string,
    customer_details: struct<email: string, name: string>,
    metadata: struct<product_id: string, price_id: string>>>"""
AFFILIATE_MESSAGE = """purchase_id string, affiliate_id string, referral_code string, amount_cents bigint, product_type string,
    commission_pct double, customer_email string, profile_id string, membership_id string, is_recurring boolean"""
SUBSCRIPTION_MESSAGE = """type string, data struct<object: struct<id: string, status: string, customer: string,
    current_period_start: bigint, current_period_end: bigint, trial_start: bigint, trial_end: bigint,
    cancel_at_period_end: boolean, canceled_at: bigint, ended_at: bigint,
    metadata: struct<email: string, plan_id: string, price_cents: bigint>,
    items: struct<data: array<struct<price: struct<unit_amount: bigint, currency: string,
    recurring: struct<interval: string>>>>>>>"""
# -----------------------------------------------------------------------------


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])
