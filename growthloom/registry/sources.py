"""Input bundles the queries share."""
from __future__ import annotations

from pyspark.sql import DataFrame

from growthloom.plans.daily import Sources, daily_metrics
from growthloom.sources.fixtures import FIRST_DAY, LAST_DAY, Tables


def sources(t: Tables) -> Sources:
    return Sources(
        funnel=t.funnel_events, purchases=t.purchases, products=t.products, subscribers=t.subscribers,
        videos=t.videos, content=t.content_events, logs=t.execution_logs,
    )


def mart(t: Tables) -> DataFrame:
    return daily_metrics(sources(t), FIRST_DAY, LAST_DAY)
