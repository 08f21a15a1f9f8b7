"""Welcome sequence state."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from growthloom.operators import email as E
from growthloom.operators import upsert as U

STARTED, COMPLETED = "welcome-started", "welcome-completed"


@dataclass
class WelcomeResult:
    due: DataFrame
    tags: DataFrame


def welcome_run(starts: DataFrame, tags: DataFrame, since: Column, as_of: Column) -> WelcomeResult:
    """Steps that fall due in (since, as_of], and the tags after the run.

    `starts` has subscriber_id and started_at.
    """
    plan = E.drip_plan(starts, "subscriber_id", "started_at", as_of)
    due = plan.where((F.col("send_at") > since) & (F.col("send_at") <= as_of))
    state = E.next_step(starts, "subscriber_id", "started_at", as_of)
    begun = U.tag(tags, state.select("subscriber_id"), STARTED)
    done = state.where("completed").select("subscriber_id")
    return WelcomeResult(due, U.swap_tag(begun, done, STARTED, COMPLETED))
