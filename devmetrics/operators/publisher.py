"""Which collected logs still have to be published on their pull requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.payload import field, parse_payload
from devmetrics.functions.time import Instant, instant
from devmetrics.operators.artifacts import without_keys
from devmetrics.operators.incremental import on_or_after_day
from devmetrics.schemas import INVOCATION_COMMENT

# How far back runs and merges count, and how long a merge must have settled.
LOOKBACK = "INTERVAL 30 DAYS"
SETTLE = "INTERVAL 1 HOUR"


def recent_workflow_pull_requests(events: DataFrame, since: Column) -> DataFrame:
    """delivery_id, received, head_sha, pull_request_id: one row per pull request of a workflow run.

    Artifact rows exist for ``workflow_run`` events only, so no other event is parsed.
    """
    recent = on_or_after_day(events, since).filter(
        (F.col("event") == "workflow_run") & (F.col("received") >= since)
    )
    parsed = parse_payload(
        recent,
        "workflow_run.head_sha",
        "workflow_run.pull_requests:array<struct<id:string>>",
        keep=("delivery_id", "received"),
    )
    return parsed.select(
        "delivery_id",
        "received",
        field("workflow_run.head_sha").alias("head_sha"),
        F.explode(field("workflow_run.pull_requests")).alias("pr"),
    ).select(
        "delivery_id",
        "received",
        "head_sha",
        F.col("pr.id").try_cast("bigint").alias("pull_request_id"),
    )


def publisher_source(
    pull_request_events: DataFrame,
    artifacts: DataFrame,
    events: DataFrame,
    invocation_comment: DataFrame,
    as_of: Instant,
) -> DataFrame:
    """Artifact rows whose pull request merged recently and was not commented on, in order.

    ``as_of`` stands for the current time. Artifact rows count whatever their status.
    """
    as_of = instant(as_of)
    since = as_of - F.expr(LOOKBACK)
    merged = pull_request_events.filter(
        F.col("merged_at").between(since, as_of - F.expr(SETTLE))
    ).select("delivery_id", "id", "html_url")
    open_prs = without_keys(merged, "id", invocation_comment, "pull_request_id")

    runs = artifacts.select("delivery_id", "logs_uri").join(
        recent_workflow_pull_requests(events, since), "delivery_id"
    )
    return (
        open_prs.join(runs.drop("delivery_id"), F.col("id") == F.col("pull_request_id"))
        .select(
            "delivery_id",
            "pull_request_id",
            F.col("html_url").alias("pull_request_html_url"),
            "received",
            "logs_uri",
            "head_sha",
        )
        .orderBy("received", "pull_request_id")
    )


def invocation_comment_rows(rows: DataFrame) -> DataFrame:
    """``rows`` checked against the comment status table, ready to append."""
    return INVOCATION_COMMENT.conform(rows)
