"""Typed activity feed: classify each webhook event and say who did what where."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.payload import field, parse_payload
from devmetrics.operators.incremental import on_or_after_day, watermark
from devmetrics.plans.skew import one_row_per_key
from devmetrics.schemas import BATCH_COLUMN, INTEGRATION_EVENTS, PARTITION_COLUMN

NULL, PRESENT = object(), object()

# Event name, payload fields with their accepted values, resulting type.
EVENT_KINDS = [
    ("create", {"ref_type": ["branch"]}, "BRANCH"),
    ("create", {"ref_type": ["tag"]}, "TAG"),
    ("deployment", {"action": ["created"], "deployment_status.state": NULL}, "DEPLOYMENT_STARTED"),
    ("deployment_status", {"deployment_status.state": ["success"]}, "DEPLOYMENT_ENDED"),
    ("deployment_status", {"deployment_status.state": ["failure", "error"]}, "DEPLOYMENT_FAILED"),
    ("pull_request", {"action": ["assigned"]}, "PR_ASSIGNED"),
    ("pull_request", {"action": ["closed"], "pull_request.merged": ["false"]}, "PR_ABANDONED"),
    ("pull_request", {"action": ["closed"], "pull_request.merged": ["true"]}, "PR_CLOSED"),
    ("pull_request", {"action": ["opened"]}, "PR_OPENED"),
    ("pull_request", {"action": ["ready_for_review"]}, "PR_READY"),
    ("pull_request", {"action": ["review_requested"]}, "PR_REVIEW_REQUEST"),
    ("pull_request_review", {"action": ["submitted"], "review.state": PRESENT}, "PR_SIGNOFF"),
    ("pull_request_review_comment", {"action": ["created", "deleted", "edited"]}, "PR_COMMENT"),
    ("push", {}, "PUSH"),
    ("repository", {"action": ["created"]}, "REPO"),
    ("workflow_job", {"action": ["queued"]}, "JOB_CREATED"),
    ("workflow_job", {"action": ["completed"]}, "JOB_COMPLETED"),
    ("workflow_run", {"action": ["requested"]}, "RUN_CREATED"),
    ("workflow_run", {"action": ["completed"]}, "RUN_COMPLETED"),
]
SYSTEM_EVENTS = ["deployment", "deployment_status", "workflow_job", "workflow_run"]
FEED_NAME = "GITHUB"
USER_ACTION, SYSTEM_ACTION = "USER_INTERACTION", "SYSTEM_ACTION"
ONPREM_ENTERPRISE_PREFIX = "Google-"
ONPREM_SOURCE, HOSTED_SOURCE = "GITHUB_SOURCE_GITHUB_ONPREM", "GITHUB_SOURCE_GITHUB_COM"

CLASSIFIED_EVENTS = list(dict.fromkeys(event for event, _, _ in EVENT_KINDS))

_PATHS = (
    "sender.login", "actor.login", "pull_request.user.login", "issue.user.login",
    "action", "ref_type", "deployment_status.state", "pull_request.merged", "review.state",
    "pull_request.id", "issue.id", "comment.id", "workflow_run.id",
    "repository.html_url",
    "pull_request.head.sha", "check_suite.head_sha", "workflow_run.head_sha",
    "pull_request.head.ref", "ref",
)


def _first_of(*paths: str) -> Column:
    return F.coalesce(*(field(path) for path in paths))


def _matches(path: str, wanted) -> Column:
    if wanted is NULL:
        return field(path).isNull()
    if wanted is PRESENT:
        return field(path).isNotNull()
    return field(path).isin(wanted)


def event_kind() -> Column:
    """First kind whose event name and payload conditions all hold, else NULL."""
    kinds = F.lit(None).cast("string")
    for event, conditions, kind in reversed(EVENT_KINDS):
        parts = [_matches(path, wanted) for path, wanted in conditions.items()]
        test = reduce(lambda a, b: a & b, parts, F.col("event") == event)
        kinds = F.when(test, F.lit(kind)).otherwise(kinds)
    return kinds


def classify_events(events: DataFrame) -> DataFrame:
    """The feed columns for every classifiable row of ``events``; narrow, no shuffle."""
    known = events.filter(F.col("event").isin(CLASSIFIED_EVENTS))
    parsed = parse_payload(
        known,
        *_PATHS,
        keep=(
            "delivery_id", "received", "event",
            "enterprise_name", "organization_name", "repository_name",
        ),
    )
    onprem = F.coalesce(F.col("enterprise_name"), F.lit("")).startswith(ONPREM_ENTERPRISE_PREFIX)
    feed = parsed.select(
        F.lower(
            _first_of("sender.login", "actor.login", "pull_request.user.login", "issue.user.login")
        ).alias("username"),
        F.date_trunc("SECOND", F.col("received").cast("timestamp")).alias("timestamp_seconds"),
        F.lit(FEED_NAME).alias("event_type"),
        F.when(F.col("event").isin(SYSTEM_EVENTS), SYSTEM_ACTION)
        .otherwise(USER_ACTION)
        .alias("action_type"),
        F.when(onprem, ONPREM_SOURCE).otherwise(HOSTED_SOURCE).alias("source"),
        event_kind().alias("github_event_type"),
        "delivery_id",
        _first_of("pull_request.id", "issue.id", "comment.id", "workflow_run.id").alias("event_id"),
        field("repository.html_url").alias("repository_url"),
        _first_of("pull_request.head.sha", "check_suite.head_sha", "workflow_run.head_sha").alias(
            "ref_sha"
        ),
        F.col("enterprise_name").alias("enterprise"),
        F.col("organization_name").alias("organization"),
        F.col("repository_name").alias("repository"),
        _first_of("pull_request.head.ref", "ref").alias("ref_name"),
    )
    return feed.filter(F.col("github_event_type").isNotNull()).select(*INTEGRATION_EVENTS.columns)


def integration_events(
    events: DataFrame,
    target: DataFrame | None = None,
    since: Column | None = None,
    lookback: dt.timedelta | None = None,
) -> DataFrame:
    """Feed rows not yet in ``target`` (all of them if there is no target).

    ``since`` is the newest second of the target, looked up in it unless given. A target without rows starts at 2015, no target at the first event.

    The target keeps whole seconds, so its newest second may be only partly
    loaded: events of that one second are checked against the target by
    delivery id, everything later is new by its time alone and needs no join.
    With a ``lookback`` the same check covers that time before it as well, so
    that late events load, once; only those days of both are read.
    """
    if target is None:
        return classify_events(events)

    if since is None:
        since = watermark(target, "timestamp_seconds", by_day=True)
    next_second = since + F.expr("INTERVAL 1 SECOND")
    later = on_or_after_day(events, since).filter(F.col("received") >= next_second)

    start = since if lookback is None else since - F.lit(lookback)
    edge = on_or_after_day(events, start).filter(
        (F.col("received") > start) & (F.col("received") < next_second)
    )
    loaded = on_or_after_day(target, start).filter(
        F.col("timestamp_seconds") >= F.date_trunc("SECOND", start)
    )
    if PARTITION_COLUMN in events.columns:
        edge = edge.filter(F.col(PARTITION_COLUMN) <= F.to_date(since))
    edge = edge.join(one_row_per_key(loaded, ["delivery_id"]), "delivery_id", "left_anti")

    columns = [c for c in events.columns if c not in (PARTITION_COLUMN, BATCH_COLUMN)]
    return classify_events(later.select(*columns).unionByName(edge.select(*columns)))
