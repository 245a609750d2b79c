"""The scheduled jobs: read tables, run one operator, store its rows.

Calls to outside services are split out of a job. A job that needs one comes in
two halves: the first says what to ask for, the second takes the answers as a
DataFrame.

A job that is given a ``run`` key (say, its scheduled time) does its work once for
that key, over all the tables it writes: see ``TableStore.run_once``. Where it
loads what is new since its last run, the position it reached is stored with the
run, so the target is not searched for it and two runs never load the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.links import url_prefix
from devmetrics.functions.time import Instant, instant
from devmetrics.operators import artifacts as art
from devmetrics.operators import ingest, publisher, pull_requests, redelivery
from devmetrics.operators.incremental import EPOCH, newer_than, read_watermark
from devmetrics.operators.integration import integration_events
from devmetrics.operators.review import counted_issues, review_status, unreviewed_commits
from devmetrics.plans.skew import one_row_per_key
from devmetrics.plans.staging import stage
from devmetrics.sources.tables import Outputs, TableStore

# Each pull request table with its row shape and whether names are folded to lower case.
PR_TABLES = {
    "prstats": (pull_requests.pull_request_review_rows, True),
    "prstats_pull_requests": (pull_requests.pull_request_rows, False),
    "prstats_pull_request_reviews": (pull_requests.pull_request_review_rows, False),
}

_UNIX_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _append(store: TableStore, job: str, run: str | None, outputs: Outputs) -> bool:
    """Stores ``outputs`` as one run without a state."""
    return store.run_once(job, run, lambda state: (outputs, lambda staged: {}))


class _Position:
    """The newest loaded instant of a target, kept in the state of its job."""

    def __init__(self, store: TableStore, table: str, column: str):
        self.store, self.table, self.column = store, table, column

    def _micros(self, time: dt.datetime | None) -> int | None:
        if time is None:
            return None
        # Timestamps come to Python in the local zone of the driver.
        return (time.astimezone(dt.timezone.utc) - _UNIX_EPOCH) // dt.timedelta(microseconds=1)

    def reached(self, state: dict) -> Column:
        """A literal, so that day partitions are pruned. The first run looks into the target."""
        micros = state["position"] if "position" in state else self._micros(
            read_watermark(self.store.read(self.table), self.column)
        )
        return F.lit(EPOCH).cast("timestamp") if micros is None else F.timestamp_micros(F.lit(micros))

    def after(self, state: dict):
        """The state once the staged rows are loaded; without rows it stays."""

        def new_state(staged: Outputs) -> dict:
            newest = self._micros(read_watermark(staged[self.table], self.column))
            known = [m for m in (state.get("position"), newest) if m is not None]
            return {"position": max(known)} if known else state

        return new_state


def set_position(store: TableStore, table: str, at: Instant) -> None:
    """Makes the next load of ``table`` start behind ``at``, whatever the table holds."""
    micros = store.spark.range(1).select(F.unix_micros(instant(at))).first()[0]
    store.run_once(table, None, lambda state: ({}, lambda staged: {"position": micros}))


def record_failed_writes(
    store: TableStore, failed: DataFrame, limit: int, now: Instant, run: str | None = None
) -> None:
    """Record events whose write failed; those that failed ``limit`` times before are set aside."""

    def build(state: dict):
        routes = stage(ingest.route_failed_writes(failed, store.read("failure_events"), limit))
        outputs = {
            "dead_letters": routes.filter(F.col("route") == ingest.DLQ),
            "failure_events": ingest.failure_records(routes, now),
        }
        return outputs, lambda staged: {}

    store.run_once("failed_writes", run, build)


def load_integration_events(
    store: TableStore, run: str | None = None, lookback: dt.timedelta | None = None
) -> bool:
    """Store the events since the last run, with a ``lookback`` also late ones of that time."""
    position = _Position(store, "integration_events", "timestamp_seconds")

    def build(state: dict):
        target = store.read("integration_events")
        rows = integration_events(
            store.read("optimized_events"), target, position.reached(state), lookback
        )
        return {"integration_events": rows}, position.after(state)

    return store.run_once("integration_events", run, build)


def load_pull_request_stats(
    store: TableStore, table: str, run: str | None = None, lookback: dt.timedelta | None = None
) -> bool:
    """Store the pull requests that closed since the last run.

    Close events that arrive late, at or before the position the last run
    reached, never load, unless they are within the ``lookback`` before it: those
    are checked against the target by pull request and time.

    Both inputs are typed tables. Reviews and comments may be of any age, so all
    stored activity is read; rows of other pull requests are dropped by a semi
    join, which Spark broadcasts or shuffles by the measured size of the staged ids.
    """
    rows_of, lowercase = PR_TABLES[table]
    position = _Position(store, table, "received")

    def build(state: dict):
        merged = store.read("merged_pull_requests")
        reached = position.reached(state)
        prs = newer_than(merged, "received", reached, prune=True)
        if lookback is not None:
            start, keys = reached - F.lit(lookback), ["pr_id", "received"]
            late = newer_than(merged, "received", start, prune=True).filter(F.col("received") <= reached)
            loaded = store.read(table).filter(F.col("received") > start)
            late = late.join(one_row_per_key(loaded, keys), keys, "left_anti")
            prs = prs.unionByName(late)
        prs = prs.select(*(c for c in merged.columns if c not in ("event_date", "ingest_batch")))
        if lowercase:
            prs = prs.withColumn("author", F.lower("author"))
        ids = stage(prs.select("pr_id").distinct())
        activity = pull_requests.merged_activity(store.read("pull_request_activity"), lowercase, ids)
        return {table: rows_of(prs, activity)}, position.after(state)

    return store.run_once(table, run, build)


def review_commits(
    store: TableStore,
    commit_pull_requests: DataFrame,
    reviews: DataFrame,
    lookup_errors: DataFrame | None = None,
    server_url: str | None = None,
    run: str | None = None,
    **commit_options,
) -> bool:
    """Audit new commits. Lookups and statuses are staged, so that their shuffles do not add up on disk."""
    prefix = url_prefix(server_url)

    def build(state: dict):
        commits = unreviewed_commits(
            store.read("pushed_commits"), store.read("commit_review_status"), prefix, **commit_options
        )
        issues = counted_issues(store.read("emergency_issues"), prefix)
        rows = review_status(commits, issues, commit_pull_requests, reviews, lookup_errors, stage)
        return {"commit_review_status": rows}, lambda staged: {}

    return store.run_once("commit_review_status", run, build)


def plan_log_fetch(store: TableStore, batch_size: int | None = None) -> DataFrame:
    """The runs whose logs to fetch now. Staged: the answers must meet the same rows."""
    return stage(art.waiting_runs(store.read("completed_runs"), store.read("artifacts"), batch_size))


def request_log_comments(
    store: TableStore,
    queue: DataFrame,
    outcomes: DataFrame,
    bucket: str,
    project: str,
    run: str | None = None,
) -> bool:
    """Puts the comments on fetched logs into the outbox; their posts come back in ``record_log_fetch``."""
    comments = art.artifact_pr_comments(queue, outcomes, bucket, project)
    return _append(store, "log_comments", run, {"comment_outbox": comments})


def record_log_fetch(
    store: TableStore,
    queue: DataFrame,
    outcomes: DataFrame,
    bucket: str,
    project: str,
    processed_at: Instant,
    posts: DataFrame | None = None,
    run: str | None = None,
) -> bool:
    """The status rows take the runs off the queue.

    With the outcomes of ``posts`` a run with a failed comment is a failure.
    Without them the comments go out together with the status rows, and a run
    counts as fetched before they are posted.
    """
    statuses = art.artifact_status(queue, outcomes, bucket, processed_at, posts)
    outputs = {"artifacts": statuses}
    if posts is None:
        outputs["comment_outbox"] = art.artifact_pr_comments(queue, outcomes, bucket, project)
    return _append(store, "artifacts", run, outputs)


def plan_publishing(store: TableStore, pull_request_events: DataFrame, as_of: Instant) -> DataFrame:
    return publisher.publisher_source(
        pull_request_events,
        store.read("artifacts"),
        store.read("optimized_events"),
        store.read("invocation_comment"),
        as_of,
    )


def record_publishing(store: TableStore, statuses: DataFrame, run: str | None = None) -> bool:
    return _append(
        store, "publishing", run, {"invocation_comment": publisher.invocation_comment_rows(statuses)}
    )


class RedeliveryFailed(RuntimeError):
    """A delivery failed again and never arrived; the checkpoint stays where it was."""


def current_checkpoint(store: TableStore, domain: str = redelivery.DEFAULT_DOMAIN) -> str | None:
    row = redelivery.read_checkpoint(store.read("checkpoint"), domain).first()
    return row["delivery_id"] if row else None


def plan_redelivery(
    store: TableStore,
    deliveries: DataFrame,
    now: Instant,
    domain: str = redelivery.DEFAULT_DOMAIN,
    run: str | None = None,
) -> DataFrame:
    """Failed deliveries since the checkpoint, also put in the outbox, newest first."""
    failed = stage(redelivery.failed_deliveries(deliveries, current_checkpoint(store, domain)))
    requests = failed.withColumn("requested_at", instant(now))
    _append(store, "redelivery_requests", run, {"redelivery_outbox": requests})
    return failed


def record_redelivery(
    store: TableStore,
    deliveries: DataFrame,
    failed: DataFrame,
    outcomes: DataFrame,
    now: Instant,
    domain: str = redelivery.DEFAULT_DOMAIN,
    run: str | None = None,
) -> dict[str, int]:
    """Reconcile the outcomes, move the checkpoint and return the run's counters."""
    reconciled = redelivery.reconcile_redeliveries(
        failed, outcomes, store.read("optimized_events")
    )
    summary = redelivery.redelivery_summary(
        deliveries, reconciled, current_checkpoint(store, domain)
    )
    counters = summary.first().asDict()
    if counters["fatal_event_count"]:
        raise RedeliveryFailed(str(counters))
    _append(
        store, "checkpoint", run, {"checkpoint": redelivery.write_checkpoint(deliveries, now, domain)}
    )
    return counters
