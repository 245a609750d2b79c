"""Table contracts: columns, required columns, partition time and clustering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMN = "event_date"
BATCH_COLUMN = "ingest_batch"


@dataclass(frozen=True)
class TableSpec:
    """One table: DDL of its columns plus its physical layout.

    ``partition_time`` names the timestamp whose UTC day becomes the
    ``event_date`` partition; ``cluster_by`` orders rows inside each file so
    that Parquet min/max statistics can skip row groups. Every table is also
    partitioned by the batch that wrote it (see ``TableStore``).
    """

    name: str
    ddl: str
    required: tuple[str, ...] = ()
    partition_time: str | None = None
    cluster_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def conform(self, df: DataFrame) -> DataFrame:
        """Project ``df`` by name onto the table's columns and types.

        A NULL in a required column fails the write itself, so the check
        costs no pass of its own.
        """
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"{self.name}: missing columns {missing}")
        return df.select(*(self._checked(field) for field in self.schema))

    def _checked(self, field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if field.name in self.required:
            error = F.raise_error(F.lit(f"{self.name}.{field.name} must not be NULL"))
            value = F.when(value.isNull(), error.cast(field.dataType)).otherwise(value)
        return value.alias(field.name)


_PR_COLUMNS = """
    enterprise_id STRING, enterprise_name STRING,
    organization_id STRING, organization_name STRING,
    repository_id STRING, repository_name STRING,
    pr_id STRING, url STRING, author STRING,
    insertions BIGINT, deletions BIGINT,
    created TIMESTAMP, submitted TIMESTAMP, updated TIMESTAMP, received TIMESTAMP
"""

OPTIMIZED_EVENTS = TableSpec(
    "optimized_events",
    """
    delivery_id STRING, signature STRING, received TIMESTAMP, event STRING,
    enterprise_name STRING, enterprise_id STRING,
    organization_name STRING, organization_id STRING,
    repository_name STRING, repository_id STRING, payload STRING
    """,
    partition_time="received",
    cluster_by=("event", "enterprise_name", "organization_name", "repository_name"),
)

# Typed rows of single event kinds, filled by the intake so that no job parses history.
MERGED_PULL_REQUESTS = TableSpec(
    "merged_pull_requests",
    _PR_COLUMNS,
    partition_time="received",
    cluster_by=("pr_id",),
)

PULL_REQUEST_ACTIVITY = TableSpec(
    "pull_request_activity",
    "pr_id STRING, is_review BOOLEAN, who STRING, at STRING, n BIGINT, received TIMESTAMP",
    partition_time="received",
    cluster_by=("pr_id",),
)

PUSHED_COMMITS = TableSpec(
    "pushed_commits",
    """
    author STRING, organization STRING, repository STRING, branch STRING, visibility STRING,
    commit_sha STRING, commit_timestamp TIMESTAMP, compare_url STRING, compare STRING, received TIMESTAMP
    """,
    partition_time="received",
    cluster_by=("commit_sha",),
)

EMERGENCY_ISSUES = TableSpec(
    "emergency_issues",
    """
    organization STRING, author STRING, created_at TIMESTAMP, closed_at TIMESTAMP,
    html_url STRING, received TIMESTAMP
    """,
    partition_time="received",
    cluster_by=("organization", "author"),
)

COMPLETED_RUNS = TableSpec(
    "completed_runs",
    """
    delivery_id STRING, repo_slug STRING, repo_name STRING, org_name STRING, logs_url STRING,
    github_actor STRING, workflow_url STRING, workflow_run_id STRING, workflow_run_attempt STRING,
    pull_request_numbers ARRAY<STRING>, received TIMESTAMP
    """,
    partition_time="received",
    cluster_by=("delivery_id",),
)

# Rows that the typed tables cannot take: which, and the values that do not fit.
UNREADABLE_ROWS = TableSpec(
    "unreadable_rows",
    "delivery_id STRING, table_name STRING, unreadable ARRAY<STRING>, received TIMESTAMP",
    required=("table_name",),
    partition_time="received",
)

INTEGRATION_EVENTS = TableSpec(
    "integration_events",
    """
    username STRING, timestamp_seconds TIMESTAMP, event_type STRING, action_type STRING,
    source STRING, github_event_type STRING, delivery_id STRING, event_id STRING,
    repository_url STRING, ref_sha STRING, enterprise STRING, organization STRING,
    repository STRING, ref_name STRING
    """,
    partition_time="timestamp_seconds",
    cluster_by=("event_type", "action_type"),
)

PRSTATS = TableSpec(
    "prstats",
    f"{_PR_COLUMNS}, reviewer STRING, reviews STRING, comments STRING",
    partition_time="updated",
    cluster_by=("author", "reviewer", "enterprise_name", "organization_name"),
)

PRSTATS_PULL_REQUESTS = TableSpec(
    "prstats_pull_requests",
    f"{_PR_COLUMNS}, reviews STRING, comments STRING",
    partition_time="updated",
    cluster_by=("author", "enterprise_name", "organization_name", "repository_name"),
)

PRSTATS_PULL_REQUEST_REVIEWS = TableSpec(
    "prstats_pull_request_reviews",
    f"{_PR_COLUMNS}, reviewer STRING, reviews STRING, comments STRING",
    partition_time="updated",
    cluster_by=("reviewer", "enterprise_name", "organization_name", "repository_name"),
)

COMMIT_REVIEW_STATUS = TableSpec(
    "commit_review_status",
    """
    author STRING, organization STRING, repository STRING, branch STRING, visibility STRING,
    commit_sha STRING, commit_timestamp TIMESTAMP, commit_html_url STRING,
    pull_request_id BIGINT, pull_request_number BIGINT, pull_request_html_url STRING,
    approval_status STRING, break_glass_issue_urls ARRAY<STRING>, note STRING
    """,
    required=(
        "author", "organization", "repository", "branch", "commit_sha",
        "commit_timestamp", "commit_html_url", "approval_status",
    ),
)

ARTIFACTS = TableSpec(
    "artifacts",
    """
    delivery_id STRING, processed_at TIMESTAMP, status STRING, workflow_uri STRING,
    logs_uri STRING, github_actor STRING, organization_name STRING,
    repository_name STRING, repository_slug STRING, job_name STRING
    """,
    required=(
        "delivery_id", "processed_at", "status", "workflow_uri", "logs_uri", "github_actor",
        "organization_name", "repository_name", "repository_slug", "job_name",
    ),
)

INVOCATION_COMMENT = TableSpec(
    "invocation_comment",
    """
    pull_request_id BIGINT, pull_request_html_url STRING, processed_at TIMESTAMP,
    comment_id BIGINT, status STRING, job_name STRING
    """,
    required=("pull_request_id", "pull_request_html_url", "processed_at", "status", "job_name"),
)

CHECKPOINT = TableSpec(
    "checkpoint",
    "delivery_id STRING, created TIMESTAMP, github_instance_url STRING",
    required=("delivery_id", "created"),
)

FAILURE_EVENTS = TableSpec(
    "failure_events",
    "delivery_id STRING, created TIMESTAMP",
    required=("delivery_id", "created"),
)

# Side outputs that replace calls to outside services.
WEBHOOK_REJECTS = TableSpec(
    "webhook_rejects",
    "delivery_id STRING, signature STRING, received TIMESTAMP, event STRING, "
    "status_code INT, reason STRING, payload STRING",
    partition_time="received",
)

DEAD_LETTERS = TableSpec(
    "dead_letters",
    "delivery_id STRING, signature STRING, received TIMESTAMP, event STRING, payload STRING",
    partition_time="received",
)

COMMENT_OUTBOX = TableSpec(
    "comment_outbox",
    "delivery_id STRING, organization_name STRING, repository_name STRING, "
    "pull_request_number BIGINT, position INT, body STRING",
    required=("delivery_id", "pull_request_number", "body"),
)

RELAY_OUTBOX = TableSpec(
    "relay_outbox",
    "delivery_id STRING, received TIMESTAMP, value STRING, attributes MAP<STRING, STRING>",
    required=("value",),
    partition_time="received",
)

REDELIVERY_OUTBOX = TableSpec(
    "redelivery_outbox",
    "id BIGINT, guid STRING, requested_at TIMESTAMP",
    required=("id",),
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        OPTIMIZED_EVENTS,
        MERGED_PULL_REQUESTS,
        PULL_REQUEST_ACTIVITY,
        PUSHED_COMMITS,
        EMERGENCY_ISSUES,
        COMPLETED_RUNS,
        UNREADABLE_ROWS,
        INTEGRATION_EVENTS,
        PRSTATS,
        PRSTATS_PULL_REQUESTS,
        PRSTATS_PULL_REQUEST_REVIEWS,
        COMMIT_REVIEW_STATUS,
        ARTIFACTS,
        INVOCATION_COMMENT,
        CHECKPOINT,
        FAILURE_EVENTS,
        WEBHOOK_REJECTS,
        DEAD_LETTERS,
        COMMENT_OUTBOX,
        RELAY_OUTBOX,
        REDELIVERY_OUTBOX,
    )
}
