"""Every operator as a query over a folder of driver tables, with its SQL oracle.

Queries run on whole tables. The oracles read the base tables only and never
touch JSON, so a parsing error cannot cancel out.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devmetrics.functions.payload import field, json_scalar, parse_payload
from devmetrics.operators import artifacts as art
from devmetrics.operators import ingest, publisher, pull_requests, redelivery, review
from devmetrics.operators.incremental import incremental_rows
from devmetrics.operators.integration import classify_events, integration_events
from devmetrics.plans import jobs
from devmetrics.plans.staging import shared_folder, stage
from devmetrics.plans.typed import write_typed
from devmetrics.session import configure
from devmetrics.sources.derived import WEBHOOK_SECRET, DerivedEvents
from devmetrics.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
BUILDERS: dict[str, Callable[[DerivedEvents], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-02-05 00:00:00 UTC"
FEED_LOADED_UNTIL = "2024-01-20 00:00:00 UTC"
PRS_LOADED_UNTIL = "1999-01-01 00:00:00 UTC"
CHECKPOINT = 5000
RETRY_LIMIT = 2
BUCKET, PROJECT = "logs", "metrics"


def present(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time and arrays as joined text, the way the oracles print them."""
    columns = []
    for f in df.schema:
        value = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def query(name: str, oracle: str):
    def register(build: Callable[[DerivedEvents], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(DerivedEvents(configure(spark), sf_dir)))

        QUERIES[name] = run
        BUILDERS[name] = build
        ORACLES[name] = oracle
        return build

    return register


# -- shared oracle parts ------------------------------------------------------

ORDERS = """
o AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus AS st, o_orderpriority AS pri,
         o_orderdate AS d, CAST(floor(o_totalprice) AS BIGINT) AS tp,
         lower(n_name) AS repo, lower(replace(r_name, ' ', '-')) AS org,
         r_regionkey AS rk, n_nationkey AS nk
  FROM orders
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""


def _prs(author: str) -> str:
    return f"""
prs AS (
  SELECT CAST(rk AS VARCHAR) AS enterprise_id,
         CASE WHEN rk < 2 THEN 'Google-' ELSE 'ent-' END || org AS enterprise_name,
         CAST(rk + 1 AS VARCHAR) AS organization_id, org AS organization_name,
         CAST(nk + 100 AS VARCHAR) AS repository_id, repo AS repository_name,
         CAST(1000000 + k AS VARCHAR) AS pr_id,
         'https://github.com/' || org || '/' || repo || '/pull/' || k AS url,
         {author}('User' || (ck % 97)) AS author,
         tp % 1000 AS insertions, tp % 300 AS deletions,
         d - INTERVAL 3 DAY AS created, d AS submitted, d AS updated,
         d + to_seconds(k % 86400) AS received
  FROM o WHERE st = 'F'
)"""


def _people(reviewer: str, seen: str = "") -> str:
    return f"""
rv AS (
  SELECT CAST(1000000 + l_orderkey AS VARCHAR) AS pr_id,
         {reviewer}('User' || (l_suppkey % 97)) AS reviewer,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS updated_at
  FROM lineitem WHERE l_linenumber BETWEEN 1 AND 3 {seen}
),
cm AS (
  SELECT CAST(1000000 + l_orderkey AS VARCHAR) AS pr_id,
         'User' || (l_suppkey % 97) AS commenter,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS updated_at
  FROM lineitem WHERE l_linenumber BETWEEN 4 AND 6 {seen}
),
pairs AS (SELECT DISTINCT pr_id, author FROM prs),
reviews_agg AS (
  SELECT pr_id, author,
         array_to_string(list_sort(list(DISTINCT reviewer)), ',') AS reviews
  FROM pairs JOIN rv USING (pr_id) WHERE reviewer <> author GROUP BY pr_id, author
),
comments_agg AS (
  SELECT pr_id, author,
         array_to_string(list_sort(list(commenter || '|' || updated_at)), ',') AS comments
  FROM pairs JOIN cm USING (pr_id) WHERE commenter <> author GROUP BY pr_id, author
)"""


FOLD, KEEP = "lower", ""
WITH_PRS = f"WITH {ORDERS}, {_prs(FOLD)}, {_people(FOLD)}"
WITH_PRS_KEPT = f"WITH {ORDERS}, {_prs(KEEP)}, {_people(KEEP)}"
WITH_CELLS = "FROM prs LEFT JOIN reviews_agg USING (pr_id, author) LEFT JOIN comments_agg USING (pr_id, author)"
REVIEW_ROWS = f"""
SELECT prs.*, rv.reviewer, reviews, comments
{WITH_CELLS} LEFT JOIN rv ON rv.pr_id = prs.pr_id"""

# -- pull request statistics ---------------------------------------------------


@query("merged_pull_requests", f"WITH {ORDERS}, {_prs(FOLD)} SELECT * FROM prs")
def _(d):
    return pull_requests.merged_pull_requests(d.events)


@query("pr_reviews", f"{WITH_PRS} SELECT pr_id, reviewer, updated_at FROM rv")
def _(d):
    return pull_requests.pr_reviews(d.events)


@query("pr_comments", f"{WITH_PRS} SELECT pr_id, commenter, updated_at FROM cm")
def _(d):
    return pull_requests.pr_comments(d.events)


@query(
    "reviewers_agg",
    f"{WITH_PRS} SELECT pr_id, author, reviews FROM pairs LEFT JOIN reviews_agg USING (pr_id, author)",
)
def _(d):
    return pull_requests.reviewers_agg(
        pull_requests.merged_pull_requests(d.events),
        pull_requests.review_activity(d.events),
    )


@query(
    "comments_agg",
    f"{WITH_PRS} SELECT pr_id, author, comments FROM pairs LEFT JOIN comments_agg USING (pr_id, author)",
)
def _(d):
    return pull_requests.comments_agg(
        pull_requests.merged_pull_requests(d.events),
        pull_requests.review_activity(d.events),
    )


@query("prstats_pull_requests", f"{WITH_PRS_KEPT} SELECT prs.*, reviews, comments {WITH_CELLS}")
def _(d):
    return pull_requests.prstats_pull_requests(d.events)


@query("prstats", f"{WITH_PRS} {REVIEW_ROWS}")
def _(d):
    return pull_requests.prstats(d.events)


@query("prstats_pull_request_reviews", f"{WITH_PRS_KEPT} {REVIEW_ROWS}")
def _(d):
    return pull_requests.prstats_pull_request_reviews(d.events)


# The event times of these tables lie before the start of an empty target, so
# the newest row of an earlier load sets the watermark.
@query(
    "prstats_incremental",
    f"""{WITH_PRS} {REVIEW_ROWS}
WHERE prs.received > coalesce(
  (SELECT max(d + to_seconds(k % 86400)) FROM o WHERE d + to_seconds(k % 86400) < TIMESTAMP '1999-01-01'),
  TIMESTAMP '2015-01-01')""",
)
def _(d):
    loaded = d.events.filter("event = 'pull_request'").filter(F.col("received") < PRS_LOADED_UNTIL)
    return pull_requests.prstats(d.events, loaded.select("received"))


@query(
    "incremental_append",
    f"""WITH {ORDERS}, {_prs(FOLD)} SELECT * FROM prs
WHERE received > coalesce(
  (SELECT max(received) FROM prs WHERE received < TIMESTAMP '1999-01-01'), TIMESTAMP '2015-01-01')""",
)
def _(d):
    rows = pull_requests.merged_pull_requests(d.events)
    loaded = rows.filter(F.col("received") < PRS_LOADED_UNTIL)
    return incremental_rows(rows, loaded, "received")


# -- through the table store ---------------------------------------------------------

# Events before this instant come with the first batch of the intake, all others with the second.
SECOND_BATCH = "1994-01-01"
PR_TYPES = ("merged_pull_requests", "pull_request_activity")

# What the load that sees a pull request close can know of its reviews.
SEEN = f"""
    AND (l_shipdate < TIMESTAMP '{SECOND_BATCH}' OR l_orderkey NOT IN (
      SELECT k FROM o WHERE st = 'F' AND d + to_seconds(k % 86400) < TIMESTAMP '{SECOND_BATCH}'))"""


def _new_store(d: DerivedEvents) -> TableStore:
    return TableStore(d.spark, f"{shared_folder(d.spark)}/devmetrics-tables/{uuid.uuid4().hex}")


def _batches(events: DataFrame, second: str) -> list[tuple[str, DataFrame]]:
    """Two batches of the intake: what was received before ``second``, and the rest."""
    early = F.col("received") < F.lit(f"{second} 00:00:00 UTC").cast("timestamp")
    return [("first", events.filter(early)), ("second", events.filter(~early))]


def _by_year(events: DataFrame) -> DataFrame:
    """Received at the start of their year: the driver's line items span thousands of days."""
    return events.withColumn("received", F.date_trunc("YEAR", "received"))


def _loaded_twice(d: DerivedEvents, table: str) -> DataFrame:
    """A statistics table after two batches of the intake with a load behind each that is run twice."""
    store = _new_store(d)
    jobs.set_position(store, table, "1970-01-01 00:00:00 UTC")
    closed = _batches(d.pull_requests, SECOND_BATCH)
    activity = _batches(d.reviews.unionByName(d.comments), SECOND_BATCH)
    for (batch, prs), (_, rows) in zip(closed, activity):
        write_typed(store, prs.unionByName(_by_year(rows)), batch, PR_TYPES)
        for _ in range(2):
            jobs.load_pull_request_stats(store, table, run=batch)
    return store.read(table).drop("event_date", "ingest_batch")


@query(
    "stored_prstats_pull_requests",
    f"WITH {ORDERS}, {_prs(KEEP)}, {_people(KEEP, SEEN)} SELECT prs.*, reviews, comments {WITH_CELLS}",
)
def _(d):
    return _loaded_twice(d, "prstats_pull_requests")


# -- activity feed --------------------------------------------------------------

FEED = f"""
{ORDERS},
raw AS (
  SELECT d + to_seconds(k % 86400) AS received, 'pull_request' AS event, 'User' || (ck % 97) AS who,
         CASE st WHEN 'F' THEN 'PR_CLOSED' WHEN 'P' THEN 'PR_ABANDONED' ELSE 'PR_OPENED' END AS kind,
         'pr-' || k AS delivery_id, CAST(1000000 + k AS VARCHAR) AS event_id,
         'https://github.com/' || org || '/' || repo AS repository_url, md5('h' || k) AS ref_sha,
         CASE WHEN rk < 2 THEN 'Google-' ELSE 'ent-' END || org AS enterprise,
         org AS organization, org || '/' || repo AS repository, 'feature-' || (k % 50) AS ref_name
  FROM o
  UNION ALL
  SELECT l_shipdate,
         CASE WHEN l_linenumber <= 3 THEN 'pull_request_review' ELSE 'pull_request_review_comment' END,
         'User' || (l_suppkey % 97),
         CASE WHEN l_linenumber <= 3 THEN 'PR_SIGNOFF' ELSE 'PR_COMMENT' END,
         CASE WHEN l_linenumber <= 3 THEN 'rv-' ELSE 'cm-' END
           || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey,
         CAST(1000000 + l_orderkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL
  FROM lineitem WHERE l_linenumber BETWEEN 1 AND 6
  UNION ALL
  SELECT l_shipdate + to_seconds(k % 86400), 'push', 'User' || (ck % 97), 'PUSH',
         'ps-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey,
         NULL, 'https://github.com/' || org || '/' || repo, NULL, NULL,
         org, org || '/' || repo,
         CASE WHEN k % 5 = 0 THEN 'refs/heads/dev' ELSE 'refs/heads/main' END
  FROM lineitem JOIN o ON l_orderkey = k WHERE l_linenumber >= 6
  UNION ALL
  SELECT ts, 'workflow_run', 'User' || (user_id % 97),
         CASE WHEN event_id % 4 <> 0 THEN 'RUN_COMPLETED' ELSE 'RUN_CREATED' END,
         'wr-' || event_id, CAST(event_id AS VARCHAR),
         'https://github.com/org-' || (user_id % 7) || '/repo-' || (event_id % 11),
         md5('h' || event_id), NULL, NULL,
         'org-' || (user_id % 7) || '/repo-' || (event_id % 11), NULL
  FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT ts,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'click' THEN 'workflow_job'
              WHEN 'view' THEN 'deployment_status'
              ELSE CASE WHEN event_id % 2 = 0 THEN 'repository' ELSE 'deployment' END END,
         'User' || (user_id % 97),
         CASE event_type
           WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'BRANCH' WHEN 1 THEN 'TAG' END
           WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN 'JOB_CREATED' WHEN 2 THEN 'JOB_COMPLETED' END
           WHEN 'view' THEN CASE event_id % 3 WHEN 0 THEN 'DEPLOYMENT_ENDED' WHEN 1 THEN 'DEPLOYMENT_FAILED' END
           WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'REPO'
                                  WHEN event_id % 6 <> 1 THEN 'DEPLOYMENT_STARTED' END
         END,
         'mi-' || event_id, NULL, NULL, NULL, NULL, NULL,
         CASE event_type WHEN 'view' THEN 'x/' || (event_id % 5) END,
         CASE event_type WHEN 'signup' THEN 'topic-' || (event_id % 10) END
  FROM events WHERE event_type <> 'purchase'
),
feed AS (
  SELECT lower(who) AS username, date_trunc('second', received) AS timestamp_seconds,
         'GITHUB' AS event_type,
         CASE WHEN event IN ('deployment', 'deployment_status', 'workflow_job', 'workflow_run')
              THEN 'SYSTEM_ACTION' ELSE 'USER_INTERACTION' END AS action_type,
         CASE WHEN enterprise LIKE 'Google-%' THEN 'GITHUB_SOURCE_GITHUB_ONPREM'
              ELSE 'GITHUB_SOURCE_GITHUB_COM' END AS source,
         kind AS github_event_type, delivery_id, event_id, repository_url, ref_sha,
         enterprise, organization, repository, ref_name, received
  FROM raw WHERE kind IS NOT NULL
)"""


@query("integration_events", f"WITH {FEED} SELECT * EXCLUDE (received) FROM feed")
def _(d):
    return integration_events(d.events)


@query(
    "integration_events_incremental",
    f"""WITH {FEED},
loaded AS (SELECT * FROM feed WHERE received < TIMESTAMP '2024-01-20'),
mark AS (SELECT coalesce(max(timestamp_seconds), TIMESTAMP '2015-01-01') AS m FROM loaded)
SELECT * EXCLUDE (received) FROM feed
WHERE received > (SELECT m FROM mark)
  AND NOT EXISTS (SELECT 1 FROM loaded WHERE loaded.delivery_id = feed.delivery_id
                  AND loaded.timestamp_seconds = (SELECT m FROM mark))""",
)
def _(d):
    # Staged, as the target is a table: it is read for its newest second and its ids.
    loaded = stage(classify_events(d.events.filter(F.col("received") < FEED_LOADED_UNTIL)))
    return integration_events(d.events, loaded)


# The event table after two batches, one of them written again, whose days were then merged.
@query(
    "stored_feed_after_compaction",
    f"""WITH {FEED} SELECT * EXCLUDE (received) FROM feed
WHERE delivery_id LIKE 'wr-%' OR delivery_id LIKE 'mi-%'""",
)
def _(d):
    store = _new_store(d)
    events = d.workflow_runs.unionByName(d.misc)
    odd = F.pmod(F.xxhash64("delivery_id"), F.lit(2)) == 1
    for batch, rows in [("one", events.filter(odd)), ("two", events.filter(~odd)), ("one", events.filter(odd))]:
        store.write_batch("optimized_events", rows, batch)
    store.compact("optimized_events")
    store.vacuum("optimized_events", keep=dt.timedelta(0))
    return classify_events(store.read("optimized_events"))


# -- intake -----------------------------------------------------------------------

IDENTITY = f"""
{ORDERS},
identity AS (
  SELECT 'pr-' || k AS delivery_id, 'pull_request' AS event, CAST(rk AS VARCHAR) AS enterprise_id,
         CASE WHEN rk < 2 THEN 'Google-' ELSE 'ent-' END || org AS enterprise_name,
         CAST(rk + 1 AS VARCHAR) AS organization_id, org AS organization_name,
         CAST(nk + 100 AS VARCHAR) AS repository_id, org || '/' || repo AS repository_name
  FROM o
  UNION ALL
  SELECT 'wr-' || event_id, 'workflow_run', NULL, NULL, NULL, NULL,
         CAST(event_id % 11 + 1 AS VARCHAR), 'org-' || (user_id % 7) || '/repo-' || (event_id % 11)
  FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'mi-' || event_id,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'click' THEN 'workflow_job'
              WHEN 'view' THEN 'deployment_status'
              ELSE CASE WHEN event_id % 2 = 0 THEN 'repository' ELSE 'deployment' END END,
         NULL, NULL,
         CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END,
         CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'org-' || (user_id % 7) END,
         NULL, CASE event_type WHEN 'view' THEN 'x/' || (event_id % 5) END
  FROM events WHERE event_type <> 'purchase' AND NOT (event_type = 'error' AND event_id % 6 = 1)
)"""


def _identity_events(d: DerivedEvents) -> DataFrame:
    events = d.pull_requests.unionByName(d.workflow_runs).unionByName(d.misc)
    return events.select(*ingest.EVENT_COLUMNS)


@query("enrich_events", f"WITH {IDENTITY} SELECT * FROM identity")
def _(d):
    enriched = ingest.enrich_events(_identity_events(d))
    return enriched.select("delivery_id", "event", *ingest.IDENTITY_COLUMNS)


@query(
    "undecodable_events",
    """SELECT 'mi-' || event_id AS delivery_id, ts AS received
FROM events WHERE event_type = 'error' AND event_id % 6 = 1""",
)
def _(d):
    return ingest.undecodable_events(_identity_events(d)).select("delivery_id", "received")


@query(
    "message_attributes",
    f"""WITH {IDENTITY}
SELECT delivery_id,
       array_to_string(list_sort([
         'enterprise_id=' || coalesce(enterprise_id, ''), 'enterprise_name=' || coalesce(enterprise_name, ''),
         'event=' || event,
         'organization_id=' || coalesce(organization_id, ''),
         'organization_name=' || coalesce(organization_name, ''),
         'repository_id=' || coalesce(repository_id, ''),
         'repository_name=' || coalesce(repository_name, '')]), ',') AS attributes
FROM identity""",
)
def _(d):
    attributes = ingest.message_attributes(ingest.enrich_events(_identity_events(d)))
    pairs = F.transform(
        F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return attributes.select("delivery_id", F.array_sort(pairs).alias("attributes"))


@query(
    "unwrap_messages",
    """SELECT CASE WHEN ok THEN 'mi-' || event_id END AS delivery_id,
       CASE WHEN ok THEN CASE event_type WHEN 'signup' THEN 'create' WHEN 'click' THEN 'workflow_job'
              WHEN 'view' THEN 'deployment_status'
              ELSE CASE WHEN event_id % 2 = 0 THEN 'repository' ELSE 'deployment' END END END AS event,
       CASE WHEN ok THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS received,
       ok AS decoded
FROM (SELECT *, event_id % 17 <> 0 AND event_id % 19 <> 0 AS ok FROM events WHERE event_type <> 'purchase')""",
)
def _(d):
    return ingest.unwrap_messages(d.messages).select("delivery_id", "event", "received", "decoded")


@query(
    "json_scalar",
    """SELECT 'mi-' || event_id AS delivery_id,
       CASE WHEN event_type = 'signup' THEN 'topic-' || (event_id % 10) END AS ref,
       CASE WHEN NOT (event_type = 'error' AND event_id % 6 = 1) THEN 'User' || (user_id % 97) END AS sender,
       CASE WHEN event_type IN ('signup', 'click') THEN CAST(user_id AS VARCHAR) END AS account_id,
       CAST(NULL AS VARCHAR) AS organization
FROM events WHERE event_type <> 'purchase'""",
)
def _(d):
    return d.misc.select(
        "delivery_id",
        json_scalar("payload", "$.ref").alias("ref"),
        json_scalar("payload", "$.sender.login").alias("sender"),
        json_scalar("payload", "$.installation.account.id").alias("account_id"),
        json_scalar("payload", "$.organization").alias("organization"),
    )


@query(
    "validate_webhooks",
    """SELECT md5(CAST(event_id AS VARCHAR)) AS delivery_id, event_type AS event, ts AS received,
       CAST(CASE WHEN event_id % 50 = 1 THEN 400 WHEN event_id % 10 = 0 THEN 401 ELSE 201 END AS INTEGER) AS status_code,
       CASE WHEN event_id % 50 = 1 THEN 'no payload received'
            WHEN event_id % 10 = 0 THEN 'failed to validate webhook signature' END AS reason,
       CASE WHEN event_id % 50 = 1 THEN '' ELSE props END AS payload
FROM events""",
)
def _(d):
    return ingest.validate_webhooks(d.raw_webhooks, WEBHOOK_SECRET).select(
        "delivery_id", "event", "received", "status_code", "reason", "payload"
    )


@query(
    "accepted_events",
    """SELECT md5(CAST(event_id AS VARCHAR)) AS delivery_id, event_type AS event, ts AS received, props AS payload
FROM events WHERE event_id % 50 <> 1 AND event_id % 10 <> 0""",
)
def _(d):
    verdicts = ingest.validate_webhooks(d.raw_webhooks, WEBHOOK_SECRET)
    return ingest.accepted_events(verdicts).drop("signature")


@query(
    "failure_counts",
    f"""SELECT md5(CAST(event_id AS VARCHAR)) AS delivery_id, event_id % 4 AS failures,
       event_id % 4 >= {RETRY_LIMIT} AS exceeds_limit
FROM events WHERE event_id % 4 > 0""",
)
def _(d):
    return ingest.failure_counts(d.failure_events, RETRY_LIMIT)


@query(
    "route_failed_writes",
    f"""SELECT md5(CAST(event_id AS VARCHAR)) AS delivery_id, event_id % 4 AS failures,
       CASE WHEN event_id % 4 >= {RETRY_LIMIT} THEN 'DLQ' ELSE 'RECORD' END AS route,
       CAST(CASE WHEN event_id % 4 >= {RETRY_LIMIT} AND event_id % 5 <> 0 THEN 201 ELSE 500 END AS INTEGER) AS response_code
FROM events""",
)
def _(d):
    return ingest.route_failed_writes(d.failed_writes, d.failure_events, RETRY_LIMIT)


@query(
    "failure_records",
    f"""SELECT md5(CAST(event_id AS VARCHAR)) AS delivery_id, TIMESTAMP '2024-02-05' AS created
FROM events WHERE event_id % 4 < {RETRY_LIMIT}""",
)
def _(d):
    routes = ingest.route_failed_writes(d.failed_writes, d.failure_events, RETRY_LIMIT)
    return ingest.failure_records(routes, AS_OF)


# -- commit review ------------------------------------------------------------------

COMMITS = f"""
{ORDERS},
pushed AS (
  SELECT k, 'User' || (ck % 97) AS author, org AS organization, repo AS repository, 'main' AS branch,
         CASE WHEN k % 2 = 0 THEN 'private' ELSE 'public' END AS visibility,
         md5('c' || l_orderkey || '-' || l_linenumber || '-' || i) AS commit_sha,
         l_shipdate + to_hours(CAST(i AS INTEGER)) AS commit_timestamp
  FROM (SELECT lineitem.*, unnest(range(1, l_partkey % 4 + 1)) AS i FROM lineitem WHERE l_linenumber >= 6)
  JOIN o ON l_orderkey = k
),
commits AS (
  SELECT * FROM pushed p
  WHERE k % 5 <> 0 AND k % 11 <> 0
    AND NOT EXISTS (SELECT 1 FROM pushed r WHERE r.k % 4 = 0 AND r.commit_sha = p.commit_sha)
)"""

STATUSES = f"""
{COMMITS},
candidates AS (
  SELECT DISTINCT organization, repository, commit_sha, n AS ordinal, 1000000 + k + n AS pr_id
  FROM pushed, (VALUES (0), (1)) v(n)
  WHERE k % 6 <> 0 AND (n = 0 OR k % 7 = 0) AND NOT (k % 13 = 0 AND n = 0)
),
decisions AS (
  SELECT 1000000 + l_orderkey AS pr_id, bool_or(l_returnflag = 'A') AS approved,
         bool_or(l_returnflag = 'R') AS blocked
  FROM lineitem WHERE l_linenumber BETWEEN 1 AND 3 GROUP BY 1
),
chosen AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY organization, repository, commit_sha
                                 ORDER BY coalesce(approved, FALSE) DESC, ordinal) AS rank
    FROM candidates LEFT JOIN decisions USING (pr_id))
  WHERE rank = 1
),
statuses AS (
  SELECT c.author, c.organization, c.repository, c.branch, c.visibility, c.commit_sha, c.commit_timestamp,
         'https://github.com/' || c.organization || '/' || c.repository || '/commit/' || c.commit_sha AS commit_html_url,
         CASE WHEN c.k % 101 = 0 THEN 0 ELSE coalesce(pr_id, 0) END AS pull_request_id,
         CASE WHEN c.k % 101 = 0 THEN 0 ELSE coalesce(pr_id % 100000, 0) END AS pull_request_number,
         CASE WHEN c.k % 101 = 0 OR pr_id IS NULL THEN '' ELSE 'https://github.com/pull/' || pr_id END AS pull_request_html_url,
         CASE WHEN c.k % 101 = 0 OR pr_id IS NULL THEN 'UNKNOWN' WHEN approved THEN 'APPROVED'
              WHEN blocked THEN 'CHANGES_REQUESTED' ELSE 'REVIEW_REQUIRED' END AS approval_status,
         CASE WHEN c.k % 101 = 0
              THEN 'Could not resolve to a Repository with the name ''' || c.repository || '''.' ELSE '' END AS note
  FROM commits c LEFT JOIN chosen USING (organization, repository, commit_sha)
  WHERE c.k % 101 = 0 OR c.k % 103 <> 0
)"""

TAGGED = """
issues AS (
  SELECT org AS organization, 'User' || (ck % 97) AS author, d AS created_at, d + INTERVAL 90 DAY AS closed_at,
         'https://github.com/' || org || '/breakglass/issues/' || k AS url
  FROM o WHERE pri = '1-URGENT' AND k % 3 <> 0
),
found AS (
  SELECT organization, author, commit_timestamp, string_agg(url, ',' ORDER BY url) AS urls
  FROM (SELECT DISTINCT organization, author, commit_timestamp FROM statuses WHERE approval_status <> 'APPROVED')
  JOIN issues USING (organization, author)
  WHERE commit_timestamp BETWEEN created_at AND closed_at
  GROUP BY ALL
)
SELECT statuses.*,
       CASE WHEN approval_status = 'APPROVED' THEN '' ELSE coalesce(urls, '') END AS break_glass_issue_urls
FROM statuses LEFT JOIN found USING (organization, author, commit_timestamp)"""

COMMIT_COLUMNS = "author, organization, repository, branch, visibility, commit_sha, commit_timestamp"


def _commits(d: DerivedEvents, **options) -> DataFrame:
    return review.commits_to_review(d.events, d.reviewed_commits, **options)


def _statuses(d: DerivedEvents, **options) -> DataFrame:
    reviews = review.pull_request_reviews_from_events(d.events)
    return review.commit_approval(_commits(d), d.commit_pull_requests, reviews, d.lookup_errors, **options)


@query("commits_to_review", f"WITH {COMMITS} SELECT {COMMIT_COLUMNS} FROM commits")
def _(d):
    return _commits(d)


@query("commits_to_review_distinct", f"WITH {COMMITS} SELECT DISTINCT {COMMIT_COLUMNS} FROM commits")
def _(d):
    return _commits(d, dedupe=True)


@query(
    "pull_request_reviews_from_events",
    """SELECT 1000000 + l_orderkey AS pr_id,
       CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'CHANGES_REQUESTED' ELSE 'COMMENTED' END AS state
FROM lineitem WHERE l_linenumber BETWEEN 1 AND 3""",
)
def _(d):
    return review.pull_request_reviews_from_events(d.events)


@query("commit_approval", f"WITH {STATUSES} SELECT * FROM statuses")
def _(d):
    return _statuses(d)


@query("breakglass_issues", f"WITH {STATUSES}, {TAGGED}")
def _(d):
    return review.breakglass_issues(stage(_statuses(d, stage=stage)), d.events)


@query("commit_review_status", f"WITH {STATUSES}, {TAGGED}")
def _(d):
    return review.commit_review_status(
        d.events,
        d.reviewed_commits,
        d.commit_pull_requests,
        review.pull_request_reviews_from_events(d.events),
        d.lookup_errors,
        stage=stage,
    )


@query(
    "json_scalars_in_arrays",
    """SELECT 'mx-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS delivery_id,
       CAST(i - 1 AS INTEGER) AS position,
       CASE (l_partkey + l_suppkey + i) % 6 WHEN 2 THEN '' || i WHEN 4 THEN '{not an object ' || i
            WHEN 5 THEN md5('c' || l_orderkey || '-' || l_linenumber || '-' || i) END AS commit_sha
FROM (SELECT lineitem.*, unnest(range(1, l_partkey % 4 + 1)) AS i FROM lineitem WHERE l_linenumber >= 6)""",
)
def _(d):
    parsed = parse_payload(d.mixed_pushes, "commits:array<struct<id:string>>", keep=("delivery_id",))
    commits = parsed.select("delivery_id", F.posexplode(field("commits")).alias("position", "commit"))
    return commits.select("delivery_id", "position", F.col("commit.id").alias("commit_sha"))


@query("stored_commit_review_status", f"WITH {STATUSES}, {TAGGED}")
def _(d):
    store = _new_store(d)
    for batch, events in _batches(d.pushes.unionByName(d.issues), SECOND_BATCH):
        write_typed(store, _by_year(events), batch, ("pushed_commits", "emergency_issues"))
    return review.review_status(
        review.unreviewed_commits(store.read("pushed_commits"), d.reviewed_commits),
        review.counted_issues(store.read("emergency_issues")),
        d.commit_pull_requests,
        review.pull_request_reviews_from_events(d.events),
        d.lookup_errors,
        stage,
    )


# -- workflow logs ---------------------------------------------------------------------

QUEUE = """
queue AS (
  SELECT 'wr-' || event_id AS delivery_id,
         'org-' || (user_id % 7) || '/repo-' || (event_id % 11) AS repo_slug,
         'repo-' || (event_id % 11) AS repo_name, 'org-' || (user_id % 7) AS org_name,
         'https://api.github.com/repos/org-' || (user_id % 7) || '/repo-' || (event_id % 11)
           || '/actions/runs/' || event_id || '/logs' AS logs_url,
         'User' || (user_id % 97) AS github_actor,
         'https://github.com/org-' || (user_id % 7) || '/repo-' || (event_id % 11)
           || '/actions/runs/' || event_id AS workflow_url,
         CAST(event_id AS VARCHAR) AS workflow_run_id,
         CAST(event_id % 3 + 1 AS VARCHAR) AS workflow_run_attempt,
         CASE event_id % 3 WHEN 0 THEN '' || event_id WHEN 1 THEN event_id || ',' || (event_id + 1)
              ELSE '' END AS pull_request_numbers,
         ts, event_id,
         CASE WHEN event_id % 8 IN (1, 2) THEN 'NOT_FOUND'
              WHEN event_id % 8 IN (3, 5, 7) OR event_id % 16 = 6 THEN 'FAILURE'
              ELSE 'SUCCESS' END AS status
  FROM events
  WHERE event_type = 'purchase' AND event_id % 4 <> 0
    AND event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'purchase' AND event_id % 5 = 0)
)"""
QUEUE_SELECT = "SELECT * EXCLUDE (ts, event_id, status) FROM queue"


@query("artifact_queue", f"WITH {QUEUE} {QUEUE_SELECT}")
def _(d):
    return art.artifact_queue(d.events, d.artifacts)


@query("stored_artifact_queue", f"WITH {QUEUE} {QUEUE_SELECT}")
def _(d):
    store = _new_store(d)
    for batch, events in _batches(d.workflow_runs, "2024-01-15"):
        write_typed(store, events, batch, ("completed_runs",))
    store.append("artifacts", d.artifacts)
    return jobs.plan_log_fetch(store)


# The limit is what this one shows: the oldest runs of a batch that a caller asks for.
@query("artifact_queue_batch", f"WITH {QUEUE} {QUEUE_SELECT} ORDER BY ts, delivery_id LIMIT 100")
def _(d):
    return art.artifact_queue(d.events, d.artifacts, batch_size=100)


@query(
    "artifact_status",
    f"""WITH {QUEUE}
SELECT delivery_id, TIMESTAMP '2024-02-05' AS processed_at, status, workflow_url AS workflow_uri,
       'gs://{BUCKET}/' || repo_slug || '/' || delivery_id || '/artifacts.tar.gz' AS logs_uri,
       github_actor, org_name AS organization_name, repo_name AS repository_name,
       repo_slug AS repository_slug, '' AS job_name
FROM queue""",
)
def _(d):
    queue = art.artifact_queue(d.events, d.artifacts)
    return art.artifact_status(queue, d.fetch_outcomes, BUCKET, AS_OF)


@query(
    "artifact_pr_comments",
    f"""WITH {QUEUE}
SELECT delivery_id, org_name AS organization_name, repo_name AS repository_name,
       event_id + n AS pull_request_number, CAST(n AS INTEGER) AS position,
       'Logs for workflow run [' || workflow_run_id || '](' || workflow_url || ') attempt '
         || workflow_run_attempt || ' uploaded to GCS [here](https://console.cloud.google.com/storage/browser/{BUCKET}/'
         || repo_slug || '/' || delivery_id || '?project={PROJECT})' AS body
FROM queue, (VALUES (0), (1)) v(n)
WHERE status = 'SUCCESS' AND (event_id % 3 = 1 OR (event_id % 3 = 0 AND n = 0))""",
)
def _(d):
    queue = art.artifact_queue(d.events, d.artifacts)
    return art.artifact_pr_comments(queue, d.fetch_outcomes, BUCKET, PROJECT)


# How many comments of a run got through before the first one that did not.
POSTED = f"""
{QUEUE},
posted AS (
  SELECT queue.*, coalesce(len(string_split(nullif(pull_request_numbers, ''), ',')), 0) AS wanted,
         CASE WHEN (event_id % 7 = 3 AND event_id % 21 <> 3 AND event_id % 2 = 0)
                OR (event_id % 17 = 4 AND NOT event_id % 21 = 3) OR (event_id % 17 = 4 AND event_id % 2 = 1) THEN 0
              WHEN (event_id % 7 = 3 AND event_id % 21 <> 3 AND event_id % 2 = 1) OR (event_id % 13 = 5 AND NOT (event_id % 21 = 3 AND event_id % 2 = 1)) THEN 1
              ELSE 2 END AS done
  FROM queue
)"""


@query(
    "artifact_status_of_posts",
    f"""WITH {POSTED}
SELECT delivery_id, TIMESTAMP '2024-02-05' AS processed_at,
       CASE WHEN status = 'SUCCESS' AND done < wanted THEN 'FAILURE' ELSE status END AS status,
       workflow_url AS workflow_uri,
       'gs://{BUCKET}/' || repo_slug || '/' || delivery_id || '/artifacts.tar.gz' AS logs_uri,
       github_actor, org_name AS organization_name, repo_name AS repository_name,
       repo_slug AS repository_slug, '' AS job_name
FROM posted""",
)
def _(d):
    queue = art.artifact_queue(d.events, d.artifacts)
    return art.artifact_status(queue, d.fetch_outcomes, BUCKET, AS_OF, d.comment_posts)


@query(
    "artifact_comments_posted",
    f"""WITH {POSTED}
SELECT delivery_id, CAST(n AS INTEGER) AS position, event_id + n AS pull_request_number
FROM posted, (VALUES (0), (1)) v(n) WHERE status = 'SUCCESS' AND n < least(wanted, done)""",
)
def _(d):
    queue = art.artifact_queue(d.events, d.artifacts)
    comments = art.artifact_pr_comments(queue, d.fetch_outcomes, BUCKET, PROJECT, d.comment_posts)
    return comments.select("delivery_id", "position", "pull_request_number")


@query(
    "publisher_source",
    """WITH runs AS (
  SELECT event_id, ts, user_id, 1000000 + event_id + n AS pull_request_id
  FROM events, (VALUES (0), (1)) v(n)
  WHERE event_type = 'purchase' AND event_id % 5 = 0
    AND (event_id % 3 = 1 OR (event_id % 3 = 0 AND n = 0))
    AND ts >= TIMESTAMP '2024-02-05' - INTERVAL 30 DAY
),
merged AS (
  SELECT 'pe-' || event_id AS delivery_id, 1000000 + event_id AS id,
         'https://github.com/org/repo/pull/' || event_id AS html_url
  FROM events
  WHERE event_type = 'purchase'
    AND ts + to_hours(CAST(event_id % 240 AS INTEGER))
        BETWEEN TIMESTAMP '2024-02-05' - INTERVAL 30 DAY AND TIMESTAMP '2024-02-05' - INTERVAL 1 HOUR
)
SELECT delivery_id, pull_request_id, html_url AS pull_request_html_url, ts AS received,
       'gs://logs/org-' || (user_id % 7) || '/repo-' || (event_id % 11) || '/wr-' || event_id
         || '/artifacts.tar.gz' AS logs_uri,
       md5('h' || event_id) AS head_sha
FROM merged JOIN runs ON id = pull_request_id
WHERE id NOT IN (SELECT 1000000 + event_id FROM events WHERE event_id % 9 = 0)
ORDER BY received, pull_request_id""",
)
def _(d):
    return publisher.publisher_source(
        d.pull_request_events, d.artifacts, d.events, d.invocation_comments, AS_OF
    )


@query(
    "invocation_comment_append",
    """SELECT 1000000 + event_id AS pull_request_id,
       'https://github.com/org/repo/pull/' || event_id AS pull_request_html_url,
       TIMESTAMP '2024-02-05' AS processed_at,
       CASE WHEN event_id % 2 = 0 THEN event_id END AS comment_id,
       CASE WHEN event_id % 2 = 0 THEN 'SUCCESS' ELSE 'FAILURE' END AS status, 'publish' AS job_name
FROM events WHERE event_type = 'purchase'""",
)
def _(d):
    number = F.col("id") - 1_000_000
    posted = number % 2 == 0
    return publisher.invocation_comment_rows(
        d.pull_request_events.select(
            F.lit("publish").alias("job_name"),
            F.when(posted, "SUCCESS").otherwise("FAILURE").alias("status"),
            F.when(posted, number).alias("comment_id"),
            F.lit(AS_OF).alias("processed_at"),
            F.col("html_url").alias("pull_request_html_url"),
            F.col("id").alias("pull_request_id"),
        )
    )


# -- redelivery ---------------------------------------------------------------------------

LOG = f"""
log AS (
  SELECT event_id AS id, md5(CAST(event_id AS VARCHAR)) AS guid,
         CASE WHEN value > 80 THEN 500 WHEN value > 70 THEN 404 ELSE 200 END AS status_code
  FROM events
),
recent AS (
  SELECT * FROM log WHERE id > {CHECKPOINT} OR NOT EXISTS (SELECT 1 FROM log WHERE id = {CHECKPOINT})
),
failed AS (SELECT id, guid FROM recent WHERE status_code NOT BETWEEN 200 AND 299),
reconciled AS (
  SELECT id, guid,
         CASE WHEN id % 10 = 9 THEN 'PENDING' WHEN id % 5 IN (0, 1) THEN 'REDELIVERED'
              WHEN id % 3 = 0 THEN 'ALREADY_PRESENT' ELSE 'FATAL' END AS result
  FROM failed
)"""


@query("failed_deliveries", f"WITH {LOG} SELECT id, guid FROM failed ORDER BY id DESC")
def _(d):
    return redelivery.failed_deliveries(d.deliveries, CHECKPOINT)


@query(
    "read_checkpoint",
    "SELECT CAST(max(event_id) AS VARCHAR) AS delivery_id FROM events WHERE event_type = 'signup' AND event_id % 3 < 2",
)
def _(d):
    return redelivery.read_checkpoint(d.checkpoints)


@query(
    "read_checkpoint_other_host",
    "SELECT CAST(max(event_id) AS VARCHAR) AS delivery_id FROM events WHERE event_type = 'signup' AND event_id % 3 = 2",
)
def _(d):
    return redelivery.read_checkpoint(d.checkpoints, "ghes.example.com")


@query(
    "latest_checkpoints",
    """SELECT CASE WHEN event_id % 3 < 2 THEN '' ELSE 'ghes.example.com' END AS domain,
       CAST(max(event_id) AS VARCHAR) AS delivery_id
FROM events WHERE event_type = 'signup' GROUP BY 1""",
)
def _(d):
    return redelivery.latest_checkpoints(d.checkpoints)


@query(
    "write_checkpoint",
    """SELECT CAST(max(event_id) AS VARCHAR) AS delivery_id, TIMESTAMP '2024-02-05' AS created,
       '' AS github_instance_url FROM events""",
)
def _(d):
    return redelivery.write_checkpoint(d.deliveries, AS_OF)


@query("delivery_exists", f'WITH {LOG} SELECT id, guid, id % 3 = 0 AS "exists" FROM failed')
def _(d):
    failed = redelivery.failed_deliveries(d.deliveries, CHECKPOINT)
    return redelivery.delivery_exists(failed, d.arrived)


def _reconciled(d: DerivedEvents) -> DataFrame:
    failed = redelivery.failed_deliveries(d.deliveries, CHECKPOINT)
    return redelivery.reconcile_redeliveries(failed, d.redelivery_outcomes, d.arrived)


@query("reconcile_redeliveries", f"WITH {LOG} SELECT * FROM reconciled")
def _(d):
    return _reconciled(d)


@query(
    "redelivery_summary",
    f"""WITH {LOG}
SELECT (SELECT count(*) FROM recent) + (SELECT count(*) FROM log WHERE id = {CHECKPOINT}) AS total_event_count,
       count(*) AS failed_event_count,
       count(*) FILTER (result IN ('REDELIVERED', 'ALREADY_PRESENT')) AS redelivered_event_count,
       count(*) FILTER (result = 'FATAL') AS fatal_event_count
FROM reconciled""",
)
def _(d):
    return redelivery.redelivery_summary(d.deliveries, _reconciled(d), CHECKPOINT)
