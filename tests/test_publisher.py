import pytest
from helpers import event, events, rows, ts

from devmetrics.operators import publisher
from devmetrics.plans import jobs
from devmetrics.schemas import TABLES

AS_OF = "2024-02-05 00:00:00 UTC"


def run(delivery, received, *prs, event_name="workflow_run"):
    body = {"workflow_run": {"head_sha": f"sha-{delivery}", "pull_requests": [{"id": p} for p in prs]}}
    return event(event_name, body, delivery, received)


def artifacts(spark, *ids):
    return spark.createDataFrame([(i, f"gs://{i}") for i in ids], "delivery_id string, logs_uri string")


def merged(spark, *items):
    data = [(f"pe{i}", i, f"u{i}", ts(at)) for i, at in items]
    return spark.createDataFrame(data, "delivery_id string, id bigint, html_url string, merged_at timestamp")


def commented(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "pull_request_id bigint")


def test_windows_and_order(spark):
    runs = events(
        spark,
        run("late", "2024-02-04", 2, 1),
        run("early", "2024-01-10", 3),
        run("old", "2024-01-05 23:59:59", 4),
        run("text", "2024-01-10", "x"),
        run("none", "2024-01-10"),
        run("unlisted", "2024-01-10", 1),
        run("edge", "2024-01-06", 5),
    )
    prs = merged(
        spark,
        (1, "2024-02-04"), (2, "2024-02-04 23:00:00"), (3, "2024-02-04 23:00:01"),
        (4, "2024-01-10"), (5, "2024-01-06"), (5, "2024-01-07"), (6, "2024-01-05"),
    )
    got = publisher.publisher_source(
        prs, artifacts(spark, "late", "early", "old", "text", "none", "edge"), runs, commented(spark), AS_OF
    )
    assert [tuple(r)[:3] + tuple(r)[4:] for r in got.collect()] == [
        ("pe5", 5, "u5", "gs://edge", "sha-edge"),
        ("pe5", 5, "u5", "gs://edge", "sha-edge"),
        ("pe1", 1, "u1", "gs://late", "sha-late"),
        ("pe2", 2, "u2", "gs://late", "sha-late"),
    ]


@pytest.mark.parametrize("done, left", [([], {1, 2}), ([1], {2}), ([1, None], set())])
def test_commented_pull_requests(spark, done, left):
    runs = events(spark, run("a", "2024-02-01", 1, 2))
    prs = merged(spark, (1, "2024-02-01"), (2, "2024-02-01"))
    got = publisher.publisher_source(prs, artifacts(spark, "a"), runs, commented(spark, *done), AS_OF)
    assert {r.pull_request_id for r in got.collect()} == left


def test_job_round(spark, store):
    store.append("optimized_events", events(spark, run("a", "2024-02-01", 1)))
    now = ts("2024-02-01")
    store.append(
        "artifacts",
        spark.createDataFrame(
            [("a", now, "FAILURE", "w", "gs://a", "bot", "o", "r", "o/r", "")],
            TABLES["artifacts"].schema,
        ),
    )
    prs = merged(spark, (1, "2024-02-01"))
    todo = jobs.plan_publishing(store, prs, AS_OF)
    assert rows(todo, "pull_request_id", "logs_uri") == [(1, "gs://a")]  # whatever the status
    done = todo.selectExpr(
        "'job' job_name", "'SUCCESS' status", "current_timestamp() processed_at",
        "CAST(NULL AS BIGINT) comment_id", "pull_request_html_url", "pull_request_id",
    )
    jobs.record_publishing(store, done)
    assert rows(store.read("invocation_comment"), "pull_request_id", "comment_id", "job_name") == [
        (1, None, "job")
    ]
    assert jobs.plan_publishing(store, prs, AS_OF).count() == 0
