import re

import pytest
from helpers import event, events, final_plan, rows, ts
from pyspark.sql import functions as F

from devmetrics.operators.incremental import watermark
from devmetrics.operators.integration import EVENT_KINDS, integration_events
from devmetrics.plans import jobs

CASES = [
    ("create", {"ref_type": "branch"}, "BRANCH"),
    ("create", {"ref_type": "tag"}, "TAG"),
    ("create", {"ref_type": "repository"}, None),
    ("deployment", {"action": "created"}, "DEPLOYMENT_STARTED"),
    ("deployment", {"action": "created", "deployment_status": {"state": "success"}}, None),
    ("deployment_status", {"deployment_status": {"state": "success"}}, "DEPLOYMENT_ENDED"),
    ("deployment_status", {"deployment_status": {"state": "failure"}}, "DEPLOYMENT_FAILED"),
    ("deployment_status", {"deployment_status": {"state": "error"}}, "DEPLOYMENT_FAILED"),
    ("deployment_status", {"deployment_status": {"state": "pending"}}, None),
    ("pull_request", {"action": "assigned"}, "PR_ASSIGNED"),
    ("pull_request", {"action": "closed", "pull_request": {"merged": False}}, "PR_ABANDONED"),
    ("pull_request", {"action": "closed", "pull_request": {"merged": True}}, "PR_CLOSED"),
    ("pull_request", {"action": "closed"}, None),
    ("pull_request", {"action": "opened"}, "PR_OPENED"),
    ("pull_request", {"action": "ready_for_review"}, "PR_READY"),
    ("pull_request", {"action": "review_requested"}, "PR_REVIEW_REQUEST"),
    ("pull_request", {"action": "labeled"}, None),
    ("pull_request_review", {"action": "submitted", "review": {"state": "approved"}}, "PR_SIGNOFF"),
    ("pull_request_review", {"action": "submitted"}, None),
    ("pull_request_review_comment", {"action": "created"}, "PR_COMMENT"),
    ("pull_request_review_comment", {"action": "deleted"}, "PR_COMMENT"),
    ("pull_request_review_comment", {"action": "edited"}, "PR_COMMENT"),
    ("pull_request_review_comment", {"action": "other"}, None),
    ("push", {}, "PUSH"),
    ("repository", {"action": "created"}, "REPO"),
    ("repository", {"action": "deleted"}, None),
    ("workflow_job", {"action": "queued"}, "JOB_CREATED"),
    ("workflow_job", {"action": "completed"}, "JOB_COMPLETED"),
    ("workflow_job", {"action": "in_progress"}, None),
    ("workflow_run", {"action": "requested"}, "RUN_CREATED"),
    ("workflow_run", {"action": "completed"}, "RUN_COMPLETED"),
    ("issues", {"action": "opened"}, None),
]
SYSTEM = {"deployment", "deployment_status", "workflow_job", "workflow_run"}


def test_every_kind(spark):
    df = events(spark, *(event(e, p, f"d{i}") for i, (e, p, _) in enumerate(CASES)))
    found = {r.delivery_id: r for r in integration_events(df).collect()}
    for i, (name, _, kind) in enumerate(CASES):
        row = found.get(f"d{i}")
        assert (row.github_event_type if row else None) == kind, CASES[i]
        if row:
            wanted = "SYSTEM_ACTION" if name in SYSTEM else "USER_INTERACTION"
            assert row.action_type == wanted
    assert {k for _, _, k in CASES if k} == {k for _, _, k in EVENT_KINDS}


def test_malformed_payload_is_not_classified_but_push_needs_none(spark):
    df = events(spark, event("pull_request", '{"action": ', "a"), event("push", "nonsense", "b"))
    assert rows(integration_events(df), "delivery_id") == [("b",)]


@pytest.mark.parametrize(
    "payload, username",
    [
        ({"sender": {"login": "Sender"}, "actor": {"login": "a"}}, "sender"),
        ({"actor": {"login": "Actor"}, "pull_request": {"user": {"login": "p"}}}, "actor"),
        ({"pull_request": {"user": {"login": "Pr"}}, "issue": {"user": {"login": "i"}}}, "pr"),
        ({"issue": {"user": {"login": "Issue"}}}, "issue"),
        ({"sender": None}, None),
    ],
)
def test_username_precedence(spark, payload, username):
    assert rows(integration_events(events(spark, event("push", payload))), "username") == [(username,)]


def test_field_precedence_and_names(spark):
    payload = {
        "action": "opened",
        "pull_request": {"id": 1, "head": {"sha": "s1", "ref": "r1"}},
        "issue": {"id": 2},
        "comment": {"id": 3},
        "workflow_run": {"id": 4, "head_sha": "s4"},
        "check_suite": {"head_sha": "s3"},
        "ref": "r2",
        "repository": {"html_url": "https://github.com/o/r"},
    }
    names = {"enterprise_name": "Google-x", "organization_name": "o", "repository_name": "o/r"}
    df = events(spark, event("pull_request", payload, received="2024-01-01 10:00:00.75", **names))
    row = integration_events(df).collect()[0]
    assert (row.event_id, row.ref_sha, row.ref_name) == ("1", "s1", "r1")
    assert row.source == "GITHUB_SOURCE_GITHUB_ONPREM"
    assert (row.enterprise, row.organization, row.repository) == ("Google-x", "o", "o/r")
    assert row.repository_url == "https://github.com/o/r"
    assert rows(integration_events(df), F.date_format("timestamp_seconds", "HH:mm:ss.SSS")) == [
        ("10:00:00.000",)
    ]


def test_sample_pull_request(spark):
    payload = {
        "action": "opened",
        "number": 2,
        "pull_request": {
            "id": 279147437,
            "html_url": "https://github.com/Codertocat/Hello-World/pull/2",
            "user": {"login": "Codertocat"},
            "merged_at": None,
            "head": {"ref": "changes", "sha": "ec26c3e57ca3a959ca5aad62de7213c562f8c821"},
            "merged": False,
        },
        "repository": {"html_url": "https://github.com/Codertocat/Hello-World"},
        "sender": {"login": "Codertocat"},
    }
    columns = ("username", "github_event_type", "event_id", "ref_name", "enterprise")
    assert rows(integration_events(events(spark, event("pull_request", payload))), *columns) == [
        ("codertocat", "PR_OPENED", "279147437", "changes", None)
    ]


def test_source_defaults_to_hosted(spark):
    df = events(
        spark,
        event("push", {}, "a"),
        event("push", {}, "b", enterprise_name="google-x"),
        event("push", {}, "c", enterprise_name="Google-"),
    )
    assert rows(integration_events(df), "delivery_id", "source") == [
        ("a", "GITHUB_SOURCE_GITHUB_COM"),
        ("b", "GITHUB_SOURCE_GITHUB_COM"),
        ("c", "GITHUB_SOURCE_GITHUB_ONPREM"),
    ]


def test_newest_second_is_loaded_once(spark, store):
    """The target keeps whole seconds: late arrivals in its newest second still load, none twice."""
    first = [
        event("push", {}, "a", "2024-01-01 10:00:00.100"),
        event("push", {}, "b", "2024-01-01 10:00:05.200"),
    ]
    store.append("optimized_events", events(spark, *first))
    jobs.load_integration_events(store)
    assert rows(store.read("integration_events"), "delivery_id") == [("a",), ("b",)]

    second = [
        event("push", {}, "c", "2024-01-01 10:00:05.900"),
        event("push", {}, "d", "2024-01-01 10:00:06"),
        event("push", {}, "old", "2024-01-01 10:00:05"),
    ]
    store.append("optimized_events", events(spark, *second))
    jobs.load_integration_events(store)
    loaded = [("a",), ("b",), ("c",), ("d",)]
    assert rows(store.read("integration_events"), "delivery_id") == loaded
    jobs.load_integration_events(store)
    assert rows(store.read("integration_events"), "delivery_id") == loaded


def test_empty_target_starts_in_2015(spark, store):
    df = events(
        spark,
        event("push", {}, "before", "2014-12-31 23:59:59"),
        event("push", {}, "at", "2015-01-01"),
        event("push", {}, "after", "2015-01-01 00:00:01"),
    )
    new = integration_events(df, store.read("integration_events"))
    assert rows(new, "delivery_id") == [("after",)]


def test_columns_are_stored_by_name(spark, store):
    """The three text columns must not land rotated."""
    store.append("optimized_events", events(spark, event("push", {})))
    jobs.load_integration_events(store)
    stored = rows(
        store.read("integration_events"), "event_type", "action_type", "source", "github_event_type"
    )
    assert stored == [("GITHUB", "USER_INTERACTION", "GITHUB_SOURCE_GITHUB_COM", "PUSH")]


def test_incremental_scan_prunes_days_and_parses_once(spark, store):
    days = [event("push", {}, f"d{i}", f"2024-01-0{i}") for i in range(1, 6)]
    store.append("optimized_events", events(spark, *days))
    store.append("integration_events", integration_events(events(spark, *days[:3])))
    new = integration_events(store.read("optimized_events"), store.read("integration_events"))
    plan = final_plan(new)
    assert rows(new, "delivery_id") == [("d4",), ("d5",)]
    assert re.search(r"PartitionFilters: \[[^]]*event_date", plan)
    assert plan.count("from_json(") == 1


def test_received_of_microseconds_after_the_mark(spark, store):
    store.append("integration_events", integration_events(events(spark, event("push", {}, "a"))))
    df = events(spark, event("push", {}, "b", "2024-01-01 00:00:00.000001"))
    assert rows(integration_events(df, store.read("integration_events")), "delivery_id") == [("b",)]
    assert ts("2024-01-01").year == 2024


def test_watermark_reads_the_newest_day_only(spark, store):
    old = [event("push", {"sender": {"login": "a"}}, f"d{i}", received=f"2024-01-0{i} 10:00:00") for i in (1, 2, 3)]
    store.append("optimized_events", events(spark, *old))
    store.append("integration_events", integration_events(store.read("optimized_events").filter("delivery_id <> 'd3'")))
    target = store.read("integration_events")
    due = integration_events(store.read("optimized_events"), target)
    assert rows(due, "delivery_id") == [("d3",)]
    plan = target.select(watermark(target, "timestamp_seconds", by_day=True).alias("w")).limit(1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*event_date", text)
