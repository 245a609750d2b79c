"""Typed tables: what the intake keeps, and the jobs that read them instead of events."""

import datetime as dt
import re

import pytest
from helpers import event, events, rows, take_in

from devmetrics.operators import artifacts, pull_requests, review
from devmetrics.plans import jobs, typed
from devmetrics.sources.tables import ConcurrentRun, TableStore
from devmetrics.streaming.ingest import store_events

T0 = "2024-01-01T00:00:00Z"


def closed(pr, who, received):
    body = {"action": "closed", "pull_request": {"id": pr, "user": {"login": who}, "merged_at": T0, "created_at": T0, "updated_at": T0}}
    return event("pull_request", body, f"c{pr}-{received}", received)


def review_of(pr, who, received="2024-01-01"):
    body = {"pull_request": {"id": pr}, "review": {"user": {"login": who}, "updated_at": T0}}
    return event("pull_request_review", body, f"r{pr}{who}", received)


def comment_on(pr, who, received="2024-01-01"):
    body = {"pull_request": {"id": pr}, "comment": {"user": {"login": who}, "updated_at": T0}}
    return event("pull_request_review_comment", body, f"m{pr}{who}", received)


def run(number, received="2024-01-01"):
    body = {
        "repository": {"full_name": "o/r", "name": "r", "owner": {"login": "o"}},
        "workflow_run": {"id": number, "status": "completed", "pull_requests": [{"number": 1}]},
    }
    return event("workflow_run", body, f"w{number}", received)


def push(number, received="2024-01-01"):
    body = {
        "ref": "refs/heads/main", "compare_url": "https://github.com/o/r", "pusher": {"name": "p"}, "organization": {"login": "o"},
        "repository": {"name": "r", "default_branch": "main"}, "commits": [{"id": f"s{number}", "timestamp": T0}],
    }
    return event("push", body, f"p{number}", received)


FIRST = [closed(1, "Ann", "2024-01-03"), review_of(1, "Bob"), review_of(2, "Cy"), comment_on(2, "Di"), run(1), push(1)]
SECOND = [closed(2, "Ann", "2024-01-05"), review_of(2, "Bob", "2023-12-01"), review_of(2, "Cy"), comment_on(2, "Di", "2023-12-01"), run(2), push(2)]
SHAPES = {
    "prstats": pull_requests.prstats,
    "prstats_pull_requests": pull_requests.prstats_pull_requests,
    "prstats_pull_request_reviews": pull_requests.prstats_pull_request_reviews,
}


@pytest.mark.parametrize("table", sorted(SHAPES))
def test_two_loads_equal_one_over_everything(spark, store, table):
    take_in(store, events(spark, *FIRST))
    jobs.load_pull_request_stats(store, table)
    take_in(store, events(spark, *SECOND))
    jobs.load_pull_request_stats(store, table)
    wanted = SHAPES[table](events(spark, *FIRST, *SECOND))
    assert rows(store.read(table), *wanted.columns) == rows(wanted)


def test_a_replayed_batch_leaves_each_typed_row_once(spark, store):
    for _ in range(2):
        store_events(store, events(spark, *FIRST), "s-1")
    store_events(store, events(spark, *SECOND), "s-2")
    both = events(spark, *FIRST, *SECOND)
    for name, of in typed.TYPED.items():
        columns = [c for c in of(both).columns if c not in ("n", "received")]
        assert rows(store.read(name).select(*columns).distinct()) == rows(of(both).select(*columns).distinct())
    assert store.read("completed_runs").count() == 2
    counts = rows(store.read("pull_request_activity").groupBy("pr_id", "is_review", "who").sum("n"))
    assert ("2", True, "Cy", 2) in counts and ("2", False, "Di", 2) in counts


def test_rebuilding_gives_what_the_intake_gives(spark, store, tmp_path):
    take_in(store, events(spark, *FIRST, *SECOND))
    old = TableStore(spark, str(tmp_path / "old"))
    old.append("optimized_events", events(spark, *FIRST, *SECOND))
    typed.rebuild_typed(old)
    for name, spec in ((n, old.schema(n)) for n in typed.TYPED):
        columns = [c for c in spec.fieldNames() if c != "ingest_batch"]
        assert rows(old.read(name), *columns) == rows(store.read(name), *columns)


def test_jobs_equal_their_operators_over_events(spark, store):
    both = events(spark, *FIRST, *SECOND)
    take_in(store, both)
    queue = artifacts.artifact_queue(both, store.read("artifacts"))
    assert rows(jobs.plan_log_fetch(store)) == rows(queue) and queue.count() == 2
    prs = spark.createDataFrame([], "organization string, repository string, commit_sha string, default_branch string, ordinal int, base_ref string, pr_id bigint, pr_number bigint, pr_url string")
    states = spark.createDataFrame([], "pr_id bigint, state string")
    jobs.review_commits(store, prs, states)
    wanted = review.commit_review_status(both, store.read("commit_review_status").limit(0), prs, states)
    assert rows(store.read("commit_review_status"), *wanted.columns) == rows(wanted) and wanted.count() == 2


def outputs_of(monkeypatch, job):
    """What a job stores, as DataFrames."""
    found, run_once = [], TableStore.run_once

    def spying(self, name, run, build):
        def spy(state):
            outputs, new_state = build(state)
            found.extend(outputs.values())
            return outputs, new_state

        return run_once(self, name, run, spy)

    monkeypatch.setattr(TableStore, "run_once", spying)
    job()
    monkeypatch.undo()
    return found


@pytest.mark.parametrize("table", sorted(jobs.PR_TABLES))
def test_no_scheduled_plan_parses_history(spark, store, monkeypatch, table):
    take_in(store, events(spark, *FIRST))
    jobs.load_pull_request_stats(store, table)
    take_in(store, events(spark, *SECOND))
    (df,) = outputs_of(monkeypatch, lambda: jobs.load_pull_request_stats(store, table))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = "\n".join(df.inputFiles())
    assert "from_json" not in text and "/pull_request_activity/" in read
    # Nor is the position looked up in the target, and days before it are pruned.
    assert "/optimized_events/" not in read and f"/{table}/" not in read
    assert re.search(r"PartitionFilters: \[[^]]*event_date#\d+ >= ", text)


def test_the_queue_parses_nothing(spark, store):
    take_in(store, events(spark, *FIRST))
    queue = artifacts.waiting_runs(store.read("completed_runs"), store.read("artifacts"))
    assert "from_json" not in queue._jdf.queryExecution().executedPlan().toString() and queue.count() == 1


def test_the_position_is_stored_with_the_run(spark, store):
    take_in(store, events(spark, *FIRST))
    assert jobs.load_pull_request_stats(store, "prstats", run="t1")
    reached = store.run_state("prstats")
    assert reached["position"] == 1_704_240_000_000_000
    assert jobs.load_pull_request_stats(store, "prstats", run="t2")
    assert store.run_state("prstats") == reached and store.read("prstats").count() == 1
    # At or before the position nothing loads any more, whenever it arrives.
    take_in(store, events(spark, closed(9, "late", "2024-01-02")))
    jobs.load_pull_request_stats(store, "prstats")
    assert store.read("prstats").count() == 1


def test_a_target_from_before_there_were_positions_is_not_loaded_again(spark, store):
    take_in(store, events(spark, *FIRST))
    store.append("prstats", pull_requests.prstats(events(spark, *FIRST)))
    jobs.load_pull_request_stats(store, "prstats")
    assert store.read("prstats").count() == 1


def test_racing_loads_do_not_both_load(spark, store, monkeypatch):
    take_in(store, events(spark, *FIRST))
    merged = pull_requests.merged_activity

    def racing(*args):
        monkeypatch.setattr(pull_requests, "merged_activity", merged)
        jobs.load_pull_request_stats(TableStore(spark, store.root), "prstats")
        return merged(*args)

    monkeypatch.setattr(pull_requests, "merged_activity", racing)
    with pytest.raises(ConcurrentRun):
        jobs.load_pull_request_stats(store, "prstats")
    assert store.read("prstats").count() == 1


def test_the_feed_keeps_its_position(spark, store):
    store.append("optimized_events", events(spark, event("push", {}, "a", "2024-01-01"), event("push", {}, "b", "2024-01-02 00:00:00.5")))
    jobs.load_integration_events(store)
    store.append("optimized_events", events(spark, event("push", {}, "c", "2024-01-02 00:00:00.7"), event("push", {}, "late", "2024-01-01")))
    jobs.load_integration_events(store)
    assert rows(store.read("integration_events"), "delivery_id") == [("a",), ("b",), ("c",)]
    assert store.run_state("integration_events")["position"] == 1_704_153_600_000_000


@pytest.mark.parametrize("table", sorted(SHAPES))
def test_late_closings_within_the_lookback_load_once(spark, store, table):
    take_in(store, events(spark, *FIRST))
    jobs.load_pull_request_stats(store, table)
    take_in(store, events(spark, closed(7, "late", "2024-01-02"), closed(8, "too late", "2023-12-30")))
    for _ in range(2):
        jobs.load_pull_request_stats(store, table, lookback=dt.timedelta(days=2))
        assert sorted({r[0] for r in rows(store.read(table), "pr_id")}) == ["1", "7"]
    assert store.run_state(table)["position"] == 1_704_240_000_000_000
    take_in(store, events(spark, *SECOND))
    jobs.load_pull_request_stats(store, table, lookback=dt.timedelta(days=30))
    assert sorted({r[0] for r in rows(store.read(table), "pr_id")}) == ["1", "2", "7", "8"]
    whole = SHAPES[table](events(spark, *FIRST, *SECOND, closed(7, "late", "2024-01-02"), closed(8, "too late", "2023-12-30")))
    assert store.read(table).count() == whole.count()


def test_late_events_of_the_feed_load_once(spark, store):
    store.append("optimized_events", events(spark, event("push", {}, "a", "2024-01-01"), event("push", {}, "b", "2024-01-05")))
    jobs.load_integration_events(store)
    store.append("optimized_events", events(spark, event("push", {}, "late", "2024-01-04"), event("push", {}, "too late", "2024-01-01 12:00:00"), event("push", {}, "c", "2024-01-06")))
    for _ in range(2):
        jobs.load_integration_events(store, lookback=dt.timedelta(days=2))
        assert rows(store.read("integration_events"), "delivery_id") == [("a",), ("b",), ("c",), ("late",)]
    jobs.load_integration_events(store)
    assert store.read("integration_events").count() == 4


def test_unreadable_rows_go_aside_and_stop_nothing(spark, store):
    bad_pr = {"action": "closed", "pull_request": {"id": 9, "merged_at": "yesterday", "additions": "many", "created_at": T0}}
    good, late = {"id": "ok", "timestamp": T0}, {"id": "bad", "timestamp": "noon"}
    body = {
        "ref": "refs/heads/main", "compare_url": "https://github.com/o/r", "pusher": {"name": "p"}, "organization": {"login": "o"},
        "repository": {"name": "r", "default_branch": "main"}, "commits": [good, late, {"timestamp": T0}, {"id": "timeless"}],
    }
    issue = {
        "repository": {"name": "breakglass"}, "organization": {"login": "o"},
        "issue": {"html_url": "https://github.com/i", "created_at": "soon", "closed_at": T0},
    }
    still_open = {"repository": {"name": "breakglass"}, "issue": {"created_at": T0}}
    batch = [
        closed(1, "Ann", "2024-01-03"), event("pull_request", bad_pr, "d-pr"), event("push", body, "d-push"),
        event("issues", issue, "d-issue"), event("issues", still_open, "d-open"),
    ]
    for _ in range(2):
        store_events(store, events(spark, *batch), "s-1")
    assert rows(store.read("unreadable_rows"), "delivery_id", "table_name", "unreadable") == [
        ("d-issue", "emergency_issues", ["created_at=soon"]),
        ("d-pr", "merged_pull_requests", ["insertions=many", "submitted=yesterday"]),
        ("d-push", "pushed_commits", ["commit_sha"]),
        ("d-push", "pushed_commits", ["commit_timestamp"]),
        ("d-push", "pushed_commits", ["commit_timestamp=noon"]),
    ]
    assert rows(store.read("merged_pull_requests"), "pr_id") == [("1",)]
    assert rows(store.read("pushed_commits"), "commit_sha") == [("ok",)]
    assert rows(store.read("emergency_issues")) == []
    jobs.load_pull_request_stats(store, "prstats")
    assert store.read("prstats").count() == 1
