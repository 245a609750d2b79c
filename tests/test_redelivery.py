import pytest
from helpers import event, events, rows, ts

from devmetrics.operators import redelivery as red
from devmetrics.plans import jobs

LOG_DDL = "id bigint, guid string, status_code int"
NOW = "2024-01-01 10:00:00.7 UTC"


def log(spark, *items):
    return spark.createDataFrame([(i, f"g{i}", c) for i, c in items], LOG_DDL)


def checkpoints(spark, *items):
    return spark.createDataFrame(
        [(d, ts("2024-01-01"), u) for d, u in items],
        "delivery_id string, created timestamp, github_instance_url string",
    )


def outcomes(spark, *items):
    return spark.createDataFrame(list(items), "id bigint, outcome string")


def test_latest_checkpoint_is_numeric_and_per_host(spark):
    df = checkpoints(spark, ("99", None), ("100", ""), ("5000", "ghes"), ("700", "ghes"))
    assert rows(red.read_checkpoint(df)) == [("100",)]
    assert rows(red.read_checkpoint(df, "ghes")) == [("5000",)]
    assert rows(red.read_checkpoint(df, "other")) == []
    assert rows(red.latest_checkpoints(df)) == [("", "100"), ("ghes", "5000")]


def test_new_checkpoint(spark):
    row = red.write_checkpoint(log(spark, (9, 200), (100, 500)), NOW)
    assert rows(row.selectExpr("delivery_id", "date_format(created, 'HH:mm:ss.S')", "github_instance_url")) == [
        ("100", "10:00:00.0", "")
    ]
    assert rows(red.write_checkpoint(log(spark, (1, 200)), NOW, "ghes"), "github_instance_url") == [("ghes",)]
    assert red.write_checkpoint(log(spark), NOW).count() == 0


def test_failed_since_checkpoint(spark):
    df = log(spark, (1, 500), (2, 200), (3, 404), (4, 299), (5, 300), (6, 199), (7, None))
    assert [r.id for r in red.failed_deliveries(df).collect()] == [7, 6, 5, 3, 1]
    assert [r.id for r in red.failed_deliveries(df, "3").collect()] == [7, 6, 5]
    assert [r.id for r in red.failed_deliveries(df, "").collect()] == [7, 6, 5, 3, 1]
    # A checkpoint that the log no longer holds stops nothing.
    assert [r.id for r in red.failed_deliveries(df.filter("id <> 4"), "4").collect()] == [7, 6, 5, 3, 1]


def test_reconcile(spark):
    failed = red.failed_deliveries(log(spark, *((i, 500) for i in range(1, 7))))
    tried = outcomes(
        spark, (1, "ok"), (2, "accepted"), (3, "bad gateway"), (4, "bad gateway"),
        (5, "bad gateway"), (5, "ok"),
    )
    stored = events(spark, event("push", {}, "g3"), event("push", {}, "g3"), event("push", {}, None))
    got = red.reconcile_redeliveries(failed, tried, stored)
    assert dict(rows(got, "id", "result")) == {
        1: "REDELIVERED", 2: "REDELIVERED", 3: "ALREADY_PRESENT", 4: "FATAL",
        5: "REDELIVERED", 6: "PENDING",
    }
    assert rows(red.delivery_exists(failed, stored).filter("exists"), "id") == [(3,)]


def test_summary_counts_the_checkpoint_entry(spark):
    df = log(spark, (1, 500), (2, 200), (3, 500), (4, 200))
    reconciled = red.reconcile_redeliveries(
        red.failed_deliveries(df, "2"), outcomes(spark, (3, "ok")), events(spark)
    )
    assert rows(red.redelivery_summary(df, reconciled, "2")) == [(3, 1, 1, 0)]
    assert rows(red.redelivery_summary(df, reconciled)) == [(4, 1, 1, 0)]


def test_job(spark, store):
    first = log(spark, (1, 200), (2, 500), (3, 200))
    failed = jobs.plan_redelivery(store, first, NOW)
    assert rows(store.read("redelivery_outbox"), "id", "guid") == [(2, "g2")]
    with pytest.raises(jobs.RedeliveryFailed):
        jobs.record_redelivery(store, first, failed, outcomes(spark, (2, "timeout")), NOW)
    assert jobs.current_checkpoint(store) is None

    store.append("optimized_events", events(spark, event("push", {}, "g2")))
    counters = jobs.record_redelivery(store, first, failed, outcomes(spark, (2, "timeout")), NOW)
    assert counters == {
        "total_event_count": 3, "failed_event_count": 1,
        "redelivered_event_count": 1, "fatal_event_count": 0,
    }
    assert jobs.current_checkpoint(store) == "3"

    # Nothing was tried in time: the checkpoint moves on all the same.
    second = log(spark, (3, 200), (9999, 500))
    failed = jobs.plan_redelivery(store, second, NOW)
    assert rows(failed, "id") == [(9999,)]
    jobs.record_redelivery(store, second, failed, outcomes(spark), NOW)
    assert jobs.current_checkpoint(store) == "9999"
    assert jobs.current_checkpoint(store, "ghes") is None


def test_empty_log_writes_no_checkpoint(spark, store):
    failed = jobs.plan_redelivery(store, log(spark), NOW)
    jobs.record_redelivery(store, log(spark), failed, outcomes(spark), NOW)
    assert store.read("checkpoint").count() == 0
