import pytest
from helpers import event, events, left_behind, rows, shuffle_files, ts
from pyspark.sql import functions as F

from devmetrics.operators.incremental import incremental_rows, read_watermark
from devmetrics.plans.skew import one_row_per_key, repeat_rows
from devmetrics.plans.staging import stage
from devmetrics.schemas import TABLES


def test_unwritten_tables_are_empty(store):
    for name, spec in TABLES.items():
        df = store.read(name)
        assert df.columns[: len(spec.columns)] == spec.columns
        assert df.count() == 0


def test_append_by_name_with_casts(spark, store):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01' created, 5 delivery_id, 'extra' x, NULL github_instance_url")
    store.append("checkpoint", df)
    assert rows(store.read("checkpoint"), "delivery_id", "github_instance_url") == [("5", None)]


def test_missing_column_is_refused(spark, store):
    with pytest.raises(ValueError, match="created"):
        store.append("failure_events", spark.sql("SELECT 'a' delivery_id"))


def test_null_in_required_column_is_refused(spark, store):
    df = spark.sql("SELECT CAST(NULL AS STRING) delivery_id, TIMESTAMP'2024-01-01' created")
    with pytest.raises(Exception, match="failure_events.delivery_id must not be NULL"):
        store.append("failure_events", df)
    assert store.read("failure_events").count() == 0


def test_layout(spark, store, tmp_path):
    store.append(
        "optimized_events",
        events(spark, event("push", {}, "a", "2024-01-01 23:59:59"), event("push", {}, "b", "2024-01-02")),
    )
    days = sorted(p.name for p in (tmp_path / "tables" / "optimized_events").glob("event_date=*"))
    assert days == ["event_date=2024-01-01", "event_date=2024-01-02"]
    assert rows(store.read("optimized_events").filter("event_date = '2024-01-02'"), "delivery_id") == [("b",)]


def test_rewritten_batch_replaces_itself(spark, store):
    one = events(spark, event("push", {}, "a"), event("push", {}, "b", "2024-01-02"))
    other = events(spark, event("push", {}, "c"))
    store.write_batch("optimized_events", one, "s-1")
    store.write_batch("optimized_events", other, "s-2")
    store.write_batch("optimized_events", one, "s-1")
    assert rows(store.read("optimized_events"), "delivery_id") == [("a",), ("b",), ("c",)]


def test_incremental_rows(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01' + make_dt_interval(id) AS t FROM range(5)")
    loaded = df.filter("t < '2024-01-03'")
    assert incremental_rows(df, loaded, "t").count() == 3
    assert incremental_rows(df, loaded.limit(0), "t").count() == 5
    assert read_watermark(loaded, "t").day == 2
    assert read_watermark(loaded.limit(0), "t") is None
    assert ts("2024-01-01").day == 1


def test_stage_keeps_rows_and_uses_the_shared_folder(spark):
    staged = stage(spark.range(10))
    assert staged.count() == 10
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


def test_stage_leaves_no_shuffle_behind(spark):
    before = shuffle_files(spark)
    grouped = spark.range(1000).groupBy(F.col("id") % 7).count()
    staged = stage(grouped)
    assert not left_behind(spark, before)
    assert staged.count() == grouped.count() == 7
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(setting) == "false"  # as before


def test_a_written_batch_leaves_no_shuffle_behind(spark, store):
    before = shuffle_files(spark)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("delivery_id")).agg(F.count("*").alias("n"))
    times = {"created": F.lit(ts("2024-01-01")), "received": F.lit(ts("2024-01-01"))}
    others = ("signature", "event", "status_code", "reason", "payload")
    batch = grouped.withColumns(times | {c: F.lit(None) for c in others})
    for name in ("failure_events", "webhook_rejects"):  # without and with days
        store.write_batch(name, batch, "one")
    assert not left_behind(spark, before)
    assert store.read("failure_events").count() == store.read("webhook_rejects").count() == 7


def test_repeat_rows(spark, monkeypatch):
    monkeypatch.setattr("devmetrics.plans.skew.REPEAT_BLOCK", 3)
    df = spark.sql("SELECT id, id AS n FROM range(1, 9)")
    assert rows(repeat_rows(df, "n").groupBy("id").count()) == [(i, i) for i in range(1, 9)]


def test_one_row_per_key(spark):
    df = spark.sql("SELECT IF(id % 3 = 0, NULL, id % 2) k, id v FROM range(12)")
    assert one_row_per_key(df, ["k"]).count() == 3
