"""Small builders for literal test data."""

import datetime as dt
import json
import time
import uuid

from devmetrics.streaming.ingest import store_events

EVENT_DDL = (
    "delivery_id string, signature string, received timestamp, event string, "
    "enterprise_name string, enterprise_id string, organization_name string, "
    "organization_id string, repository_name string, repository_id string, payload string"
)


def ts(text):
    """A UTC instant from 'YYYY-MM-DD[ HH:MM:SS[.ffffff]]'."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def event(event, payload, delivery_id="d", received="2024-01-01", **identity):
    body = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
    names = (
        "enterprise_name", "enterprise_id", "organization_name",
        "organization_id", "repository_name", "repository_id",
    )
    return (delivery_id, None, ts(received), event, *(identity.get(n) for n in names), body)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT_DDL)


def rows(df, *columns):
    """Sorted tuples of the given columns (all by default)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def final_plan(df):
    """The executed adaptive plan, after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffled(df):
    """Bytes that went into the shuffles of the query, after running it."""
    df.collect()

    def walk(node):
        if node.nodeName() == "ReusedExchange":
            return 0
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("dataSize").get().value() if node.nodeName() == "Exchange" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan().executedPlan())


def shuffle_files(spark):
    """Names of the shuffle files that a local session has on disk."""
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that came after ``before`` and are still there after a while."""
    deadline = time.monotonic() + 10
    while (left := shuffle_files(spark) - before) and time.monotonic() < deadline:
        time.sleep(0.1)
    return left


def take_in(store, df):
    """Events with their identity, stored as one batch of the intake."""
    store_events(store, df, f"test-{uuid.uuid4().hex}")
