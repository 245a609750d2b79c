import base64
import hashlib
import hmac
import json

from helpers import rows, ts

from devmetrics.operators import ingest
from devmetrics.sources.webhooks import (
    RAW_WEBHOOK_DDL,
    read_messages,
    read_raw_webhooks,
    stream_messages,
    stream_raw_webhooks,
)
from devmetrics.streaming import ingest as intake

SECRET = b"s3cret"


def webhook(delivery, body, secret=SECRET):
    signature = "sha256=" + hmac.new(secret, body, hashlib.sha256).hexdigest()
    return (delivery, "push", signature, ts("2024-01-01"), body)


def land(spark, path, *items):
    spark.createDataFrame(list(items), RAW_WEBHOOK_DDL).coalesce(1).write.mode("append").parquet(path)


def test_webhooks_flow_into_the_tables_once(spark, store, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    body = json.dumps({"organization": {"id": 1, "login": "o"}}).encode()
    land(
        spark, landing,
        webhook("a", body), webhook("bad", body, b"x"), webhook("empty", b""), webhook("list", b"[1]"),
    )

    def run():
        stream = stream_raw_webhooks(spark, landing, max_files_per_trigger=1)
        intake.start_webhook_ingest(stream, store, SECRET, "hooks", checkpoint).awaitTermination()

    run()
    run()  # nothing new
    assert rows(store.read("optimized_events"), "delivery_id", "organization_name") == [("a", "o")]
    assert rows(store.read("webhook_rejects"), "delivery_id", "status_code") == [("bad", 401), ("empty", 400)]
    assert rows(store.read("dead_letters"), "delivery_id", "payload") == [("list", "[1]")]

    land(spark, landing, webhook("b", body), webhook("c", body))
    run()
    assert rows(store.read("optimized_events"), "delivery_id") == [("a",), ("b",), ("c",)]

    # Batch and stream agree.
    verdicts = ingest.validate_webhooks(read_raw_webhooks(spark, landing), SECRET)
    batch = ingest.enrich_events(ingest.accepted_events(verdicts))
    columns = ("delivery_id", "event", "payload", *ingest.IDENTITY_COLUMNS)
    assert rows(store.read("optimized_events"), *columns) == rows(batch, *columns)


def test_replayed_batch_adds_nothing(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, landing, webhook("a", b"{}"), webhook("bad", b"{}", b"x"))
    raw = read_raw_webhooks(spark, landing)
    for _ in range(2):
        intake.write_webhooks(store, raw, SECRET, "hooks-7")
    assert store.read("optimized_events").count() == 1
    assert store.read("webhook_rejects").count() == 1


def test_messages(spark, store, tmp_path):
    def envelope(delivery, payload):
        fields = {
            "delivery_id": delivery, "event": "push", "payload": payload,
            "received": "2024-01-01T10:00:00.123456789Z",
        }
        data = base64.b64encode(json.dumps(fields).encode()).decode()
        return json.dumps({"message": {"data": data, "messageId": "1"}, "subscription": "s"})

    lines = [envelope("a", "{}"), envelope("b", "[]"), '{"message": ', '{"message": {"data": "###"}}']
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "part.txt").write_text("\n".join(lines))
    assert read_messages(spark, str(folder)).count() == 4
    stream = stream_messages(spark, str(folder))
    query = intake.start_message_relay(stream, store, "relay", str(tmp_path / "checkpoint"))
    query.awaitTermination()
    stored = store.read("optimized_events").selectExpr(
        "delivery_id", "date_format(received, 'HH:mm:ss.SSSSSS')"
    )
    assert rows(stored) == [("a", "10:00:00.123456")]
    assert rows(store.read("dead_letters"), "payload") == [
        ("[]",), ('{"message": ',), ('{"message": {"data": "###"}}',)
    ]


def test_repeated_deliveries_are_stored_once(spark, store, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def run():
        stream = stream_raw_webhooks(spark, landing, max_files_per_trigger=1)
        intake.start_webhook_ingest(
            stream, store, SECRET, "hooks", checkpoint, duplicates_within="3 days"
        ).awaitTermination()

    # A bad one under the id of a later good one must not keep that one out.
    land(spark, landing, webhook("b", b"{}", b"x"), webhook("a", b"{}"), webhook("a", b"{}"))
    run()
    land(spark, landing, webhook("a", b'{"again": 1}'), webhook("b", b"{}"))
    land(spark, landing, webhook(None, b"{}"), webhook(None, b'{"n": 1}'))
    run()
    land(spark, landing, webhook("b", b"{}"), webhook("c", b"{}"), webhook("b", b"{}", b"x"))
    run()
    stored = rows(store.read("optimized_events"), "delivery_id", "payload")
    assert stored == sorted([("a", "{}"), ("b", "{}"), ("c", "{}"), (None, "{}"), (None, '{"n": 1}')], key=repr)
    assert rows(store.read("webhook_rejects"), "delivery_id", "status_code") == [("b", 401)]
    # Without the state every copy counts.
    stream = stream_raw_webhooks(spark, landing)
    intake.start_webhook_ingest(stream, store, SECRET, "plain", str(tmp_path / "other")).awaitTermination()
    assert store.read("optimized_events").count() == 5 + 8


def test_the_relay_publishes_each_stored_event_once(spark, store, tmp_path):
    def envelope(delivery, payload, event="push"):
        fields = {"delivery_id": delivery, "event": event, "payload": payload, "received": "2024-01-01T10:00:00Z"}
        return json.dumps({"message": {"data": base64.b64encode(json.dumps(fields).encode()).decode()}})

    body = json.dumps({"organization": {"id": 7, "login": "o"}, "repository": {"id": 8, "full_name": "o/r"}})
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "one.txt").write_text("\n".join([envelope("a", body), envelope("bad", "[]")]))

    def run():
        stream = stream_messages(spark, str(folder))
        intake.start_message_relay(
            stream, store, "relay", str(tmp_path / "checkpoint"), duplicates_within="1 day"
        ).awaitTermination()

    run()
    (folder / "two.txt").write_text("\n".join([envelope("a", body), envelope("b", "{}", "issues")]))
    run()
    out = {r["delivery_id"]: r for r in store.read("relay_outbox").collect()}
    assert sorted(out) == ["a", "b"] and store.read("relay_outbox").count() == 2
    assert out["a"]["attributes"] == {
        "enterprise_id": "", "enterprise_name": "", "organization_id": "7", "organization_name": "o",
        "repository_id": "8", "repository_name": "o/r", "event": "push",
    }
    value = json.loads(out["a"]["value"])
    assert value["payload"] == body and value["organization_name"] == "o" and "enterprise_id" not in value
    assert out["b"]["attributes"]["event"] == "issues"
    # What was published is what the table holds.
    again = ingest.outgoing_messages(store.read("optimized_events"))
    assert rows(again, "delivery_id", "value") == rows(store.read("relay_outbox"), "delivery_id", "value")
    assert store.read("dead_letters").count() == 1
