import base64
import hashlib
import hmac
import json

import pytest
from helpers import event, events, final_plan, rows, ts
from pyspark.sql import functions as F

from devmetrics.functions.payload import field, json_scalar, parse_payload, payload_ddl
from devmetrics.functions.signature import hmac_sha256_hex
from devmetrics.operators import ingest
from devmetrics.plans import jobs
from devmetrics.sources.webhooks import from_requests

SECRET = b"test-github-webhook-secret"
RAW_DDL = "delivery_id string, event string, signature string, received timestamp, body binary"


def sign(body, secret=SECRET):
    return "sha256=" + hmac.new(secret, body, hashlib.sha256).hexdigest()


@pytest.mark.parametrize("key", [b"", b"k", b"x" * 64, b"y" * 65, b"\x00\xff" * 80])
def test_hmac_equals_the_standard_library(spark, key):
    bodies = [b"", b"a", b"\x00\xff\xfe", "grüße".encode(), b"z" * 1000]
    df = spark.createDataFrame([(b,) for b in bodies], "body binary")
    got = {bytes(r[0]): r[1] for r in df.select("body", hmac_sha256_hex(key, F.col("body"))).collect()}
    assert got == {b: hmac.new(key, b, hashlib.sha256).hexdigest() for b in bodies}


def webhooks(spark, *items):
    return spark.createDataFrame(
        [(d, "push", s, ts("2024-01-01"), b) for d, s, b in items], RAW_DDL
    )


def test_verdicts(spark):
    body = b'{"a": 1}'
    raw = webhooks(
        spark,
        ("good", sign(body), body),
        ("wrong", sign(body, b"other"), body),
        ("upper", sign(body).upper(), body),
        ("unsigned", None, body),
        ("empty", sign(b""), b""),
        ("missing", None, None),
    )
    verdicts = ingest.validate_webhooks(raw, SECRET)
    bad = (401, "failed to validate webhook signature")
    none = (400, "no payload received")
    assert {r.delivery_id: (r.status_code, r.reason) for r in verdicts.collect()} == {
        "good": (201, None), "wrong": bad, "upper": bad, "unsigned": bad, "empty": none, "missing": none,
    }
    assert rows(ingest.accepted_events(verdicts), "delivery_id", "payload") == [("good", '{"a": 1}')]
    assert ingest.rejected_webhooks(verdicts).count() == 5


def test_only_a_given_limit_rejects_long_bodies(spark):
    raw = webhooks(spark, ("a", sign(b"1234"), b"1234"), ("b", sign(b"12345"), b"12345"))
    limited = ingest.validate_webhooks(raw, SECRET, max_bytes=4)
    assert rows(limited, "delivery_id", "status_code") == [("a", 201), ("b", 401)]
    assert rows(ingest.rejected_webhooks(limited), "delivery_id", "payload") == [("b", "12345")]
    assert rows(ingest.validate_webhooks(raw, SECRET), "status_code") == [(201,), (201,)]


def test_invalid_utf8_is_replaced(spark):
    body = b"\xff{}"
    verdicts = ingest.validate_webhooks(webhooks(spark, ("a", sign(body), body)), SECRET)
    assert rows(verdicts, "status_code", "payload") == [(201, "�{}")]


def test_filter_on_the_verdict_hashes_once(spark, tmp_path):
    webhooks(spark, ("a", sign(b"1"), b"1")).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = final_plan(ingest.accepted_events(ingest.validate_webhooks(raw, SECRET)))
    assert plan.count("sha2(") == 2  # inner and outer hash


def enriched(spark, payload):
    found = ingest.enrich_events(events(spark, event("push", payload)).select(*ingest.EVENT_COLUMNS))
    got = found.select(*ingest.IDENTITY_COLUMNS).collect()
    return tuple(got[0]) if got else None


ORG = {"id": 67890, "login": "org"}
ACCOUNT = {"account": {"type": "Organization", **ORG}}


@pytest.mark.parametrize(
    "payload, expected",
    [
        (
            {
                "repository": {"id": 12345, "full_name": "org/repo"},
                "organization": ORG,
                "enterprise": {"id": 11111, "name": "ent"},
            },
            ("11111", "ent", "67890", "org", "12345", "org/repo"),
        ),
        (
            {"installation": ACCOUNT, "repository": {"id": 12345, "full_name": "org/repo"}},
            (None, None, "67890", "org", "12345", "org/repo"),
        ),
        ({"organization": None, "installation": ACCOUNT}, (None, None, "67890", "org", None, None)),
        ({"organization": {}, "installation": ACCOUNT}, (None,) * 6),
        ({"organization": [1], "installation": ACCOUNT}, (None, None, "67890", "org", None, None)),
        (
            {"organization": {"id": 1, "login": "own"}, "installation": ACCOUNT},
            (None, None, "1", "own", None, None),
        ),
        ({"installation": {"account": {"type": "User", **ORG}}}, (None,) * 6),
        ({"installation": {"account": ORG}}, (None,) * 6),
        ({"installation": [ACCOUNT]}, (None,) * 6),
        ({"organization": {"id": "67890", "login": 5}}, (None,) * 6),
        ({"organization": {"id": 1.9, "login": ""}}, (None, None, "1", None, None, None)),
        ({"repository": {"id": 8294967296}}, (None, None, None, None, "8294967296", None)),
        ({"repository": {"id": 1e300}}, (None,) * 6),
        ({"enterprise": "x", "repository": True}, (None,) * 6),
        ("null", (None,) * 6),
        ('{"enterprise": {"name": "a"}, "enterprise": {"name": "b"}}', (None, "b", None, None, None, None)),
        ("[1, 2]", None),
        ('"text"', None),
        ("5", None),
        ("{", None),
        ("", None),
        (None, None),
    ],
)
def test_identity(spark, payload, expected):
    assert enriched(spark, payload) == expected


def test_undecodable_rows_are_kept_apart(spark):
    df = events(spark, event("push", {}, "a"), event("push", "{", "b"), event("push", None, "c"))
    df = df.select(*ingest.EVENT_COLUMNS)
    assert rows(ingest.undecodable_events(df), "delivery_id") == [("b",), ("c",)]
    assert rows(ingest.enrich_events(df), "delivery_id") == [("a",)]


def test_attributes_and_json(spark):
    df = events(spark, event("push", {"organization": ORG}, "a")).select(*ingest.EVENT_COLUMNS)
    enriched_events = ingest.enrich_events(df)
    assert ingest.message_attributes(enriched_events).collect()[0].attributes == {
        "enterprise_id": "", "enterprise_name": "", "organization_id": "67890",
        "organization_name": "org", "repository_id": "", "repository_name": "", "event": "push",
    }
    encoded = json.loads(ingest.event_json(enriched_events).collect()[0].value)
    assert set(encoded) == {
        "delivery_id", "received", "event", "payload", "organization_id", "organization_name"
    }


def envelope(event_fields, **changes):
    data = base64.b64encode(json.dumps(event_fields).encode()).decode()
    message = {"data": data, "messageId": "1", "attributes": {"x": "y"}, **changes}
    return json.dumps({"message": message, "subscription": "s"})


def test_unwrap(spark):
    good = {"delivery_id": "d", "signature": "s", "received": "r", "event": "push", "payload": '{"a": "ü"}'}
    messages = {
        "good": envelope(good),
        "partial": envelope({"delivery_id": "d", "event": None}),
        "typed": envelope({**good, "event": 5}),
        "list": envelope([1]),
        "base64": envelope(good, data="###"),
        "no data": json.dumps({"message": {}}),
        "cut": envelope(good)[:-5],
        "not json": base64.b64encode(b"nope").decode(),
    }
    df = spark.createDataFrame(list(messages.items()), "name string, message string")
    got = {r.name: r for r in ingest.unwrap_messages(df).collect()}
    assert {n for n, r in got.items() if r.decoded} == {"good", "partial"}
    assert (got["good"].payload, got["good"].event) == ('{"a": "ü"}', "push")
    assert got["partial"].payload is None
    assert len(got) == len(messages)


def failures(spark, **counts):
    data = [(d, ts("2024-01-01")) for d, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(data, "delivery_id string, created timestamp")


def test_routes(spark):
    failed = spark.createDataFrame(
        [("new", True), ("below", True), ("at", True), ("above", False), ("at", None)],
        "delivery_id string, dlq_ok boolean",
    )
    got = ingest.route_failed_writes(failed, failures(spark, below=1, at=2, above=3, other=9), 2)
    assert rows(got) == [
        ("above", 3, "DLQ", 500), ("at", 2, "DLQ", 201), ("at", 2, "DLQ", 201),
        ("below", 1, "RECORD", 500), ("new", 0, "RECORD", 500),
    ]
    records = ingest.failure_records(got, "2024-01-01 10:00:00.9 UTC")
    assert rows(records.selectExpr("delivery_id", "date_format(created, 'HH:mm:ss.S')")) == [
        ("below", "10:00:00.0"), ("new", "10:00:00.0")
    ]
    unknown = ingest.route_failed_writes(failed.select("delivery_id"), None, 2)
    assert {r[1:] for r in rows(unknown)} == {(None, "UNRECORDED", 500)}


def test_failed_writes_job(spark, store):
    failed = events(spark, event("push", {"a": 1}, "d")).select(*ingest.EVENT_COLUMNS)
    for attempt in range(3):
        jobs.record_failed_writes(store, failed, 2, f"2024-01-0{attempt + 1} 00:00:00 UTC")
    assert store.read("failure_events").count() == 2
    assert rows(store.read("dead_letters"), "delivery_id", "payload") == [("d", '{"a": 1}')]


def test_failure_counts(spark):
    got = ingest.failure_counts(failures(spark, a=1, b=2, c=3), 2)
    assert rows(got) == [("a", 1, False), ("b", 2, True), ("c", 3, True)]


def test_json_scalar(spark):
    text = '{"s": "x", "n": 5, "b": true, "z": null, "o": {"k": "v"}, "a": [1]}'
    df = spark.createDataFrame([(text,)], "payload string")
    paths = ["$.s", "$.n", "$.b", "$.z", "$.o", "$.a", "$.missing", "$.o.k"]
    got = df.select(*(json_scalar("payload", p).alias(p.strip("$.").replace(".", "_")) for p in paths))
    assert tuple(got.collect()[0]) == ("x", "5", "true", None, None, None, None, "v")
    broken = spark.createDataFrame([("{",)], "payload string")
    assert broken.select(json_scalar("payload", "$.s")).collect()[0][0] is None


def test_payload_ddl():
    assert payload_ddl("a", "b.c", "b.d.e", "f:array<int>") == (
        "a string, b struct<c:string,d:struct<e:string>>, f array<int>"
    )


def test_requests(spark):
    headers = {"x-github-delivery": "d", "X-GitHub-Event": "push", "X-HUB-SIGNATURE-256": "s"}
    df = spark.createDataFrame(
        [(headers, ts("2024-01-01"), b"{}")],
        "headers map<string,string>, received timestamp, body binary",
    )
    assert rows(from_requests(df), "delivery_id", "event", "signature") == [("d", "push", "s")]


def test_a_second_parse_runs_only_inside_a_branch(spark):
    df = spark.createDataFrame([('{"a": {"b": "x"}, "c": "{x"}',), ('{"a": {"b": {}}, "c": [1]}',)], "payload string")
    parsed = parse_payload(df, "a.b", "c").select(field("a.b").alias("b"), field("c").alias("c"))
    assert rows(parsed) == [("x", "{x"), (None, None)]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    # Nothing outside of CASE WHEN ... RLIKE may parse the payload again.
    for part in plan.split("try_parse_json")[:-1]:
        assert part.rindex("RLIKE") > part.rindex("CASE WHEN")


def test_scalars_inside_arrays(spark):
    body = '{"p": [{"id": 5, "s": "a"}, {"id": "6", "s": {"x": 1}}, {"id": [7], "s": "[b"}, {"s": null}, null, {"id": 1.5, "d": {"t": [1]}}]}'
    df = spark.createDataFrame([(body,), ('{"p": {}}',), ("{}",), (None,)], "payload string")
    parsed = parse_payload(df, "p:array<struct<id:string,s:string,d:struct<t:string>>>")
    items = parsed.filter(field("p").isNotNull()).selectExpr("posexplode(p.p) AS (i, x)").selectExpr("i", "x.id", "x.s", "x.d.t")
    assert rows(items) == [
        (0, "5", "a", None), (1, "6", None, None), (2, None, "[b", None), (3, None, None, None), (4, None, None, None), (5, "1.5", None, None),
    ]
    assert parsed.filter(field("p").isNotNull()).count() == 1
