"""Webhook intake: signature check, envelope decoding, enrichment, failure routing.

All but ``route_failed_writes`` and ``failure_counts`` are narrow projections
and run unchanged on a batch or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.payload import (
    is_json_object,
    variant_id,
    variant_is_object,
    variant_kind,
    variant_text,
)
from devmetrics.functions.signature import webhook_signature
from devmetrics.functions.time import Instant, instant
from devmetrics.plans.skew import one_row_per_key

EVENT_COLUMNS = ["delivery_id", "signature", "received", "event", "payload"]
IDENTITY_COLUMNS = [
    "enterprise_id", "enterprise_name",
    "organization_id", "organization_name",
    "repository_id", "repository_name",
]

# Response codes, reject reasons, routes.
CREATED, BAD_REQUEST, UNAUTHORIZED, SERVER_ERROR = 201, 400, 401, 500
NO_PAYLOAD = "no payload received"
BAD_SIGNATURE = "failed to validate webhook signature"
DLQ, RECORD, UNRECORDED = "DLQ", "RECORD", "UNRECORDED"


def validate_webhooks(raw: DataFrame, secret: bytes, max_bytes: int | None = None) -> DataFrame:
    """``raw`` (delivery_id, signature, received, event, body BINARY) with its verdict.

    Adds ``status_code``, ``reason`` (NULL if accepted) and the text ``payload``.
    A listener that reads ``max_bytes`` of a body at most rejects longer ones as
    unsigned; give its limit to get the same verdicts. By default there is none.
    """
    body = F.coalesce(F.col("body"), F.lit(b""))
    expected = webhook_signature(secret, body)
    signed = F.coalesce(F.col("signature") == expected, F.lit(False))
    oversized = F.lit(False) if max_bytes is None else F.octet_length(body) > max_bytes
    code = (
        F.when(F.octet_length(body) == 0, BAD_REQUEST)
        .when(oversized | ~signed, UNAUTHORIZED)
        .otherwise(CREATED)
    )
    verdicts = raw.select(
        "delivery_id", "signature", "received", "event",
        F.make_valid_utf8(body.cast("string")).alias("payload"),
        # Behind a generator, so that a filter on the code does not hash the body again.
        F.explode(F.array(code)).alias("status_code"),
    )
    reason = F.when(F.col("status_code") == BAD_REQUEST, NO_PAYLOAD).when(
        F.col("status_code") == UNAUTHORIZED, BAD_SIGNATURE
    )
    return verdicts.withColumn("reason", reason)


def accepted_events(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col("status_code") == CREATED).select(*EVENT_COLUMNS)


def rejected_webhooks(verdicts: DataFrame) -> DataFrame:
    """What was not accepted, with its payload, so that nothing is lost."""
    return verdicts.filter(F.col("status_code") != CREATED)


def unwrap_messages(messages: DataFrame, column: str = "message") -> DataFrame:
    """Event columns inside push envelopes, plus the flag ``decoded``.

    The envelope is JSON text with the event as base64 JSON in
    ``message.data``. Anything broken on the way, or an event field that is
    not a string, leaves ``decoded`` false; such rows belong in the dead letters.
    """
    envelope = messages.select("*", F.try_parse_json(column).alias("_envelope"))
    data = F.try_variant_get("_envelope", "$.message.data", "string")
    text = F.make_valid_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))
    inner = envelope.select(
        *messages.columns,
        F.explode(F.array(F.try_parse_json(text))).alias("_event"),
    )
    event = F.col("_event")
    usable = variant_is_object(event, "$")
    for name in EVENT_COLUMNS:
        kind = variant_kind(event, f"$.{name}")
        usable = usable & (kind.isNull() | kind.isin("STRING", "VOID"))
    fields = [F.try_variant_get(event, f"$.{name}", "string").alias(name) for name in EVENT_COLUMNS]
    return inner.select(*messages.columns, *fields, usable.alias("decoded"))


def with_identity(events: DataFrame) -> DataFrame:
    """``events`` plus the six identity columns and the flag ``decodable``.

    Ids must be JSON numbers and names JSON strings, else they stay NULL. The
    organization falls back to the installation's account, but only if the
    payload has no organization object at all and the account is one. A
    payload must be a JSON object (or the literal null) to be decodable.
    """
    parsed = events.select(
        *events.columns, F.explode(F.array(F.try_parse_json("payload"))).alias("_v")
    )
    v = F.col("_v")
    own_org = variant_is_object(v, "$.organization")
    account_org = F.coalesce(
        variant_text(v, "$.installation.account.type") == "Organization", F.lit(False)
    )

    def organization(read, own: str, fallback: str) -> Column:
        return F.when(own_org, read(v, own)).when(account_org, read(v, fallback))

    decodable = is_json_object(F.col("payload"), v) | F.is_variant_null(v)
    return parsed.select(
        *events.columns,
        variant_id(v, "$.enterprise.id").alias("enterprise_id"),
        variant_text(v, "$.enterprise.name").alias("enterprise_name"),
        organization(variant_id, "$.organization.id", "$.installation.account.id").alias(
            "organization_id"
        ),
        organization(variant_text, "$.organization.login", "$.installation.account.login").alias(
            "organization_name"
        ),
        variant_id(v, "$.repository.id").alias("repository_id"),
        variant_text(v, "$.repository.full_name").alias("repository_name"),
        F.coalesce(decodable, F.lit(False)).alias("decodable"),
    )


def enrich_events(events: DataFrame) -> DataFrame:
    """Decodable events with enterprise, organization and repository ids and names."""
    return with_identity(events).filter("decodable").drop("decodable")


def undecodable_events(events: DataFrame) -> DataFrame:
    """Events whose payload is no JSON object, for the dead letters."""
    return with_identity(events).filter("NOT decodable").select(*events.columns)


def message_attributes(enriched: DataFrame) -> DataFrame:
    """``enriched`` plus the ``attributes`` map used for routing; missing values are ''."""
    names = [*IDENTITY_COLUMNS, "event"]
    pairs = [part for n in names for part in (F.lit(n), F.coalesce(n, F.lit("")))]
    return enriched.withColumn("attributes", F.create_map(*pairs))


def event_json(
    events: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``keep`` plus ``columns`` (all) of each event as one JSON text ``value``, without empty fields."""
    names = columns or events.columns
    fields = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in names]
    return events.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def outgoing_messages(enriched: DataFrame) -> DataFrame:
    """What the relay publishes for each event: its JSON text and the attributes to route it by."""
    return event_json(
        message_attributes(enriched),
        [*EVENT_COLUMNS, *IDENTITY_COLUMNS],
        keep=("delivery_id", "received", "attributes"),
    )


def failure_counts(failure_events: DataFrame, limit: int) -> DataFrame:
    """delivery_id, failures and whether they reach the retry limit."""
    counted = one_row_per_key(
        failure_events.filter(F.col("delivery_id").isNotNull()),
        ["delivery_id"],
        F.count(F.lit(1)).alias("failures"),
    )
    return counted.withColumn("exceeds_limit", F.col("failures") >= limit)


def route_failed_writes(
    failed: DataFrame, failure_events: DataFrame | None, limit: int
) -> DataFrame:
    """``failed`` plus where each row goes: the dead letters, or one more failure record.

    Failures recorded before this batch decide. ``failed`` may carry a BOOLEAN
    ``dlq_ok`` that tells whether the dead-letter write worked. Without
    ``failure_events`` (the count is unavailable) nothing is recorded.
    """
    kept = [c for c in failed.columns if c != "dlq_ok"]
    if failure_events is None:
        return failed.select(
            *kept,
            F.lit(None).cast("bigint").alias("failures"),
            F.lit(UNRECORDED).alias("route"),
            F.lit(SERVER_ERROR).alias("response_code"),
        )
    counts = failure_counts(failure_events, limit).select("delivery_id", "failures")
    failures = F.coalesce("failures", F.lit(0).cast("bigint"))
    route = F.when(failures >= limit, DLQ).otherwise(RECORD)
    dlq_ok = F.coalesce("dlq_ok", F.lit(True)) if "dlq_ok" in failed.columns else F.lit(True)
    return failed.join(counts, "delivery_id", "left").select(
        *kept,
        failures.alias("failures"),
        route.alias("route"),
        F.when((route == DLQ) & dlq_ok, CREATED).otherwise(SERVER_ERROR).alias("response_code"),
    )


def failure_records(routes: DataFrame, now: Instant) -> DataFrame:
    """Rows to append to ``failure_events``, timed to the second."""
    return routes.filter(F.col("route") == RECORD).select(
        "delivery_id", F.date_trunc("SECOND", instant(now)).alias("created")
    )
