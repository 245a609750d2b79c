"""Continuous intake: landed webhooks or push messages into the event table.

Each micro-batch is validated or decoded once and split over the event table,
the typed tables, the side tables and, for a relay, the outbox. A batch that is
replayed after a failure replaces its own rows (see ``TableStore.write_batch``),
so every batch is stored once.

A delivery may arrive more than once. With ``duplicates_within`` the stream keeps
the delivery ids of that time in its state store and drops repetitions, also over
restarts. The time counts from arrival, not from a field of the row, so no row is
ever too late: one that repeats later than that is stored again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from devmetrics.operators import ingest
from devmetrics.plans.typed import write_typed
from devmetrics.sources.tables import TableStore


def store_events(store: TableStore, enriched: DataFrame, batch: str, relay: bool = False) -> None:
    """Write events that carry their identity into the event table and the typed tables.

    ``relay`` also puts each as an outgoing message into the outbox.
    """
    store.write_batch("optimized_events", enriched, batch)
    write_typed(store, enriched, batch)
    if relay:
        store.write_batch("relay_outbox", ingest.outgoing_messages(enriched), batch)


def write_events(store: TableStore, events: DataFrame, batch: str) -> None:
    """Enrich ``events`` into the event table; undecodable ones go to the dead letters."""
    identified = ingest.with_identity(events).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store_events(store, identified.filter("decodable"), batch)
        store.write_batch("dead_letters", identified.filter("NOT decodable"), batch)
    finally:
        identified.unpersist()


def write_webhooks(store: TableStore, raw: DataFrame, secret: bytes, batch: str) -> None:
    """One batch of raw webhooks: accepted ones enriched and stored, rejected ones listed."""
    write_verdicts(store, ingest.validate_webhooks(raw, secret), batch)


def write_verdicts(store: TableStore, verdicts: DataFrame, batch: str) -> None:
    """One batch of validated webhooks; see ``write_webhooks``."""
    verdicts = verdicts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.write_batch("webhook_rejects", ingest.rejected_webhooks(verdicts), batch)
        write_events(store, ingest.accepted_events(verdicts), batch)
    finally:
        verdicts.unpersist()


def decoded_messages(messages: DataFrame) -> DataFrame:
    """Event columns of push envelopes and ``decoded``; what cannot be decoded has its message as payload."""
    return ingest.unwrap_messages(messages).select(
        "delivery_id",
        "signature",
        F.col("received").try_cast("timestamp").alias("received"),
        "event",
        F.when(F.col("decoded"), F.col("payload")).otherwise(F.col("message")).alias("payload"),
        "decoded",
    )


def write_messages(store: TableStore, messages: DataFrame, batch: str) -> None:
    """One batch of push envelopes; what cannot be decoded is kept whole as a dead letter."""
    write_decoded(store, decoded_messages(messages), batch)


def write_decoded(store: TableStore, events: DataFrame, batch: str) -> None:
    """One batch of decoded envelopes; see ``write_messages``."""
    identified = ingest.with_identity(events).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        usable = F.col("decoded") & F.col("decodable")
        store_events(store, identified.filter(usable), batch, relay=True)
        store.write_batch("dead_letters", identified.filter(~usable), batch)
    finally:
        identified.unpersist()


def once_per_delivery(rows: DataFrame, usable: Column, duplicates_within: str) -> DataFrame:
    """A stream without the ``usable`` rows whose delivery came before within that time.

    Other rows, and those without a delivery id, count as repeated only if the
    whole row is: nobody can keep a delivery out by sending a bad one under its id.
    """
    named = usable & F.col("delivery_id").isNotNull()
    fingerprint = F.when(~named, F.xxhash64("signature", "event", "payload"))
    keyed = rows.withColumns(
        {"_usable": usable, "_print": fingerprint, "_arrived": F.current_timestamp()}
    ).withWatermark("_arrived", duplicates_within)
    once = keyed.dropDuplicatesWithinWatermark(["delivery_id", "_usable", "_print"])
    return once.drop("_usable", "_print", "_arrived")


def _start(stream: DataFrame, write, name: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write(batch, f"{name}-{batch_id:012d}")

    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write_batch)
        .start()
    )


def start_webhook_ingest(
    raw: DataFrame,
    store: TableStore,
    secret: bytes,
    name: str,
    checkpoint: str,
    duplicates_within: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Run the intake of raw webhooks, by default over what has landed and then stop.

    ``name`` marks the batches of this query in the tables: a query that
    starts from a new checkpoint needs a new name.
    """
    verdicts = ingest.validate_webhooks(raw, secret)
    if duplicates_within is not None:
        accepted = F.col("status_code") == ingest.CREATED
        verdicts = once_per_delivery(verdicts, accepted, duplicates_within)

    def write(batch: DataFrame, key: str) -> None:
        write_verdicts(store, batch, key)

    return _start(verdicts, write, name, checkpoint, trigger or {"availableNow": True})


def start_message_relay(
    messages: DataFrame,
    store: TableStore,
    name: str,
    checkpoint: str,
    duplicates_within: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Run the intake of push envelopes; see ``start_webhook_ingest``.

    Every stored event also leaves as a message in ``relay_outbox``.
    """
    events = decoded_messages(messages)
    if duplicates_within is not None:
        events = once_per_delivery(events, F.col("decoded"), duplicates_within)

    def write(batch: DataFrame, key: str) -> None:
        write_decoded(store, batch, key)

    return _start(events, write, name, checkpoint, trigger or {"availableNow": True})
