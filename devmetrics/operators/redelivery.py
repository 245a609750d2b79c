"""Finding failed deliveries in the host's delivery log and reconciling their redelivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.time import Instant, instant
from devmetrics.plans.skew import one_row_per_key

# The host stored as an empty domain, and outcome names.
DEFAULT_DOMAIN = "github.com"
ACCEPTED_OUTCOMES = ["ok", "accepted"]
REDELIVERED, ALREADY_PRESENT, FATAL, PENDING = (
    "REDELIVERED", "ALREADY_PRESENT", "FATAL", "PENDING",
)


def read_checkpoint(checkpoints: DataFrame, domain: str = DEFAULT_DOMAIN) -> DataFrame:
    """``delivery_id`` of the domain's latest checkpoint, by number; no row if it has none."""
    url = F.col("github_instance_url")
    mine = url.isNull() | (url == "") if domain == DEFAULT_DOMAIN else url == domain
    latest = checkpoints.filter(mine).agg(
        F.max_by("delivery_id", F.col("delivery_id").cast("bigint")).alias("delivery_id")
    )
    return latest.filter(F.col("delivery_id").isNotNull())


def latest_checkpoints(checkpoints: DataFrame) -> DataFrame:
    """The latest checkpoint of every domain at once; the default domain is ''."""
    domain = F.coalesce("github_instance_url", F.lit("")).alias("domain")
    number = F.col("delivery_id").cast("bigint")
    return checkpoints.groupBy(domain).agg(F.max_by("delivery_id", number).alias("delivery_id"))


def write_checkpoint(deliveries: DataFrame, now: Instant, domain: str = DEFAULT_DOMAIN) -> DataFrame:
    """The next checkpoint row: the newest delivery in the log; no row for an empty log.

    It moves past failures on purpose, also past those not redelivered in time.
    """
    newest = deliveries.agg(F.max("id").alias("id")).filter(F.col("id").isNotNull())
    stored = "" if domain == DEFAULT_DOMAIN else domain
    return newest.select(
        F.col("id").cast("string").alias("delivery_id"),
        F.date_trunc("SECOND", instant(now)).alias("created"),
        F.lit(stored).alias("github_instance_url"),
    )


def since_checkpoint(deliveries: DataFrame, checkpoint_id: str | int | None) -> DataFrame:
    """Log entries newer than the checkpoint entry; the whole log if it holds no such entry."""
    if checkpoint_id in (None, ""):
        return deliveries
    checkpoint = F.lit(int(checkpoint_id)).cast("bigint")
    in_log = (
        deliveries.filter(F.col("id") == checkpoint).agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    )
    return deliveries.filter((F.col("id") > checkpoint) | ~in_log)


def is_failed() -> Column:
    """No answer code counts as a failure too."""
    return ~F.coalesce(F.col("status_code").between(200, 299), F.lit(False))


def failed_deliveries(
    deliveries: DataFrame, checkpoint_id: str | int | None = None
) -> DataFrame:
    """``id, guid`` of deliveries since the checkpoint that got no 2xx answer, newest first."""
    recent = since_checkpoint(deliveries, checkpoint_id)
    return recent.filter(is_failed()).select("id", "guid").orderBy(F.desc("id"))


def present_deliveries(failed: DataFrame, events: DataFrame) -> DataFrame:
    """The distinct guids of ``failed`` that the event table holds.

    An inner join of two key columns, so the (short) list of failures can be
    the broadcast side whenever its measured size allows; the event table is
    then never shuffled.
    """
    guids = one_row_per_key(failed.filter(F.col("guid").isNotNull()), ["guid"])
    stored = events.select(F.col("delivery_id").alias("guid"))
    return one_row_per_key(stored.join(guids, "guid"), ["guid"])


def delivery_exists(failed: DataFrame, events: DataFrame) -> DataFrame:
    """``failed`` plus BOOLEAN ``exists``."""
    present = present_deliveries(failed, events).withColumn("exists", F.lit(True))
    return failed.join(present, "guid", "left").select(
        *failed.columns, F.coalesce("exists", F.lit(False)).alias("exists")
    )


def reconcile_redeliveries(
    failed: DataFrame, outcomes: DataFrame, events: DataFrame
) -> DataFrame:
    """``id, guid, result`` for every failed delivery.

    ``outcomes`` (id, outcome) holds one row per redelivery tried: ``ok``,
    ``accepted`` or an error text. An error counts as delivered if the event
    arrived anyway, else it is fatal. Without an outcome the entry is pending.
    """
    accepted = F.col("outcome").isin(ACCEPTED_OUTCOMES)
    tried = one_row_per_key(
        outcomes, ["id"], F.bool_or(F.coalesce(accepted, F.lit(False))).alias("accepted")
    )
    checked = delivery_exists(failed, events).join(tried, "id", "left")
    result = (
        F.when(F.col("accepted").isNull(), PENDING)
        .when(F.col("accepted"), REDELIVERED)
        .when(F.col("exists"), ALREADY_PRESENT)
        .otherwise(FATAL)
    )
    return checked.select("id", "guid", result.alias("result"))


def redelivery_summary(
    deliveries: DataFrame, reconciled: DataFrame, checkpoint_id: str | int | None = None
) -> DataFrame:
    """One row of run counters: entries seen, failed, redelivered, fatal.

    The entry that equals the checkpoint is read before the scan stops, so it
    counts as seen.
    """
    seen = deliveries
    if checkpoint_id not in (None, ""):
        checkpoint = F.lit(int(checkpoint_id)).cast("bigint")
        seen = since_checkpoint(deliveries, checkpoint_id).unionByName(
            deliveries.filter(F.col("id") == checkpoint)
        )
    total = seen.agg(F.count(F.lit(1)).alias("n")).scalar()
    delivered = F.col("result").isin(REDELIVERED, ALREADY_PRESENT)
    return reconciled.agg(
        F.count(F.lit(1)).alias("failed_event_count"),
        F.count_if(delivered).alias("redelivered_event_count"),
        F.count_if(F.col("result") == FATAL).alias("fatal_event_count"),
    ).select(
        total.alias("total_event_count"),
        "failed_event_count",
        "redelivered_event_count",
        "fatal_event_count",
    )
