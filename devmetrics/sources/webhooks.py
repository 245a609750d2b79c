"""Where webhooks and push messages come from: batch folders and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_WEBHOOK_DDL = (
    "delivery_id STRING, event STRING, signature STRING, received TIMESTAMP, body BINARY"
)

# Request headers that carry the delivery's identity.
DELIVERY_HEADER = "X-Github-Delivery"
EVENT_HEADER = "X-Github-Event"
SIGNATURE_HEADER = "X-Hub-Signature-256"


def read_raw_webhooks(spark: SparkSession, path: str) -> DataFrame:
    """Landed request bodies with their headers, as Parquet."""
    return spark.read.schema(RAW_WEBHOOK_DDL).parquet(path)


def stream_raw_webhooks(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same landing folder as a stream of new files."""
    reader = spark.readStream.schema(RAW_WEBHOOK_DDL)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def from_requests(requests: DataFrame) -> DataFrame:
    """Raw webhooks from recorded requests (headers MAP, received TIMESTAMP, body BINARY).

    Header names are matched without regard to case.
    """
    headers = F.map_from_entries(
        F.transform(
            F.map_entries("headers"),
            lambda h: F.struct(F.lower(h["key"]).alias("key"), h["value"].alias("value")),
        )
    )
    return requests.select(
        F.try_element_at(headers, F.lit(DELIVERY_HEADER.lower())).alias("delivery_id"),
        F.try_element_at(headers, F.lit(EVENT_HEADER.lower())).alias("event"),
        F.try_element_at(headers, F.lit(SIGNATURE_HEADER.lower())).alias("signature"),
        "received",
        "body",
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Push envelopes, one JSON text per line, in column ``message``."""
    return spark.read.text(path).withColumnRenamed("value", "message")


def stream_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path).withColumnRenamed("value", "message")
