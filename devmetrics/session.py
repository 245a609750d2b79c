"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Payload and table times are UTC instants.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next step then needs a shuffle of its
    # own: that shuffle is spread evenly, an unsplit hot key is not.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method of more than 8000 bytes. Fused stages above
    # that run interpreted and lose to the same operators unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A repeated JSON key keeps its last value instead of failing the payload.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
