"""Join shapes that stay balanced when one key holds a large share of the rows.

Spark's adaptive skew join splits a hot shuffle partition of the row-preserving
side, but only if each join input ends in an exchange made for that join. An
input that was just grouped by the same key has no such exchange. The helpers
here group by the key *and a fingerprint of it*: the result still has one row
per key, copies still collapse before the shuffle, and the join gets an
exchange of its own that the adaptive optimizer can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FINGERPRINT = "_fingerprint"

# Rows one generator step may hold in memory while copies are written out.
REPEAT_BLOCK = 10_000


def one_row_per_key(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """``df`` reduced to one row per key, ready for a skew-splittable join."""
    if not aggregates:
        return df.select(*keys, F.xxhash64(*keys).alias(_FINGERPRINT)).distinct().drop(_FINGERPRINT)
    return (
        df.groupBy(*keys, F.xxhash64(*keys).alias(_FINGERPRINT)).agg(*aggregates).drop(_FINGERPRINT)
    )


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Each row ``count`` times (at least 1), generated in blocks of bounded size."""
    last_block = F.expr(f"({count} - 1) div {REPEAT_BLOCK}")
    left = F.least(F.lit(REPEAT_BLOCK), F.col(count) - F.col("_block") * REPEAT_BLOCK)
    return (
        df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(True), left.cast("int"))))
        .drop("_block", "_copy", count)
    )
