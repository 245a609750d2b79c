"""High-watermark loads: take only the rows newer than what a target holds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.schemas import PARTITION_COLUMN

# Fixed value: where a load into an empty target starts.
EPOCH = "2015-01-01 00:00:00 UTC"


def newest_day(target: DataFrame) -> DataFrame:
    """The rows of the newest day partition; all of them without a partition column.

    The day is a scalar subquery over the partition column alone, so the scan
    that follows has a partition filter.
    """
    if PARTITION_COLUMN not in target.columns:
        return target
    return target.filter(F.col(PARTITION_COLUMN) == target.agg(F.max(PARTITION_COLUMN)).scalar())


def watermark(target: DataFrame, time_column: str, by_day: bool = False) -> Column:
    """Newest ``time_column`` of the target as a scalar subquery, EPOCH if it holds none.

    ``by_day`` looks at the newest day partition only, which is right where the
    partition day is the day of ``time_column``.
    """
    start = F.lit(EPOCH).cast("timestamp")
    if by_day:
        target = newest_day(target)
    return target.agg(F.coalesce(F.max(time_column), start)).scalar()


def read_watermark(target: DataFrame, time_column: str) -> dt.datetime | None:
    """The same value read now (one row), for jobs that want a literal in the scan filter."""
    return target.agg(F.max(F.col(time_column).cast("timestamp"))).first()[0]


def on_or_after_day(df: DataFrame, instant: Column) -> DataFrame:
    """Prune day partitions older than ``instant``; no-op without a partition column."""
    if PARTITION_COLUMN not in df.columns:
        return df
    return df.filter(F.col(PARTITION_COLUMN) >= F.to_date(instant))


def newer_than(df: DataFrame, time_column: str, instant: Column, prune: bool = False) -> DataFrame:
    """Rows strictly newer than ``instant``; rows at or before it are skipped for good.

    ``prune`` also drops older day partitions, which is right only where the
    partition day is the day of ``time_column``.
    """
    if prune:
        df = on_or_after_day(df, instant)
    return df.filter(F.col(time_column) > instant)


def incremental_rows(
    df: DataFrame, target: DataFrame, source_time: str, target_time: str | None = None
) -> DataFrame:
    """Rows of ``df`` newer than the newest row of ``target``, ready to append."""
    return newer_than(df, source_time, watermark(target, target_time or source_time))
