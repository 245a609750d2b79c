"""Instants given as a column, a datetime or UTC text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = Column | dt.datetime | str


def instant(value: Instant) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp")
