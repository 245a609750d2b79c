"""A bitmap of keys, small whatever their number, that spares rows without a match a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import importable

# 8 MB. With very many keys all bits are set; then nothing is spared, and nothing lost.
SIZE = 1 << 26


def _place(key: Column) -> Column:
    return F.pmod(key, F.lit(SIZE))


class Bits:
    """The set bits of a BIGINT key; ``SIZE`` bits in the driver and in each task."""

    def __init__(self, keys: DataFrame, key: Column):
        importable(keys.sparkSession)
        at = _place(key)
        words = (
            keys.select(F.floor(at / 32).cast("int").alias("word"), F.pmod(at, F.lit(32)).cast("int").alias("bit"))
            .groupBy("word")
            .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
            .toArrow()
        )
        table = np.zeros(SIZE // 32, np.uint32)
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
        self.shared = keys.sparkSession.sparkContext.broadcast(table)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key (signed 64-bit) may be in the set; for use within a task."""
        at = keys % SIZE
        return (self.shared.value[at // 32] >> (at % 32).astype(np.uint32)) & 1 == 1

    def split(self, rows: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        """(rows whose key may be in the set, rows whose key is not)."""
        placed = rows.withColumn("__place", _place(key))
        shared = self.shared

        def part(wanted: bool) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                table = shared.value
                for batch in batches:
                    at = batch.column(batch.num_columns - 1).to_numpy()
                    hit = (table[at // 32] >> (at % 32).astype(np.uint32)) & 1
                    yield batch.filter(pa.array((hit == 1) == wanted)).select(batch.schema.names[:-1])

            return placed.mapInArrow(run, rows.schema)

        return part(True), part(False)
