"""Exact top-k by inner product over an impact-ordered index, score at a time.

A posting is one component of one vector; its impact is the component's size,
quantised to powers of two. Vectors are spread over shards; in a shard all
postings of one impact form a segment. For a block of queries the segments are
processed by descending impact: each adds its exact contributions to the
accumulators. What a vector can still gain is bounded by the norm of its
postings that are not processed yet times the norm of the query. Processing
stops when that proves enough: when few enough vectors can still belong to the
best ``k``. Those are scored again, exactly, in whole numbers. The number of
such vectors is not capped: without proof all segments are processed.

Since embeddings are dense, a segment is kept as a matrix that is zero where
other segments have their postings.

Queries pass through each shard in blocks after its index, in one sorted
stream, so a task holds one shard and one block of queries.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component take no part, neither as query nor as candidate. A shorter vector
counts as filled up with zeros. Rows with equal ids are all candidates; of
queries with one id, each row asks for itself, under ranks of their own only if
the rows differ. A null id is a candidate but never a query. Scores beyond 64
bits stop at the largest one. An empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace, importable

SCALE = 256
K = 5
# Vectors per shard and queries per block, about.
SHARD = 16_384
BLOCK = 256
# Processing goes on while more candidates than this per query are possible.
ENOUGH = 64

# Up to here a component is exact in the arithmetic of the accumulators.
_EXACT = 1 << 20
_LONG = (1 << 63) - 1


def quantised(vector: Column) -> Column:
    """``floor(SCALE * x)`` of each component as double; null where the vector takes no part."""
    wide = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when((F.size(vector) > 0) & ~F.coalesce(odd, F.lit(False)), wide)


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.float64)
    width = width or (int(lengths.max()) if len(lengths) else 0)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = place < width
    out[row[inside], place[inside]] = flat[inside]
    return out


class Shard:
    """The index of some vectors: segments by descending impact, and the norms of what is left after each."""

    def __init__(self, ids: np.ndarray, has_id: np.ndarray, rows: np.ndarray, vectors: np.ndarray):
        self.ids, self.has_id, self.rows, self.vectors = ids, has_id, rows, vectors
        size = np.abs(vectors)
        impact = np.where(size > 0, np.frexp(size)[1], -1)
        self.segments: list[np.ndarray] = []
        self.left: list[np.ndarray] = []
        rest = vectors
        # Impacts that few postings have are processed with the next one.
        levels = sorted(set(impact[impact >= 0].tolist()), reverse=True)
        total, taken, low = max(1, int((impact >= 0).sum())), 0, None
        for level in levels:
            taken += int((impact == level).sum())
            low = level
            if taken * 4 >= total or level == levels[-1]:
                segment = np.where(impact >= low, rest, 0.0)
                rest = rest - segment
                self.segments.append(segment)
                self.left.append(np.sqrt((rest**2).sum(axis=1)))
                impact = np.where(impact >= low, -1, impact)
                taken = 0

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """(query, vectors, scores) of the best ``k`` of each query; ``own`` are the queries' row numbers."""
        n = len(self.ids)
        norms = np.sqrt((queries**2).sum(axis=1))
        scores = np.zeros((len(queries), n))
        self_match = own[:, None] == self.rows[None, :]
        possible = ~self_match
        for segment, left in zip(self.segments, self.left):
            scores += queries @ segment.T
            # Rounding of the norms is far below the slack that 1 adds.
            slack = norms[:, None] * left[None, :] * (1 + 1e-9) + (1 if left.any() else 0)
            low = np.where(self_match, -np.inf, scores - slack)
            if n > k:
                floor = np.partition(low, n - k, axis=1)[:, n - k]
                possible = ~self_match & (scores + slack >= floor[:, None])
            if possible.sum() <= ENOUGH * len(queries):
                break
        small = not len(self.vectors) or max(np.abs(self.vectors).max(initial=0), np.abs(queries).max(initial=0)) <= _EXACT
        whole = self.vectors.astype(np.int64) if small else None
        for q in range(len(queries)):
            at = np.flatnonzero(possible[q])
            if small:
                exact = (whole[at] @ queries[q].astype(np.int64)).tolist()
            else:
                a = [int(x) for x in queries[q]]
                exact = [sum(x * int(y) for x, y in zip(a, self.vectors[i])) for i in at]
                exact = [max(-_LONG - 1, min(_LONG, x)) for x in exact]
            order = sorted(range(len(at)), key=lambda i: (-exact[i], not self.has_id[at[i]], self.ids[at[i]]))[:k]
            yield q, at[order], [exact[i] for i in order]


_OUT = pa.schema([
    ("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
])


def _searched(k: int):
    """Streams of (shard, is_query, id, row, vector): the vectors of a shard, then its queries."""

    def answers(shard: Shard, ids: list, rows: list, vectors: list) -> pa.RecordBatch:
        own = np.array(rows, np.int64)
        width = shard.vectors.shape[1]
        made = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            m = min(width, len(v))
            made[i, :m] = v[:m]
        out: list[tuple] = []
        for q, at, scores in shard.best(made, own, k):
            for i, score in zip(at.tolist(), scores):
                out.append((rows[q], ids[q], int(shard.ids[i]) if shard.has_id[i] else None, score))
        columns = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _OUT)], schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, shard = None, None
        parts: list[tuple] = []
        pending: tuple[list, list, list] = ([], [], [])

        def built() -> Shard | None:
            if not parts:
                return None
            width = max(len(v) for _, _, _, v in parts)
            made = np.zeros((len(parts), width))
            for i, (_, _, _, v) in enumerate(parts):
                made[i, : len(v)] = v
            ids = np.array([0 if x[0] is None else x[0] for x in parts], np.int64)
            return Shard(ids, np.array([x[0] is not None for x in parts]), np.array([x[1] for x in parts]), made)

        for table in batches:
            keys = table.column(0).to_pylist()
            asks = table.column(1).to_pylist()
            ids, rows = table.column(2).to_pylist(), table.column(3).to_pylist()
            offsets = np.asarray(table.column(4).offsets)
            flat = np.asarray(table.column(4).flatten(), np.float64)
            base = offsets[0] if len(offsets) else 0
            for i, key in enumerate(keys):
                vector = flat[offsets[i] - base : offsets[i + 1] - base]
                if key != current:
                    if pending[0] and shard is not None:
                        yield answers(shard, *pending)
                    current, shard, parts, pending = key, None, [], ([], [], [])
                if not asks[i]:
                    parts.append((ids[i], rows[i], None, vector))
                    continue
                if shard is None:
                    shard = built()
                if shard is None:
                    continue
                for kept, value in zip(pending, (ids[i], rows[i], vector)):
                    kept.append(value)
                if len(pending[0]) >= BLOCK:
                    yield answers(shard, *pending)
                    pending = ([], [], [])
        if pending[0] and shard is not None:
            yield answers(shard, *pending)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard: int = SHARD,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best other rows of each query.

    ``is_query`` is a condition over the columns of ``vectors``. Ties go to the
    smaller id.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"),
        quantised(F.col(embedding)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"),
    ).filter("vector IS NOT NULL")
    rows = Workspace(spark).write(rows, "vectors")
    shards = max(1, -(-rows.count() // shard))
    home = F.pmod(F.xxhash64("id", "row"), F.lit(shards)).cast("int")
    stored = rows.select(home.alias("shard"), F.lit(False).alias("asks"), "id", "row", "vector")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = rows.filter(F.col("asks") & F.col("id").isNotNull())
    asked = asked.select(every.alias("shard"), F.lit(True).alias("asks"), "id", "row", "vector")
    stream = stored.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "asks", "row")
    found = stream.mapInArrow(_searched(k), "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
