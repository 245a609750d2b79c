"""Maximal periodic runs of words, found by uniting suffixes in the order of falling LCP.

A run is a stretch of consecutive words with smallest period q whose length is
at least ``min_length`` and ``min_exponent`` times q, and that no neighbouring
word extends keeping period q.

The suffixes of a document are sorted by prefix doubling, and every two
neighbours in that order are joined by an edge that weighs their longest common
prefix (LCP). Kruskal's walk takes the edges by falling weight and unites the
classes at their ends; a class keeps its positions in order, and the smaller one
moves into the larger. Positions that become neighbours in a class at weight l
have an LCP of exactly l. If they lie d <= l apart, the stretch from the first
one on has period d over d + l words and cannot go on to the right: a seed. The
seed that cannot go on to the left either is the run.

No run is lost: between the start of a run and the position one period later no
third position shares so long a prefix, or the period would not be the smallest;
so these two become neighbours, and for the same reason neighbours are never a
multiple of the period apart.

A document without a repeated stretch of ``weight_floor`` words has no edge that
can seed a run and skips the sorting. Batches are taken in portions; a document
is never split. Words are compared by 64-bit hashes.

Defined cases: a null, empty or blank text has no words and no runs, and its
collapsed text is empty. Texts are taken whole whatever their length. Rows are
independent, so equal and null document ids, repeated rows and ties need no
rule. Only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import importable
from devmetrics.llm.text import words
from devmetrics.llm.wordhash import Batch, mixed, runs

MIN_LENGTH = 6
MIN_EXPONENT = 4
# Bytes of text whose documents are taken together.
PORTION = 2 << 20

RUNS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def weight_floor(min_length: int, min_exponent: int) -> int:
    """The smallest LCP that can seed a run."""
    return max(1, min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1)))


def sorted_suffixes(codes: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... words, up to where no two are equal.

    Equal stretches have equal ranks, and a rank is the number of smaller
    suffixes, so only positions that are still tied are sorted again.
    """
    n = len(codes)
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    below = np.concatenate([[0], np.cumsum(counts)[:-1]])
    rank = below[inverse]
    levels = [rank.astype(np.int32)]
    tied = np.flatnonzero(counts[inverse] > 1)
    width = 1
    while len(tied):
        after = tied + width
        second = np.zeros(len(tied), np.int64)
        inside = after < n
        second[inside] = rank[after[inside]] + 1
        key = rank[tied] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key, at = key[order], tied[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], rank[at[1:]] != rank[at[:-1]]])
        here = np.arange(len(at))
        start = np.maximum.accumulate(np.where(new, here, 0))
        base = np.maximum.accumulate(np.where(group, here, 0))
        rank = rank.copy()
        rank[at] += start - base
        size = np.diff(np.concatenate([np.flatnonzero(new), [len(at)]]))
        tied = np.sort(at[np.repeat(size, size) > 1])
        levels.append(rank.astype(np.int32))
        width *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of words that the suffixes at ``x`` and ``y`` share."""
    n = len(levels[0])
    out = np.zeros(len(x), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = x + out, y + out
        inside = np.flatnonzero((a < n) & (b < n))
        same = levels[level][a[inside]] == levels[level][b[inside]]
        out[inside[same]] += 1 << level
    return out


def _meetings(large: list[int], small: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs (one from each, in order) that are neighbours once both are one ordered set."""
    last = len(small) - 1
    for k, s in enumerate(small):
        p = bisect_left(large, s)
        if p and (k == 0 or small[k - 1] < large[p - 1]):
            yield large[p - 1], s
        if p < len(large) and (k == last or small[k + 1] > large[p]):
            yield s, large[p]


def kruskal_seeds(x: list[int], y: list[int], weight: list[int]) -> list[tuple[int, int, int]]:
    """(first position, distance, LCP) of the neighbours at a distance within their LCP.

    The edges come by falling weight.
    """
    nodes = sorted({*x, *y})
    parent = {v: v for v in nodes}
    members = {v: [v] for v in nodes}
    seeds = []
    for a, b, w in zip(x, y, weight):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a == b:
            continue
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members.pop(b)
        for i, j in _meetings(large, small):
            if j - i <= w:
                seeds.append((i, j - i, w))
        if 32 * len(small) < len(large):
            for s in small:
                insort(large, s)
        else:
            large += small
            large.sort()
        parent[b] = a
    return seeds


def find_runs(
    hashes: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of documents that lie one behind the other, by start and period.

    ``first`` has the place of each document's first word and the end of the last.
    """
    none = np.empty(0, np.int64)
    floor = weight_floor(min_length, min_exponent)
    grams, doc = runs(hashes, first, floor)
    grams, doc = grams[doc >= 0], doc[doc >= 0]
    if not len(grams):
        return none, none, none
    order = np.lexsort((grams, doc))
    again = (grams[order[1:]] == grams[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    chosen = np.unique(doc[order[1:]][again])
    if not len(chosen):
        return none, none, none

    sizes = np.diff(first)[chosen]
    place = np.repeat(first[chosen] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    # A word means something else in each document, so no common prefix reaches over an end.
    salt = mixed(np.repeat(chosen.astype(np.uint64) + np.uint64(1), sizes))
    codes = mixed(hashes[place] + salt)
    levels = sorted_suffixes(codes)
    order = np.empty(len(codes), np.int64)
    order[levels[-1]] = np.arange(len(codes))
    x, y = order[:-1], order[1:]
    # Most neighbours differ within the first words already and need no exact count.
    near = levels[min(floor.bit_length() - 1, len(levels) - 1)]
    tied = near[x] == near[y]
    x, y = x[tied], y[tied]
    weight = common_prefixes(levels, x, y)
    kept = weight >= floor
    x, y, weight = x[kept], y[kept], weight[kept]
    falling = np.argsort(-weight, kind="stable")
    seeds = kruskal_seeds(x[falling].tolist(), y[falling].tolist(), weight[falling].tolist())
    if not seeds:
        return none, none, none
    start, period, prefix = np.array(seeds, np.int64).T
    length = period + prefix
    long_enough = length >= np.maximum(min_length, min_exponent * period)
    left_end = (start == 0) | (codes[start - 1] != codes[start + period - 1])
    start, length, period = (v[long_enough & left_end] for v in (start, length, period))
    start = place[start]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _portion(texts: pa.Array, doc_ids: pa.Array, min_length: int, min_exponent: int) -> pa.RecordBatch:
    batch = Batch(texts, lower=False)
    start, length, period = find_runs(batch.hash, batch.first, min_length, min_exponent)
    n = len(batch.hash)
    # How many runs drop each word: all of a run but its first period.
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)

    # Words and the gaps between them in turn; every second entry is a word.
    edges = np.empty(2 * n, np.int64)
    edges[0::2], edges[1::2] = batch.start, batch.end
    if n:
        spans = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(batch.data))]
        )
    else:
        spans = pa.array([], pa.large_binary())
    lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, batch.first)), spans.take(pa.array(2 * kept)))
    collapsed = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())

    owner = np.searchsorted(batch.first, start, "right") - 1
    entries = pa.StructArray.from_arrays(
        [pa.array(start - batch.first[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"]
    )
    found = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, batch.first).astype(np.int32)), entries)
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(batch.counts), found, collapsed.cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"]
    )


def periodic_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    portion: int = PORTION,
) -> DataFrame:
    """For each row its number of words, its runs by start and period, and the text without repetitions.

    ``collapsed`` leaves out every word that lies in a run behind the run's
    first period; the other words are joined by one space.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least once")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                done = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, done + portion, "right")))
                yield _portion(texts.slice(at, end - at), doc_ids.slice(at, end - at), min_length, min_exponent)
                at = end

    importable(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, RUNS)


def with_planted_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where about every tenth text repeats a stretch of its own words to its end.

    With h the CRC-32 of the decimal id and g = h / 10, texts with h % 10 = 0
    get at each word i >= a = g % n the word a + (i - a) % p, where
    p = 1 + (n - a) / (3 + g % 8); all divisions are whole.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    chosen = docs.withColumn("__words", F.when(h % 10 == 0, words(F.col(text)))).withColumn("__g", F.floor(h / 10))
    n = F.size("__words").cast("bigint")
    placed = chosen.withColumn("__a", F.when(n > 0, F.col("__g") % n)).withColumn(
        "__p", 1 + F.floor((n - F.col("__a")) / (3 + F.col("__g") % 8))
    )

    def word(x: Column, i: Column) -> Column:
        source = F.col("__a") + (i - F.col("__a")) % F.col("__p")
        return F.when(i >= F.col("__a"), F.get(F.col("__words"), source.cast("int"))).otherwise(x)

    planted = F.when(F.col("__a").isNotNull(), F.array_join(F.transform("__words", word), " ")).otherwise(F.col(text))
    return placed.withColumn(text, planted).drop("__words", "__g", "__a", "__p")


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each row of ``periodic_runs`` and digests of all its runs and its text."""
    ranked = F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("__best", F.array_max(ranked))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("__best.s")).alias("start"),
        F.col("__best.length").alias("length"),
        (-F.col("__best.p")).alias("period"),
        F.expr("1000 * __best.length div -__best.p").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
        "n_words",
    )
