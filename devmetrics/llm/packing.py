"""Best-fit packing of tokenised documents into sequences by the sum-of-squares rule.

A document longer than ``capacity`` is cut into full pieces, the first one
shorter; a full piece is a sequence of its own. What is shorter is packed: the
state is the number of open sequences for each residual gap, and a document
goes where the sum of the squares of these numbers becomes smallest. That keeps
gaps of all sizes in store and leaves little waste. What lies in sequences that
stay open is packed once more by itself, as long as that saves sequences.

The rule needs lengths only. Documents are spread over shards of some
``SHARD`` by a hash; each shard packs its own, longest first, in one task of
bounded size. The sequences that a shard leaves open are the documents of the
next level, packed by the same rule, until one shard holds all of them.

Token ids come once for each distinct word in a worker, not for each
occurrence: the tokenizer cuts a text at every space between two other
characters anyway, so words that such spaces separate are tokenised apart. A
text with white space in any other place is tokenised whole.

Defined cases: a null or empty text is the end id alone. Texts of any length
are tokenised whole. Rows with equal or null ids are packed one by one. An
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace, importable

CAPACITY = 1024
END_ID = 2
# Documents that one task packs, about.
SHARD = 65_536
# Words whose ids a worker remembers; beyond it starts anew.
REMEMBERED = 600_000

_GLUED = re.compile(r"\s\s")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Ids:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        (self.newline,) = self.encoding.encode_ordinary("\n")
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Remembers the ids of ``words``, each with a space before it."""
        if len(self.words) > REMEMBERED:
            self.words = {}
        new = words - self.words.keys()
        lines = [w for w in new if "\n" not in w]
        self.words.update((w, self.whole(" " + w)) for w in new.difference(lines))
        # One call for all: the tokenizer makes the line ends tokens of their own.
        ids = np.array(self.encoding.encode_ordinary("".join(f" {w}\n" for w in lines)), "<u4")
        ends = np.flatnonzero(ids == self.newline)
        blob, start = ids.tobytes(), 0
        for word, end in zip(lines, ends.tolist(), strict=True):
            self.words[word] = blob[4 * start : 4 * end]
            start = end + 1

    def of(self, texts: list[str | None]) -> list[bytes]:
        split = [
            None if not t or t[0].isspace() or t[-1].isspace() or _GLUED.search(t) else t.split(" ")
            for t in texts
        ]
        self.learn({w for words in split if words for w in words[1:]})
        return [
            self.whole(text or "")
            if words is None
            else self.whole(words[0]) + b"".join(map(self.words.__getitem__, words[1:]))
            for text, words in zip(texts, split)
        ]


def portions(texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` characters."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_IDS: dict[str, Ids] = {}


def ids_of(ranks_path: str) -> Ids:
    """The worker's tokenizer; it is built once and its words are remembered."""
    if ranks_path not in _IDS:
        _IDS[ranks_path] = Ids(ranks_path)
    return _IDS[ranks_path]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first one may be shorter than ``capacity``."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def tokenised(
    docs: DataFrame, ranks_path: str, doc_id: str, text: str, capacity: int, end_id: int, ids: bool
) -> DataFrame:
    end = np.array([end_id], "<u4").tobytes()
    fields = [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ]
    if ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = ids_of(ranks_path)
        for batch in batches:
            rows = []
            keys, texts = (c.to_pylist() for c in batch.columns)
            for a, b in portions(texts):
                for key, blob in zip(keys[a:b], source.of(texts[a:b])):
                    blob = memoryview(blob + end)
                    for piece, (start, length) in enumerate(cut(len(blob) // 4, capacity)):
                        part = blob[4 * start : 4 * (start + length)]
                        row = (key, piece, start, length, zlib.crc32(part))
                        rows.append((*row, np.frombuffer(part, "<i4")) if ids else row)
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
            )

    out = PIECES + (", ids array<int>" if ids else "")
    return docs.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(run, out)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each size and the fill of each bin, longest first.

    ``count[g]`` is the number of open bins with gap ``g``. Putting a size into
    gap ``g`` takes one from ``count[g]`` and adds one to ``count[g - size]``,
    which changes the sum of squares by ``2 * (count[g - size] - count[g]) + 2``;
    a new bin changes it by ``2 * count[capacity - size] + 1`` and a filled bin
    no longer counts.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    fill: list[int] = []
    never = np.iinfo(np.int64).max
    for i in np.argsort(-sizes, kind="stable"):
        s = int(sizes[i])
        have = count[s:capacity]
        change = 2 * (count[: capacity - s] - have) + 2
        if len(change):
            change[0] = 1 - 2 * have[0]
            change[have == 0] = never
            g = int(np.argmin(change))
        fresh = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        if len(change) and change[g] <= fresh:
            gap = g + s
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += s
        if gap > s:
            stacks[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets, np.array(fill, np.int64)


def repacked(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sum_of_squares``, with what lies in open bins packed again as long as that saves bins."""
    bins, offsets, fill = sum_of_squares(sizes, capacity)
    while True:
        open_ = np.flatnonzero((fill > 0) & (fill < capacity))
        loose = np.flatnonzero(fill[bins] < capacity)
        again, at, filled = sum_of_squares(sizes[loose], capacity)
        if len(filled) >= len(open_):
            return bins, offsets, fill
        bins[loose], offsets[loose] = open_[again], at
        fill[open_] = 0
        fill[open_[: len(filled)]] = filled


def _pack_level(items: DataFrame, shards: int, level: int, capacity: int) -> DataFrame:
    """(item, bin, offset, fill) for items (item, size), shard by shard."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        order = np.argsort(table.column("item").to_numpy(), kind="stable")
        item = table.column("item").to_numpy()[order]
        bins, offsets, fill = repacked(table.column("size").to_numpy()[order], capacity)
        base = (level << 56) | (shard << 24)
        return pa.table({"item": item, "bin": base + bins, "offset": offsets, "fill": fill[bins]})

    shard = F.pmod(F.xxhash64("item"), F.lit(shards)).cast("bigint").alias("shard")
    return items.select("item", "size", shard).groupBy("shard").applyInArrow(
        run, "item bigint, bin bigint, offset bigint, fill bigint"
    )


def pack(
    docs: DataFrame,
    ranks_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard: int = SHARD,
    ids: bool = False,
) -> DataFrame:
    """Every piece with its sequence and its place there.

    ``ranks_path`` names the vocabulary file of ranks. With ``ids`` the token
    ids of each piece are a column too.
    """
    importable(docs.sparkSession)
    work = Workspace(docs.sparkSession)
    pieces = tokenised(docs, ranks_path, doc_id, text, capacity, end_id, ids)
    pieces = work.write(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    left = pieces.filter(F.col("length") < capacity).select("item", F.col("length").alias("size"))
    count, level, placed = left.count(), 0, None
    while count:
        shards = -(-count // shard)
        packed = work.write(_pack_level(left, shards, level, capacity), f"level{level}")
        if placed is None:
            placed = packed.select("item", "bin", "offset")
        else:
            move = packed.select(
                F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("shift")
            )
            placed = placed.join(move, "bin", "left").select(
                "item", F.coalesce("to", "bin").alias("bin"),
                (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            )
        if shards == 1:
            break
        left = packed.filter(F.col("fill") < capacity).groupBy(F.col("bin").alias("item")).agg(
            F.first("fill").alias("size")
        )
        before, count, level = count, left.count(), level + 1
        if count > before // 2:
            break
    if placed is None:
        placed = left.select("item", F.col("item").alias("bin"), F.col("size").alias("offset"))
    met = pieces.join(placed, "item", "left")
    # Even numbers for shared sequences, odd ones for full pieces.
    sequence = F.coalesce(2 * F.col("bin"), 2 * F.col("item") + 1)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    return met.select(*columns, sequence.alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset"))
