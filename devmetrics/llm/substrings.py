"""Removal of word windows that an earlier document already has.

A window is ``window`` consecutive words of one document. Every word covered by
a window whose word sequence also starts in a document with a smaller id is
removed; windows are judged on the input, not on what is left.

Windows are found by levels of doubling length. The first level has windows of
half the length. Of those in a long window only one matters, its anchor: the one
with the smallest hash, which equal long windows have at the same place. Anchors
of at least two documents survive; a bitmap of bounded size tells the texts which
they are. The second level extends survivors alone: the long windows around one
travel with it and are compared where it lands, and none survives that only one
document has. With very many survivors the bitmap fills up; then it spares less,
and nothing is lost.

Texts without a removed word are not shuffled either: a second bitmap, of the
rows that have one, keeps them where they are.

Before the second shuffle each portion of a task drops the windows that an earlier
document of the same portion has; they are decided. So a passage that a third
of all documents share travels once per portion, not once per document.

A task hashes its texts in slices and compares what is left of them in portions,
both of bounded size, so its memory does not depend on how many texts come in
one Arrow batch; only a single text longer than a slice takes more.

Long windows are compared by their own 64-bit hashes, and only below one short
window, of which 32 bits decide where they meet. Around a common anchor, with
more than ``COMMON`` occurrences, each long window travels alone, to where 32
bits of its own hash say; so no task gets all that surrounds one anchor. Rows
with equal or null ids are told apart by a 64-bit hash of the text.

Defined cases: a null text has no words. A null id ranks after every other;
equal ids never remove from each other. Equal rows get equal results. Very long
texts are read whole. An empty table gives an empty result. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.bits import Bits
from devmetrics.llm.staging import Workspace, importable
from devmetrics.llm.wordhash import Batch, runs

WINDOW = 13
# Bytes of text that a task hashes at a time, and anchors or windows that it compares at a time before a shuffle.
PORTION = 1 << 19
# Occurrences from which on the windows around an anchor are dealt by their own hashes.
COMMON = 1 << 14

_NO_ID = np.iinfo(np.int64).max
# ``place`` holds which long windows, and the word: bits << 32 | word. ``tag`` is a hash of the text.
_HITS = pa.schema(
    [("h", pa.int32()), ("doc", pa.int64()), ("tag", pa.int64()), ("place", pa.int64()), ("long", pa.binary())]
)
_FOUND = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("place", pa.int64())])
_WORD, _BITS = (1 << 32) - 1, 0xFF << 32


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``PORTION`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < len(sizes):
        stop = int(np.searchsorted(total, total[start] + PORTION, "right")) - 1
        stop = min(max(stop, start + 1), len(sizes))
        yield start, stop
        start = stop


def _portions(parts: Iterator[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """The same columns with about ``PORTION`` rows at a time."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= PORTION:
            joined = [np.concatenate(c) for c in zip(*held)]
            held, n = [], 0
            yield joined
            del joined
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _anchors(short: np.ndarray, starts: np.ndarray, reach: int) -> np.ndarray:
    """For each start of a long window the place of its smallest short window, the first if several."""
    best, at = short[starts], np.zeros(len(starts), np.int64)
    for k in range(1, reach):
        other = short[starts + k]
        less = other < best
        best, at = np.where(less, other, best), np.where(less, k, at)
    return starts + at


def _windows(batch: Batch, window: int) -> tuple[np.ndarray, ...]:
    """(hash, text, start, place of the anchor) of all long windows, and the hashes of the short ones."""
    half = window // 2
    long, text = runs(batch.hash, batch.first, window)
    starts = np.flatnonzero(text >= 0)
    short, _ = runs(batch.hash, batch.first, half)
    return long[starts], text[starts], starts, _anchors(short, starts, window - half + 1), short


def _first_level(window: int):
    """Hashes of the anchors of each portion, with its documents and occurrences there."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for table in batches:
            ids, texts = table.column(0).fill_null(_NO_ID).to_numpy(), table.column(1)
            for a, b in _slices(texts):
                _, text, _, anchor, short = _windows(Batch(texts.slice(a, b - a), lower=False), window)
                if len(anchor):
                    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
                    yield [short[anchor[new]], ids[a:b][text[new]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, doc in _portions(anchors(batches)):
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            head = np.concatenate([[True], h[1:] != h[:-1]])
            other = np.concatenate([[True], doc[1:] != doc[:-1]]) | head
            group = np.flatnonzero(head)
            docs, n = np.add.reduceat(other.astype(np.int64), group), np.diff(np.append(group, len(h)))
            yield pa.RecordBatch.from_arrays([pa.array(h[group].astype(np.int64)), pa.array(docs), pa.array(n)], ["h", "docs", "n"])

    return run


def _later(long: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a smaller id has the window too."""
    order = np.lexsort((doc, long))
    sorted_long, sorted_doc = long[order], doc[order]
    head = np.concatenate([[True], sorted_long[1:] != sorted_long[:-1]])
    smallest = sorted_doc[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
    out = np.empty(len(doc), bool)
    out[order] = sorted_doc > smallest
    return out


def _hits(
    long: np.ndarray, h: np.ndarray, alone: np.ndarray, nth: np.ndarray, k: np.ndarray, at: np.ndarray,
    doc: np.ndarray, tag: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """A row per anchor with its long windows that this portion decides, and one with those it does not.

    Per long window: its hash, where it is compared, whether it gets a row of its own there,
    the number of its anchor, the words before the anchor in the window and in the text, and
    the text's id and tag.
    """
    later = _later(long, doc)
    for decided in (False, True):
        pick = np.flatnonzero(later == decided)
        if not len(pick):
            continue
        # Windows of one short window are neighbours; those of one text come in order.
        number = nth[pick]
        head = np.concatenate([[True], number[1:] != number[:-1]])
        group = np.flatnonzero(head if decided else head | alone[pick])
        mask = np.add.reduceat(np.left_shift(1, k[pick].astype(np.int64)), group)
        ends = np.append(group, len(pick)).astype(np.int32) * 8
        data = long[pick]
        pick = pick[group]
        if decided:
            key = (doc[pick].astype(np.uint64) + at[pick].astype(np.uint64)).astype(np.int32)
            blob = pa.nulls(len(group), pa.binary())
        else:
            key = h[pick]
            blob = pa.Array.from_buffers(
                pa.binary(), len(group), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(doc[pick]), pa.array(tag[pick]), pa.array(mask << 32 | at[pick]), blob], schema=_HITS
        )


def _second_level(window: int, survivors: Bits, common: Bits):
    """The surviving anchors with the long windows around them that are not decided yet, and with those that are."""

    def alive(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        done = 0
        for table in batches:
            ids, tags = table.column(0).fill_null(_NO_ID).to_numpy(), table.column(1).to_numpy()
            texts = table.column(2)
            for a, b in _slices(texts):
                batch = Batch(texts.slice(a, b - a), lower=False)
                long, text, starts, anchor, short = _windows(batch, window)
                left = np.flatnonzero(survivors.has(short[anchor].astype(np.int64)))
                long, text, starts, anchor = long[left], text[left], starts[left], anchor[left]
                alone = common.has(short[anchor].astype(np.int64))
                h = np.where(alone, long, short[anchor]).astype(np.int32)
                k, at = (anchor - starts).astype(np.int8), anchor - batch.first[text]
                yield [long, h, alone, anchor + done, k, at, ids[a:b][text], tags[a:b][text]]
                done += len(batch.hash)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _portions(alive(batches)):
            if len(columns[0]):
                yield from _hits(*columns)

    return run


def _bits(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the bits that are set, the high ones of a row first."""
    table = (mask[:, None] >> np.arange(7, -1, -1)) & 1
    row, column = np.nonzero(table)
    return row, 7 - column


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Long windows that a smaller id has; in: hits in order of where they are compared, and id."""
    seen: dict[str, np.ndarray] | None = None
    for table in batches:
        h, doc, tag, place = (table.column(i).to_numpy() for i in range(4))
        blobs = table.column(4)
        undecided = blobs.is_valid().to_numpy(zero_copy_only=False)
        bits = (place & _BITS) >> 32
        mask = np.where(undecided, bits, 0)
        row, k = _bits(mask)
        joined = pa.concat_arrays([blobs.drop_null()])
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(joined) + 1]
        data = joined.buffers()[2]
        values = np.frombuffer(data, np.uint64)[offsets[0] // 8 : offsets[-1] // 8] if data and len(joined) else np.empty(0, np.uint64)
        n_seen = 0
        kh, kk, kv, kd = h[row], k, values, doc[row]
        if seen is not None and len(h) and seen["h"][0] == h[0]:
            n_seen = len(seen["h"])
            kh, kk, kv, kd = (np.concatenate([seen[c], x]) for c, x in zip("hkvd", (kh, kk, kv, kd)))
        if len(kh):
            order = np.lexsort((kd, kv, kk, kh))
            sh, sk, sv, sd = kh[order], kk[order], kv[order], kd[order]
            head = np.concatenate([[True], (sh[1:] != sh[:-1]) | (sk[1:] != sk[:-1]) | (sv[1:] != sv[:-1])])
            smallest = sd[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
            later = np.empty(len(kh), bool)
            later[order] = sd > smallest
            last = head & (sh == h[undecided][-1] if undecided.any() else False)
            if last.any():
                seen = dict(zip("hkvd", (x[last] for x in (sh, sk, sv, sd))))
            gone = np.bincount(row, np.where(later[n_seen:], np.left_shift(1, k), 0), len(h)).astype(np.int64)
        else:
            gone = np.zeros(len(h), np.int64)
        gone = np.where(undecided, gone, bits)
        pick = np.flatnonzero(gone)
        left = (place[pick] & ~_BITS) | gone[pick] << 32
        yield pa.RecordBatch.from_arrays([pa.array(doc[pick]), pa.array(tag[pick]), pa.array(left)], schema=_FOUND)


def _tag():
    """A hash of the text, to tell rows with equal ids apart."""
    return F.xxhash64("text")


def _kept(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (table.slice(a, b - a) for table in batches for a, b in _slices(table.column(1))):
            rows = []
            for key, text, found in zip(*(part.column(i) for i in range(3))):
                words = (text.as_py() or "").encode().split()
                keep = words
                if found.is_valid:
                    place = np.asarray(found.values, np.int64)
                    row, k = _bits((place & _BITS) >> 32)
                    start = (place & _WORD)[row] - k
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + window, -1)
                    keep = list(compress(words, (np.cumsum(gone)[:-1] == 0).tolist()))
                rows.append((key.as_py(), len(words), len(words) - len(keep), b" ".join(keep).decode()))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def without_repeats(
    docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and kept_text, its kept words joined by one space."""
    if not 2 <= window <= 14:
        raise ValueError("a window has 2 to 14 words")
    importable(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    work = Workspace(docs.sparkSession)
    anchors = texts.select("doc_id", "text").mapInArrow(_first_level(window), "h bigint, docs bigint, n bigint")
    repeated = anchors.groupBy("h").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).filter("docs > 1")
    repeated = work.write(repeated.select("h", (F.col("n") > COMMON).alias("common")), "repeated")
    survivors, common = Bits(repeated, F.col("h")), Bits(repeated.filter("common"), F.col("h"))
    work.drop("repeated")
    hits = texts.select("doc_id", _tag().alias("tag"), "text").mapInArrow(
        _second_level(window, survivors, common), "h int, doc bigint, tag bigint, place bigint, long binary"
    )
    found = hits.repartition("h").sortWithinPartitions("h", "doc").mapInArrow(
        _extended, "doc bigint, tag bigint, place bigint"
    )
    found = work.write(found, "found")
    keyed = texts.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(int(_NO_ID))).alias("doc"), _tag().alias("tag")
    )
    row = F.xxhash64("doc", "tag")
    changed, whole = Bits(found, row).split(keyed, row)
    per_doc = found.groupBy("doc", "tag").agg(F.collect_list("place").alias("found"))
    changed = changed.join(per_doc, ["doc", "tag"], "left").select("doc_id", "text", "found")
    whole = whole.select("doc_id", "text", F.lit(None).cast("array<bigint>").alias("found"))
    return changed.unionByName(whole).mapInArrow(
        _kept(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
