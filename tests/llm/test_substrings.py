import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from devmetrics.llm import substrings
from devmetrics.llm.wordhash import Batch, runs
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    words = [WORD.findall(t or "") for _, t in rows]
    rank = [float("inf") if k is None else k for k, _ in rows]
    least = {}
    for r, w in zip(rank, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, r), r)
    out = []
    for (k, _), r, w in zip(rows, rank, words):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < r:
                gone[i : i + window] = True
        out.append((k, len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


def result(df):
    return Counter(map(tuple, df.collect()))


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert result(substrings.without_repeats(odd)) == brute(rows)
    assert result(substrings.without_repeats(odd.repartition(7))) == brute(rows)
    assert substrings.without_repeats(nothing).count() == 0


def test_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PORTION", 500)
    passages = [prose(s, n) for s, n in ((1, 13), (2, 14), (3, 12), (4, 80))]
    rows = []
    for i in range(80):
        words = prose(1000 + i, 50 + i)
        for k, p in enumerate(passages):
            if i % (k + 2) == 0:
                words = words[: 10 * k + 3] + p + words[10 * k + 3 :]
        rows.append((200 - i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for window in (13, 6):
        assert result(substrings.without_repeats(docs, window)) == brute(rows, window)


def test_windows_that_share_an_anchor_and_32_bits(spark):
    """A hot passage with another word behind it in each document: 32 bits of the windows do collide."""
    texts = [" ".join(prose(1, 12) + [f"w{i}"]) for i in range(300_000)]
    batch = Batch(pa.array(texts), lower=False)
    long, text = runs(batch.hash, batch.first, 13)
    low = long[text >= 0].astype(np.uint32)
    order = np.argsort(low, kind="stable")
    same = np.flatnonzero(low[order][1:] == low[order][:-1])
    assert len(same)
    rows = [(2 * k + n, texts[order[i + n]]) for k, i in enumerate(same) for n in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(substrings.without_repeats(docs)) == brute(rows)


def test_null_ids_whose_texts_share_22_bits(spark):
    shared, other = " ".join(prose(1, 13)), " ".join(prose(2, 13))
    a = spark.range(6000).select(F.format_string(f"{shared} a%s", "id").alias("a"))
    b = spark.range(6000).select(F.format_string(f"{other} b%s", "id").alias("b"))
    pair = a.join(b, F.xxhash64("a").bitwiseAND(F.lit(0x3FFFFF)) == F.xxhash64("b").bitwiseAND(F.lit(0x3FFFFF))).first()
    rows = [(1, shared), (None, pair["a"]), (None, pair["b"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(substrings.without_repeats(docs)) == brute(rows)


class AllSurvive:
    def has(self, keys):
        return np.ones(len(keys), bool)


def test_memory_of_a_task_does_not_grow_with_its_arrow_batches(monkeypatch):
    """All levels over one batch of 8 MB, in slices of 64 KB."""
    monkeypatch.setattr(substrings, "PORTION", 1 << 16)
    texts = pa.array([" ".join(prose(i, 8)) + f" {i} " + " ".join(prose(i % 7, 300)) for i in range(4000)])
    assert pc.sum(pc.binary_length(texts)).as_py() > 8 << 20
    ids = pa.array(range(4000))
    found = pa.nulls(4000, pa.list_(pa.int64()))
    for level, columns in (
        (substrings._first_level(13), [ids, texts]),
        (substrings._second_level(13, AllSurvive(), AllSurvive()), [ids, ids, texts]),
        (substrings._kept(13), [ids, texts, found]),
    ):
        table = pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])
        tracemalloc.start()
        for out in level(iter([table])):
            assert out.nbytes < 8 << 20
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 32 << 20


def test_common_anchor_with_other_words_around_it_is_no_single_group(spark, monkeypatch):
    """12 words in 400 documents, between other words in each; some share the words on one side too."""
    monkeypatch.setattr(substrings, "PORTION", 4000)
    monkeypatch.setattr(substrings, "COMMON", 100, raising=False)
    extended, middle = substrings._extended, prose(3, 12)

    def guarded(batches):
        def looked_at():
            for table in batches:
                most = max(Counter(table.column(0).to_pylist()).values())
                if most > 100:
                    raise ValueError(f"{most} rows around one anchor")
                yield table

        return extended(looked_at())

    monkeypatch.setattr(substrings, "_extended", guarded)
    rows = [(i, " ".join(prose(100 + i // 3, 20) + middle + prose(1000 + i, 20))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert result(substrings.without_repeats(docs)) == brute(rows)
