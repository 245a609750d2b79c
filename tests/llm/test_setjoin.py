import re
from collections import Counter

import numpy as np
import pytest

from devmetrics.llm import setjoin
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Per row (id, set size, smallest id reachable)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(key)
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in groups.items()}
    return Counter((k, len(s), least[root(i)] if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def result(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert result(setjoin.links(odd)) == brute(rows)
    assert setjoin.links(nothing).count() == 0
    assert setjoin.one_per_group(nothing).count() == 0


@pytest.fixture(scope="module")
def copies(spark):
    """One group of near copies at many distances, chains, and a passage that unrelated texts share."""
    rng = np.random.default_rng(5)
    base, passage = prose(11, 120), prose(12, 60)
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            words[at] = f"new{i}x{at}"
        rows.append((i, " ".join(words)))
    chain = prose(13, 100)
    for i in range(60, 80):
        chain = chain[3:] + [f"c{i}a", f"c{i}b", f"c{i}c"]
        rows.append((i, " ".join(chain)))
    rows += [(i, " ".join(prose(100 + i, 40) + passage + prose(300 + i, 20))) for i in range(80, 130)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), rows


@pytest.mark.parametrize("heavy", [32, 3])
def test_groups_of_near_copies(copies, heavy, monkeypatch):
    monkeypatch.setattr(setjoin, "HEAVY", heavy)
    docs, rows = copies
    assert result(setjoin.links(docs)) == brute(rows)


def test_long_lists_in_two_rounds(copies, monkeypatch):
    """Components that leaders do not reach are found in the second round."""
    monkeypatch.setattr(setjoin, "HEAVY", 10_000)
    docs, rows = copies
    assert result(setjoin.links(docs)) == brute(rows)


def test_one_row_of_each_group_stays(odd):
    kept = setjoin.one_per_group(odd)
    assert kept.columns == odd.columns
    got = Counter(r["doc_id"] for r in kept.collect())
    assert got[1] == 1 and not got[2] and not got[3]
    assert got[4] == got[5] == got[6] == 1 and got[7] == 1 and not got[8]
    assert got[10] == 2 and got[11] == 1
