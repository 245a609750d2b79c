import hashlib
import random
import re
import zlib

import pytest

from devmetrics.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string"


def brute_runs(w, min_length=6, exponent=4):
    """All maximal stretches of each period; the smallest period of a stretch is kept."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, exponent * q):
                smaller = (p for p in range(1, q) if all(w[k] == w[k + p] for k in range(i, i + length - p)))
                if next(smaller, None) is None:
                    found[(i, length, q)] = True
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in dropped)


def texts():
    rng = random.Random(3)
    out = ["", None, " \n\t", "a", "a a a a a", "a a a a a a", "la " * 500, "x y " * 3, "x y " * 4, "é\x85 é\x85 é\x85 é\x85 é\x85 é\x85"]
    for size in (2, 3):
        for _ in range(120):
            out.append(" ".join(rng.choice("abc"[:size]) for _ in range(rng.randrange(1, 60))))
    for _ in range(120):
        period = [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        stretch = (period * 9)[: rng.randrange(4, 9 * len(period))]
        other = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 30))]
        out.append("\n ".join(other + stretch + other[::-1] + stretch))
    nested = ("a a a a a b " * 5 + "c ") * 5
    fibonacci = ["a", "a b"]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + " " + fibonacci[-2])
    long = " ".join(f"w{i % 477}" for i in range(4_000))
    return out + [nested, *fibonacci, long, nested + long]


@pytest.mark.parametrize("portion", [periodic.PORTION, 60])
def test_runs_and_collapsed_texts(spark, portion):
    rows = list(enumerate(texts()))
    got = periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(3), portion=portion).collect()
    assert len(got) == len(rows)
    for r in got:
        w = WORD.findall(rows[r["doc_id"]][1] or "")
        wanted = brute_runs(w)
        assert [tuple(x) for x in r["runs"]] == wanted
        assert r["n_words"] == len(w) and r["collapsed"] == brute_collapsed(w, wanted)


@pytest.mark.parametrize("min_length, exponent", [(2, 2), (5, 2), (9, 3), (1, 2)])
def test_other_bounds(spark, min_length, exponent):
    rows = [(k, t) for k, t in enumerate(texts()) if t is None or len(t) < 2000]
    df = spark.createDataFrame(rows, SCHEMA)
    by_id = dict(rows)
    for r in periodic.periodic_runs(df, min_length=min_length, min_exponent=exponent).collect():
        w = WORD.findall(by_id[r["doc_id"]] or "")
        assert [tuple(x) for x in r["runs"]] == brute_runs(w, min_length, exponent)


def test_a_class_that_takes_in_a_smaller_one_keeps_only_real_neighbours():
    assert list(periodic._meetings([1, 9], [3, 5])) == [(1, 3), (5, 9)]
    assert list(periodic._meetings([4], [1, 2, 7])) == [(2, 4), (4, 7)]
    assert periodic.kruskal_seeds([0, 1], [1, 2], [5, 4]) == [(0, 1, 5), (1, 1, 4)]


def test_odd_rows(odd, nothing):
    got = periodic.periodic_runs(odd)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    wanted = sorted(" ".join(WORD.findall(r["text"] or "")) for r in odd.collect())
    assert sorted(r["collapsed"] for r in got.collect()) == wanted
    assert periodic.periodic_runs(nothing).count() == 0
    planted = periodic.with_planted_runs(odd)
    assert planted.columns == odd.columns and planted.count() == odd.count()


def planted(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def test_the_query(spark, tmp_path):
    from devmetrics.llm.queries import QUERIES

    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(0, 90)))) for k in range(400)]
    rows += [(None, "a b " * 9), (1000, None), (-4, "x " * 40), (1001, "")]
    rows += [(k, "  one\ttwo  three\n" * (k % 7)) for k in range(2000, 2060)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    changed = 0
    for key, text in rows:
        w = planted(key, text)
        changed += w != WORD.findall(text or "")
        runs = brute_runs(w)
        r = got[key]
        assert r["n_runs"] == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()
    assert changed > 10
