import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from devmetrics.llm import topk


def brute(rows, k=5, every=50):
    whole = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in whole:
        if q is not None and q % every == 0:
            scores = [(sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q]
            best = sorted(scores, key=lambda s: (-s[0], s[1] is None, s[1]))[:k]
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("shard", [16_384, 90])
def test_against_brute_force(spark, shard):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=12) * (0.1 if i % 3 else 2)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(20)]
    rows += [(500, None), (501, []), (502, [1.0, None]), (503, [float("nan")] * 12), (504, [float("inf")] * 12), (None, rows[0][1]), (550, [0.5, -0.25])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id bigint, embedding array<double>, score double")
    assert result(topk.top_k(df, F.col("vec_id") % 50 == 0, shard=shard)) == brute(rows)


def test_large_components_and_few_rows(spark):
    rows = [(0, [1e7, 3.0]), (1, [2e6, -5.0]), (50, [-1e7, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert result(topk.top_k(df, F.col("vec_id") % 50 == 0)) == brute(rows)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_only_the_own_row_is_left_out(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.9, 0.0]), (50, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") == 50).collect()
    by_rank = sorted((r["rank"], r["score"], r["vec_id"] is None, r["vec_id"] or 0) for r in got if r["query_id"] == 50)
    big, mid, low = 256 * 256, 256 * 230, 256 * 128
    # Each of the two equal rows meets the other one; the third meets both.
    assert [x[:2] for x in by_rank] == [(1, mid), (1, big), (1, big), (2, mid), (2, big), (2, big), (3, mid), (3, mid), (3, mid), (4, 230 * 128), (4, low), (4, low)]
