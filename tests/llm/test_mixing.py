import pytest
from pyspark.sql import functions as F

from devmetrics.llm import mixing


def shared(sizes, weights):
    """Targets by sharing the excess again and again."""
    total, target = sum(sizes), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while True:
        left = total - sum(3 * sizes[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        for i in range(len(sizes)):
            target[i] = left * weights[i] / weight if i in free else 3.0 * sizes[i]
        over = {i for i in free if target[i] > 3 * sizes[i] + 1e-9}
        if not over:
            return target
        free -= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 500, 2, 900], [0, 5, 1], [7], [1, 1, 1, 1, 1, 10_000]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    got = mixing.source_targets(spark.createDataFrame(rows, "source string, size bigint")).orderBy("source").collect()
    wanted = shared(sizes, [1 + i % 3 for i in range(len(sizes))])
    assert [r["target"] for r in got] == pytest.approx(wanted)


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (1 + (i * i * 31) % 700), f"s{i % 7}" if i % 2 else "hot") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(docs).cache()
    assert out.count() == 1500
    per = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in per.collect():
        assert abs(r["taken"] - r["target"]) < 60
    assert out.filter("taken > 3 * size OR taken % size <> 0").count() == 0
    again = mixing.mix(docs.repartition(5)).exceptAll(out)
    assert again.count() == 0


def test_expectation_is_kept(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i), "a") for i in range(40)] + [(99, "w " * 900, "b")], "doc_id bigint, text string, source string")
    counts = [sum(r["copies"] for r in mixing.mix(docs, seed=s).filter("doc_id = 20").collect()) for s in range(6)]
    assert set(counts) <= {0, 1} or set(counts) <= {1, 2} or set(counts) <= {2, 3}


def test_odd_rows(odd, nothing):
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count()
    assert {r["source"] for r in out} == {"a", "b", "c", "d", "e", "f", None}
    assert all(r["taken"] == r["size"] * r["copies"] <= 3 * r["size"] for r in out)
    rows = mixing.mix_rows(odd)
    assert rows.columns == odd.columns
    assert rows.count() == sum(r["copies"] for r in out)
    assert mixing.mix(nothing).count() == 0 and mixing.mix_rows(nothing).count() == 0
