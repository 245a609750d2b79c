import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from devmetrics.llm import whitening

INTS = "vec_id bigint, x array<bigint>, component string"


def reference(x, k):
    """Everything from one dense eigenproblem; the sums as Python integers."""
    n, sums = len(x), [sum(int(r[j]) for r in x) for j in range(len(x[0]))]
    whole = [[n * int(c) - s for c, s in zip(r, sums)] for r in x]
    centred = np.array(whole, float) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return e, centred @ u / np.sqrt(e), e / np.trace(cov), [sum(c * c for c in r) for r in whole]


def check(rows, x, k, ids):
    e, white, explained, deviation = reference(x, k)
    assert len(rows) == len(x) * k
    by_row = {}
    for r in rows:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    for c in range(k):
        mine = np.array([by_row[i][c + 1]["whitened"] for i in ids])
        sign = np.sign(mine @ white[:, c])
        np.testing.assert_allclose(sign * mine, white[:, c], atol=1e-7)
        assert by_row[ids[0]][c + 1]["explained"] == pytest.approx(explained[c], rel=1e-9)
    for i, d in zip(ids, deviation):
        assert by_row[i][1]["deviation"] == d and by_row[i][1]["n"] == len(x)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("dims, n, k", [(1, 20, 1), (3, 50, 2), (40, 300, 32)])
def test_against_a_dense_eigenproblem(spark, dims, n, k):
    rng = np.random.default_rng(dims)
    x = np.floor(rng.standard_normal((n, dims)) * (5 + np.arange(dims)) * 40).astype(int) + 1_000_000
    df = spark.createDataFrame([(i, row.tolist(), "c") for i, row in enumerate(x)], INTS).repartition(7)
    check(whitening.whiten(df, components=k).collect(), x, k, list(range(n)))


def spectra():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((60, 60))
    yield "random", a @ a.T
    yield "falling", np.diag(10.0 ** -np.arange(60))
    yield "flat", np.diag(1 + 1e-3 * rng.random(60))
    yield "two values", np.diag([5.0] * 40 + [1.0] * 20)
    yield "identity", np.eye(60)
    yield "low rank", a[:, :3] @ a[:, :3].T
    yield "hidden in the last coordinate", np.diag([1.0] * 59 + [50.0])


@pytest.mark.parametrize("name, v", list(spectra()), ids=lambda p: p if isinstance(p, str) else "")
@pytest.mark.parametrize("block", [1, 5, 16])
def test_jacobi_davidson_finds_the_largest(name, v, block):
    e, u = whitening.jacobi_davidson(lambda q: v @ q, 60, 24, block=block)
    wanted = np.linalg.eigvalsh(v)[::-1][:24]
    np.testing.assert_allclose(e, wanted, atol=1e-12 * wanted[0])
    assert np.linalg.norm(v @ u - u * e, axis=0).max() <= 1e-12 * wanted[0]
    np.testing.assert_allclose(u.T @ u, np.eye(24), atol=1e-13)


def test_products_are_few_and_narrow():
    a = np.random.default_rng(2).standard_normal((200, 200))
    widths = []

    def apply(q):
        widths.append(q.shape[1])
        return a @ (a.T @ q)

    whitening.jacobi_davidson(apply, 200, 16)
    assert max(widths) <= 2 * whitening.BLOCK and len(widths) < 200


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((30, 30))
    v = a @ a.T
    u = np.linalg.qr(rng.standard_normal((30, 3)))[0]
    locked = np.linalg.qr(np.hstack([u, rng.standard_normal((30, 2))]))[0][:, 3:]
    theta = np.einsum("ij,ij->j", u, v @ u)
    residual = v @ u - u * theta
    residual -= locked @ (locked.T @ residual)
    t = whitening.minres(lambda q: v @ q, locked, u, theta, residual, 60, 1e-14)
    for j in range(3):
        q = np.hstack([locked, u[:, j : j + 1]])
        p = np.eye(30) - q @ q.T
        np.testing.assert_allclose(p @ (v @ t[:, j] - theta[j] * t[:, j]), -p @ residual[:, j], atol=1e-6)
        np.testing.assert_allclose(q.T @ t[:, j], 0, atol=1e-9)


def test_odd_rows(spark):
    rng = random.Random(6)
    good = [(i % 40, [rng.randrange(100), 7, rng.randrange(100)], "c") for i in range(60)] + [(None, [5, 7, 5], "c")] * 2
    bad = [(100, None, "c"), (101, [1, None, 2], "c"), (102, [], "c"), (103, [1, 2], "c"), (104, [1, 2, 3, 4], "c")]
    rows = whitening.whiten(spark.createDataFrame(good + bad, INTS)).collect()
    # A constant dimension leaves two components of three.
    assert len(rows) == 2 * len(good) and {r["component"] for r in rows} == {1, 2}
    assert sum(r["vec_id"] is None for r in rows) == 4
    e, white, explained, deviation = reference([r[1] for r in good], 2)
    assert sorted({r["explained"] for r in rows}) == pytest.approx(sorted(explained))
    assert sorted(r["deviation"] for r in rows if r["component"] == 1) == sorted(deviation)


@pytest.mark.parametrize("vectors", [[], [[3, 4]], [[3, 4]] * 5, [[]], [None]])
def test_nothing_to_whiten(spark, vectors):
    out = whitening.whiten(spark.createDataFrame([(i, v, "c") for i, v in enumerate(vectors)], INTS))
    assert out.count() == 0 and out.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]


def test_deviations_beyond_doubles_are_exact(spark):
    x = [[10**7 * i + i * i, 3 - i] for i in range(8)]
    rows = whitening.whiten(spark.createDataFrame([(i, v, "c") for i, v in enumerate(x)], INTS), components=1).collect()
    wanted = [[8 * c - sum(r[j] for r in x) for j, c in enumerate(v)] for v in x]
    big = [sum(c * c for c in v) for v in wanted]
    assert 2**53 < max(big) < 2**63 and {r["vec_id"]: r["deviation"] for r in rows} == dict(enumerate(big))


def test_quantised(spark):
    values = [[0.5, -0.011], [None, 1.0], [math.nan, 1.0], [math.inf, 1.0], [-math.inf], [], None]
    df = spark.createDataFrame([(v,) for v in values], "e array<float>")
    got = [r[0] for r in df.select(whitening.quantised(F.col("e"), 64, 1_000_000)).collect()]
    assert got == [[1_000_032, 999_999], None, None, None, None, [], None]


def test_the_query(spark, tmp_path):
    from devmetrics.llm.queries import QUERIES

    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(rng.standard_normal((150, 40)).astype(np.float32))]
    odd = [(900, None, 0), (901, [None] * 40, 0), (902, [math.nan] * 40, 0), (903, [1.0] * 39 + [math.inf], 0)]
    schema = "vec_id bigint, embedding array<float>, label int"
    spark.createDataFrame(rows + odd, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op12_whitening"](spark, str(tmp_path)).collect()
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in rows]
    check(got, x, 32, list(range(150)))
