"""Whitening of vectors by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance V of all vectors is never formed. What is computed of it is its
product with a narrow block of directions: every task centres its rows, projects
them and adds up ``x * (x . q)``; the partial sums are added up in Spark and
reach the driver as a few small blocks. All other steps (orthogonalisation,
Rayleigh-Ritz, MINRES recurrences) are on ``dims`` by ``block`` numbers.

An outer step of the block Jacobi-Davidson method:

* Rayleigh-Ritz on the search space gives the largest Ritz pairs (theta, u).
* A pair whose residual ``V u - theta u`` is at double precision is locked, the
  largest first; the search space stays orthogonal to what is locked, and fresh
  random directions take its place.
* For the largest pairs that are not locked yet the projected correction equation
  ``(I - QQ') (V - theta) (I - QQ') t = -r`` with Q = (locked, u) is solved roughly
  by MINRES: all pairs take their steps together, one product each.
* The corrections enlarge the search space. Beyond ``max_space`` directions it
  restarts from its best Ritz vectors.

Vectors are whole numbers here, so sums and deviations are exact. Centring comes
before multiplying: an entry is ``(n * x - S) / n`` with an exact numerator.

Defined cases: a vector that is null or holds a null or non-finite entry takes no
part, nor does one whose length is not the commonest (of equally common ones the
greatest). Null and equal ids, repeated rows and ties are rows like any other.
Without vectors, or where all are equal, there is no component and so no row;
components whose eigenvalue is 0 to double precision are left out. Equal
eigenvalues leave the choice of their eigenvectors open. A deviation or an entry
beyond 64 bits fails the job. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace, importable

COMPONENTS = 32
# Directions that one product takes, and those the search space holds before it restarts.
BLOCK = 16
MAX_SPACE = 48
# MINRES steps of one correction, and outer steps of all, before the method counts as failed.
INNER_STEPS = 5
OUTER_STEPS = 1000

EPS = float(np.finfo(np.float64).eps)


def quantised(embedding: Column, scale: int = 64, offset: int = 0) -> Column:
    """``floor(scale * c) + offset`` of all entries as ARRAY<BIGINT>; NULL if any is null or not finite."""
    entries = F.transform(embedding, lambda c: c.cast("double"))
    finite = F.forall(
        entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(math.inf)), F.lit(False))
    )
    whole = F.transform(entries, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset).cast("bigint"))
    return F.when(finite, whole)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def summed(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of what ``partial`` makes of the rows of a task.

    A task gives one block; blocks are added up in about the square root of
    their number of tasks, which leaves as many for the driver.
    """
    spark = rows.sparkSession
    importable(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        block = np.ascontiguousarray(partial(batches), kind)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "block": pa.array([block.tobytes()])})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, 0
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                here = np.frombuffer(block, kind)
                total, first = (here, part) if total is None else (total + here, first)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([first], pa.int64()), "block": pa.array([total.tobytes()])})

    blocks = rows.mapInArrow(run, "part bigint, block binary")
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    merged = blocks.repartition(groups, F.pmod("part", F.lit(groups))).sortWithinPartitions("part")
    table = merged.mapInArrow(add, "part bigint, block binary").toArrow().sort_by("part")
    return np.sum([np.frombuffer(b, kind) for b in table.column("block").to_pylist()], axis=0)


@dataclass
class Moments:
    """Exact count and sums of the vectors, and products with their covariance."""

    rows: DataFrame
    dims: int
    n: int
    sums: np.ndarray
    products: int = 0

    @classmethod
    def of(cls, rows: DataFrame, dims: int) -> Moments:
        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(dims + 1, np.int64)
            for batch in batches:
                out[0] += batch.num_rows
                out[1:] += _matrix(batch.column(0), dims).sum(axis=0)
            return out

        out = summed(rows.select("x"), partial, "int64")
        return cls(rows, dims, int(out[0]), out[1:])

    def centred(self) -> Callable[[pa.Array], np.ndarray]:
        n, sums, dims = self.n, self.sums, self.dims

        def of(column: pa.Array) -> np.ndarray:
            return numerators(_matrix(column, dims), n, sums).astype(np.float64) / n

        return of

    def apply(self, q: np.ndarray) -> np.ndarray:
        """V q, from one pass over all rows."""
        centred, n = self.centred(), self.n
        self.products += 1

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(q.shape)
            for batch in batches:
                x = centred(batch.column(0))
                out += x.T @ (x @ q)
            return out

        return summed(self.rows.select("x"), partial, "float64").reshape(q.shape) / n

    def trace(self) -> float:
        centred, n = self.centred(), self.n

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            return np.array([sum(float(np.square(centred(b.column(0))).sum()) for b in batches)])

        return float(summed(self.rows.select("x"), partial, "float64")[0]) / n

    def identity_error(self, transform: np.ndarray) -> float:
        """The largest entry of the covariance of ``(x - S/n) transform`` minus the identity."""
        centred, n, k = self.centred(), self.n, transform.shape[1]

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros((k + 1, k))
            for batch in batches:
                y = centred(batch.column(0)) @ transform
                out[0] += y.sum(axis=0)
                out[1:] += y.T @ y
            return out

        out = summed(self.rows.select("x"), partial, "float64").reshape(k + 1, k) / n
        return float(np.abs(out[1:] - np.outer(out[0], out[0]) - np.eye(k)).max())


def numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, exact; as Python integers where 64 bits do not hold it."""
    top = int(max(np.abs(x).max(initial=0), 1))
    if top * n + int(np.abs(sums).max(initial=0)) < 1 << 63:
        return x * n - sums
    return x.astype(object) * n - sums.astype(object)


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal ``against``."""
    kept: list[np.ndarray] = []
    for v in block.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            before = np.linalg.norm(v)
            if against.shape[1]:
                v = v - against @ (against.T @ v)
            for u in kept:
                v = v - u * (u @ v)
            after = np.linalg.norm(v)
            if after < 1e-10:
                break
            v = v / after
            if after > 0.7 * before:
                break
        else:
            after = 1.0
        if after >= 1e-10:
            kept.append(v)
    return np.array(kept).T if kept else np.zeros((block.shape[0], 0))


def minres(
    apply: Callable[[np.ndarray], np.ndarray],
    locked: np.ndarray,
    u: np.ndarray,
    theta: np.ndarray,
    residual: np.ndarray,
    steps: int,
    tolerance: float,
) -> np.ndarray:
    """Rough solutions of the projected correction equations, a column for each Ritz pair.

    The Lanczos recurrences of all columns run side by side, so that a step
    costs one product. A column ends once its residual has fallen by
    ``tolerance``.
    """

    def project(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            if locked.shape[1]:
                v = v - locked @ (locked.T @ v)
            v = v - u * np.einsum("ij,ij->j", u, v)
        return v

    v = project(-residual)
    beta = np.linalg.norm(v, axis=0)
    start = beta.copy()
    live = beta > 0
    v = np.where(live, v / np.where(live, beta, 1), 0)
    before = np.zeros_like(v)
    w_old, w = np.zeros_like(v), np.zeros_like(v)
    out = np.zeros_like(v)
    zeros, ones = np.zeros_like(beta), np.ones_like(beta)
    eta, beta_in = beta.copy(), zeros
    c_old, c, s_old, s = ones, ones, zeros, zeros
    for _ in range(steps):
        at = np.flatnonzero(live)
        if not len(at):
            break
        product = np.zeros_like(v)
        product[:, at] = apply(v[:, at]) - v[:, at] * theta[at]
        p = project(product)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - v * alpha - before * beta_in
        beta_out = np.linalg.norm(p, axis=0)
        # Givens rotations turn the tridiagonal column into (epsilon, delta, gamma).
        delta = c * alpha - c_old * s * beta_in
        gamma = np.hypot(delta, beta_out)
        side = s * alpha + c_old * c * beta_in
        epsilon = s_old * beta_in
        solid = live & (gamma > 0)
        safe = np.where(solid, gamma, 1)
        c_new, s_new = delta / safe, beta_out / safe
        w_new = np.where(solid, (v - w_old * epsilon - w * side) / safe, 0)
        out = np.where(solid, out + w_new * (c_new * eta), out)
        eta = np.where(solid, -s_new * eta, eta)
        w_old, w = w, w_new
        c_old, c, s_old, s = c, c_new, s, s_new
        live = solid & (np.abs(eta) > tolerance * start) & (beta_out > EPS * np.abs(theta))
        before, v = v, np.where(live, p / np.where(beta_out > 0, beta_out, 1), 0)
        beta_in = beta_out
    return project(out)


def jacobi_davidson(
    apply: Callable[[np.ndarray], np.ndarray],
    dims: int,
    wanted: int,
    block: int = BLOCK,
    inner_steps: int = INNER_STEPS,
    outer_steps: int = OUTER_STEPS,
    seed: int = 11,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator, falling, and their eigenvectors.

    Every returned pair has a residual of some ``dims`` roundings of the largest
    eigenvalue at most. The search ends when the largest pair outside of them is
    as precise and no larger, so none of them was passed over.
    """
    rng = np.random.default_rng(seed)
    block = min(block, dims)
    max_space = min(dims, max(MAX_SPACE, 3 * block))
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    space = orthonormal(rng.standard_normal((dims, block)), locked)
    image = apply(space)
    scale = 0.0
    for outer in range(outer_steps):
        h = space.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, ritz_image = space @ s, image @ s
        scale = max(scale, float(np.abs(theta).max(initial=0.0)))
        residual = ritz_image - ritz * theta
        if locked.shape[1]:
            residual = residual - locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        # A space that leaves nothing out cannot become better.
        precise = (size <= (dims + 16) * EPS * scale) | (space.shape[1] + locked.shape[1] == dims)
        done, finished = 0, False
        while done < len(theta) and precise[done]:
            least = np.sort(np.concatenate([values, theta[:done]]))[::-1][wanted - 1 : wanted]
            if len(least) and theta[done] <= least[0]:
                # It ends the search only if fresh directions have come in since the last lock.
                finished = done == 0
                break
            done += 1
        # Locked pairs leave the search space, the others stay.
        locked = np.hstack([locked, orthonormal(ritz[:, :done], locked)])
        values = np.concatenate([values, theta[:done]])
        room = dims - locked.shape[1]
        if finished or room == 0:
            break
        theta, ritz, ritz_image, residual, size = (a[..., done:] for a in (theta, ritz, ritz_image, residual, size))
        open_at = np.arange(min(block, len(theta), max(1, wanted - locked.shape[1])))
        grow = minres(
            apply, locked, ritz[:, open_at], theta[open_at], residual[:, open_at], inner_steps, 2.0 ** -(4 + min(outer, 20))
        )
        # What was locked is replaced by fresh directions: they hold a part of any eigenvector not yet met.
        fresh = rng.standard_normal((dims, max(done, 1 if not len(open_at) else 0)))
        grow = np.hstack([grow, fresh[:, :block]])
        keep = max(1, min(max_space, room) - grow.shape[1])
        if ritz.shape[1] + grow.shape[1] > min(max_space, room):
            ritz, ritz_image = ritz[:, :keep], ritz_image[:, :keep]
        added = orthonormal(grow, np.hstack([locked, ritz]))
        if not added.shape[1] and room > ritz.shape[1]:
            added = orthonormal(rng.standard_normal((dims, 1)), np.hstack([locked, ritz]))
        space = np.hstack([ritz, added])
        image = np.hstack([ritz_image, apply(added)]) if added.shape[1] else ritz_image
    else:
        raise RuntimeError(f"{locked.shape[1]} of {wanted} eigenpairs after {outer_steps} steps")
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], locked[:, order]


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    x: str = "x",
    components: int = COMPONENTS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector and component: its whitened coordinate and how good the fit is.

    In: ``x`` ARRAY<BIGINT>, see ``quantised``. Columns: vec_id, component
    (from 1), n, deviation, whitened, explained (share of the total variance),
    identity_error (one value).
    """
    spark = vectors.sparkSession
    importable(spark)
    work = Workspace(spark)
    usable = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(x).alias("x")).filter(
        F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull())
    )
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = work.write(usable, "vectors")
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims"))
    common = lengths.first()
    if common is None or common["dims"] == 0:
        return spark.createDataFrame([], schema)
    dims = common["dims"]
    rows = rows.filter(F.size("x") == dims)
    moments = Moments.of(rows, dims)
    trace = moments.trace()
    if not trace > 0:
        return spark.createDataFrame([], schema)
    values, directions = jacobi_davidson(moments.apply, dims, min(components, dims), block)
    solid = values > dims * EPS * values[0]
    values, directions = values[solid], directions[:, solid]
    transform = directions / np.sqrt(values)
    error = moments.identity_error(transform)
    n, sums, centred, k = moments.n, moments.sums, moments.centred(), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            y = centred(column) @ transform
            whole = numerators(_matrix(column, dims), n, sums)
            if whole.dtype != object and int(np.abs(whole).max(initial=0)) ** 2 * dims >= 1 << 63:
                whole = whole.astype(object)
            deviation = pa.array((whole * whole).sum(axis=1).tolist(), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * k), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], ["vec_id", "deviation", "y"])

    shares = F.array(*(F.lit(float(v)) for v in values / trace))
    out = rows.select("vec_id", "x").mapInArrow(run, "vec_id bigint, deviation bigint, y array<double>")
    out = out.select("vec_id", "deviation", F.posexplode("y").alias("k", "whitened"))
    return out.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
