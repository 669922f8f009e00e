"""Whitening of embeddings by the leading components of their covariance, which is never formed.

The components come from a block Jacobi-Davidson iteration.  The driver holds a
few vectors of the embeddings' dimension; every product with the covariance is
one pass of all tasks over the centred vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, table

COMPONENTS, SCALE = 4, 256
EPS = float(np.finfo(float).eps)
# Rows that are multiplied at once, and partial sums of tasks that are added at once.
CHUNK, FAN = 4096, 64


def quantised(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id, x`` of the rows whose vector is there and has finite entries only; x is floor(scale * entry), as long."""
    c = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.transform(c, lambda v: F.floor(v * float(scale)).cast("long"))
    return embeddings.where(finite & (F.size(c) > 0)).select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class Centred:
    """The distinct vectors of a table less their mean, to be summed over in passes of all tasks."""

    def __init__(self, fit: DataFrame, d: int) -> None:
        self.fit, self.d = fit, d
        self.n, parts = fit.select(F.spark_partition_id().alias("part")).agg(F.count("*"), F.max("part")).first()
        self.parts = (parts or 0) + 1
        self.sums = self._sums()
        # x - S/n as a whole number less a fraction, so that nothing is lost for large x
        self.whole = np.array([s // self.n for s in self.sums], np.int64) if self.n else np.zeros(d, np.int64)
        self.part = np.array([s % self.n / self.n for s in self.sums]) if self.n else np.zeros(d)

    def _sums(self) -> list[int]:
        d = self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(d, object)
            for b in batches:
                x = matrix(b.column("x"), d)
                for at in range(0, len(x), CHUNK):
                    some = x[at:at + CHUNK]
                    big = len(some) and max(int(some.max()), -int(some.min())) >= 1 << 48
                    total = total + (some.astype(object) if big else some).sum(axis=0).astype(object)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([str(int(s)) for s in total])], ["k", "s"])

        rows = self.fit.mapInArrow(run, "k int, s string").groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        return [int(r.s) for r in rows.orderBy("k").collect()] if self.n else [0] * d

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        whole, part = self.whole, self.part
        return lambda x: (x - whole).astype(float) - part

    def summed(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``work(centred rows)`` over all rows.

        Tasks add chunk by chunk with compensation, and their sums are added in
        the order of the tasks, 64 at a time, so a pass gives the same again.
        """
        d, centre = self.d, self.centre()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = lost = 0.0
            for b in batches:
                x = matrix(b.column("x"), d)
                for at in range(0, len(x), CHUNK):
                    more = work(centre(x[at:at + CHUNK])) - lost
                    new = total + more
                    total, lost = new, (new - total) - more
            part = TaskContext.get().partitionId()
            out = [] if isinstance(total, float) else [total.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(out), pa.int64()), pa.array(out, pa.binary())], ["part", "sum"])

        def add(sums: pd.DataFrame) -> pd.DataFrame:
            sums = sums.sort_values("part")
            return pd.DataFrame({"part": [int(sums["part"].iloc[0]) // FAN], "sum": [_added(sums["sum"])]})

        rows, parts = self.fit.mapInArrow(run, "part long, sum binary"), self.parts
        while parts > FAN:
            rows, parts = rows.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(add, "part long, sum binary"), -(-parts // FAN)
        got = sorted((r.part, bytes(r.sum)) for r in rows.collect())
        return np.frombuffer(_added([s for _, s in got]))

    def times(self, u: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``u``: one pass."""
        return self.summed(lambda c: (c.T @ (c @ u)).ravel()).reshape(u.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda c: np.array([np.einsum("ij,ij->", c, c)]))[0]) / self.n

    def identity_error(self, vectors: np.ndarray, values: np.ndarray) -> float:
        """Largest absolute entry of the whitened vectors' covariance less the identity: one pass."""
        k = len(values)

        def work(c: np.ndarray) -> np.ndarray:
            w = c @ vectors / np.sqrt(values)
            return (w.T @ w).ravel()

        return float(np.abs(self.summed(work).reshape(k, k) / self.n - np.eye(k)).max())


def _added(sums) -> bytes:
    total = 0.0
    for s in sums:
        total = total + np.frombuffer(s)
    return total.tobytes()


def _orthonormal(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``t`` orthogonal to ``bases``; what is (nearly) in these is left out."""
    out = np.zeros((len(t), 0))
    for v in t.T:
        size = np.linalg.norm(v)
        for _ in range(3):
            for b in (*bases, out):
                v = v - b @ (b.T @ v)
        left = np.linalg.norm(v)
        if size and left > 1e-10 * size:
            v = v / left
            for b in (*bases, out):
                v = v - b @ (b.T @ v)
            out = np.column_stack([out, v / np.linalg.norm(v)])
    return out


def minres(times: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, rtol: float, steps: int) -> np.ndarray:
    """Solutions of symmetric (also indefinite) systems, one a column of ``rhs``, in lockstep: a product a step for all."""
    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=np.broadcast_to(b != 0, np.broadcast(a, b).shape))

    x, w0, w1, v0 = (np.zeros_like(rhs) for _ in range(4))
    size = beta = np.linalg.norm(rhs, axis=0)
    v, eta = over(rhs, beta), beta.copy()
    c0, c1, s0, s1 = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        if (np.abs(eta) <= rtol * size).all():
            break
        av = times(v)
        alpha = (v * av).sum(axis=0)
        new = av - alpha * v - beta * v0
        after = np.linalg.norm(new, axis=0)
        delta = c1 * alpha - c0 * s1 * beta
        rho1, rho2, rho3 = np.hypot(delta, after), s1 * alpha + c0 * c1 * beta, s0 * beta
        c0, c1, s0, s1 = c1, over(delta, rho1), s1, over(after, rho1)
        w = over(v - rho3 * w0 - rho2 * w1, rho1)
        x, eta = x + c1 * eta * w, -s1 * eta
        v0, v, w0, w1, beta = v, over(new, after), w1, w, after
    return x


def jacobi_davidson(times: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 0, most: int = 500, inner: int = 3,
                    wide: int = 120) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) of a symmetric positive matrix of order ``d`` and their unit vectors.

    ``times`` multiplies the columns of a block.  A subspace gives Ritz pairs;
    the leading one is locked once its residual is at double precision.  For
    the other wanted ones the correction equations, projected against the locked
    vectors and the pair's own, are solved by MINRES together, and their
    solutions and the residuals widen the subspace, which is cut to its best Ritz
    vectors when it has grown ``wide``.  ``inner`` MINRES steps are enough: a
    step costs as much as a product with the widened subspace.
    """
    k = min(k, d)
    locked = np.zeros((d, 0))
    q = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, 2 * k + 2))))
    q = _orthonormal(np.column_stack([times(q), q]))[:, :q.shape[1]]
    aq, best, stuck = times(q), np.inf, 0
    for _ in range(most):
        h = q.T @ aq
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        q, aq = q @ s, aq @ s
        r = aq - q * theta
        size = np.linalg.norm(r, axis=0)
        tol = 4 * EPS * max(abs(theta[0]), np.linalg.norm(aq[:, 0])) * np.sqrt(d)
        full = q.shape[1] + locked.shape[1] == d
        wanted = k - locked.shape[1]
        stuck = stuck + 1 if size[0] > best / 2 else 0
        best = min(best, size[0])
        done = 0
        while done < wanted and (size[done] <= tol or full or (done == 0 and stuck >= 8 and size[0] <= 100 * tol)):
            done += 1
        if done:  # locking
            locked = np.column_stack([locked, q[:, :done]])
            q, aq, theta, r, size = q[:, done:], aq[:, done:], theta[done:], r[:, done:], size[done:]
            wanted, best, stuck = wanted - done, np.inf, 0
        if not wanted:
            break
        if not q.shape[1]:
            q = _orthonormal(np.random.default_rng(seed + 1).standard_normal((d, min(k, d - locked.shape[1]))), locked)
            aq = times(q)
            continue
        if stuck == 4:  # rounding may have gathered in the products
            aq = times(q)
        act = [j for j in range(min(wanted, q.shape[1])) if size[j] > tol] or [0]
        u, th = q[:, act], theta[act]

        def project(t: np.ndarray) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - u * (u * t).sum(axis=0)

        t = minres(lambda v: project(times(v) - th * v), -project(r[:, act]), 0.1, inner)
        keep = wide // 2 if q.shape[1] + 2 * len(act) > wide else q.shape[1]
        q, aq = q[:, :keep], aq[:, :keep]
        t = _orthonormal(np.column_stack([project(t), r[:, act]]), locked, q)
        if t.shape[1]:
            q, aq = np.column_stack([q, t]), np.column_stack([aq, times(t)])
        else:  # nothing new: only rounding is left, products anew
            aq, stuck = times(q), stuck + 1
    locked = np.column_stack([locked, q])[:, :k] if locked.shape[1] < k else locked
    h = locked.T @ times(locked)
    theta, s = np.linalg.eigh((h + h.T) / 2)
    return theta[::-1], locked @ s[:, ::-1]


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """Every usable row's coordinates on the leading principal components, each over its standard deviation.

    A vector is usable if neither it nor an entry of it is null, NaN or infinite,
    and it isn't empty; of several lengths the most frequent one counts (of
    equally frequent ones the longest), other vectors are dropped.  Entries
    become x = floor(scale * entry), beyond the range of long its end.  Mean and
    covariance are those of the distinct x.  Returns ``id_col, component`` (from
    1), ``n`` (distinct x), ``deviation`` (sum of (n x - S)^2, exact; null where it
    is no long), ``whitened``, ``explained`` (the component's share of the
    variance) and ``identity_error``.  Components without variance are left out:
    an empty table, or one with a single distinct vector, gives no rows.
    Repeated rows and null ids keep their rows; other columns are ignored.
    """
    kind = embeddings.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    rows = materialise(quantised(embeddings, id_col, vec_col, scale), "whiten-rows")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    none = embeddings.sparkSession.createDataFrame([], schema)
    if lengths is None:
        return none
    d = lengths.d
    rows = rows.where(F.size("x") == d)
    fit = Centred(materialise(rows.select("x").distinct().sortWithinPartitions("x"), "whiten-fit"), d)
    trace = fit.trace()
    if not trace:
        return none
    values, vectors = jacobi_davidson(fit.times, d, components)
    some = values > d * EPS * trace
    values, vectors = values[some], vectors[:, some]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(len(values))] < 0, -1.0, 1.0)
    error = fit.identity_error(vectors, values)
    axes, shares, k = vectors / np.sqrt(values), values / trace, len(values)
    n, sums, centre = fit.n, fit.sums, fit.centre()

    def deviations(x: np.ndarray) -> list[int | None]:
        most = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums))
        fits = most * most * d < 1 << 63
        gap = x * n - np.array(sums) if fits else x.astype(object) * n - np.array(sums, object)
        return [int(v) if v < 1 << 63 else None for v in (gap * gap).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            x = matrix(b.column("x"), d)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n)),
                 pa.array(deviations(x), pa.int64()).take(each), pa.array((centre(x) @ axes).ravel()),
                 pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))], schema.names)

    return rows.select("id", "x").mapInArrow(run, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whitened on the four leading components of the distinct ones."""
    return whiten(table(spark, sf_dir, "embeddings"))
