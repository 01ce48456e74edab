"""Embedding whitening by a block Jacobi-Davidson method over distributed products.

The covariance V of the distinct vectors is never formed. Spark multiplies it with a few columns at
a time: every task centres its vectors, multiplies them with the columns and then with the results,
and only the sums (dimension x columns) come back, over a bounded number of groups of tasks. The
driver holds the search space alone: ``LARGEST`` blocks of columns of one dimension each.

1. Rayleigh-Ritz on the search space gives values, vectors and residuals without a new product,
   since the products of its columns are kept beside them.
2. Pairs whose residual is down to double precision are locked; the space stays orthogonal to them.
3. For the others, the correction equation, projected away from all locked and current vectors, is
   solved by a few MINRES steps with a shift per column; one product serves all columns.
4. The corrections join the space. A full space restarts from its best Ritz vectors.

A few more pairs than wanted are sought, so that a wanted pair is not missed while later ones lock.

Cases with a defined result: rows go whose vector is null or holds a null or non-finite entry, and
rows whose vector is not of the most frequent length (the longest such). Repeated vectors count
once in the fit, each row gets its scores. Entries are cut at +-2^40. Components end where the
eigenvalue is zero to working precision (``FLOOR`` of the trace), so one distinct vector or an empty
table give no rows. ``deviation`` is null beyond the range of a long. Null ids stay; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, durable

#: Components wanted, pairs sought beside them, and steps of the inner solver.
COMPONENTS, GUARD, INNER = 16, 4, 6
#: Blocks of columns in the search space before it restarts.
LARGEST = 6
#: Residuals against the largest eigenvalue that count as double precision, per square root of the dimension.
PRECISION = 4 * np.finfo(float).eps
#: Eigenvalues under this part of the trace count as zero.
FLOOR = 1e-11
#: Vectors that a task multiplies at once, groups of tasks whose sums reach the driver.
CHUNK, GROUPS = 8_192, 256
_SCALE, _SHIFT, _CUT = 64, 1_000_000, float(1 << 40)
_OUTER = 200


def _entries(vectors: Column) -> Column:
    """The vector as whole numbers."""
    return F.transform(vectors, lambda v: F.floor(F.greatest(F.lit(-_CUT), F.least(F.lit(_CUT), v)) * _SCALE) + _SHIFT)


def whole_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of the rows that can be used, x as an array of longs."""
    known = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    known = known.filter(F.col("v").isNotNull() & ~bad)
    usual = known.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    return known.filter(F.size("v") == (usual["d"] if usual else 0)).select("id", _entries(F.col("v")).alias("x"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of a batch end to end in as few bytes each as they allow."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK).column("x")
            x = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            narrow = len(x) and abs(x - _SHIFT).max() < 1 << 31
            raw = (x - _SHIFT).astype("<i4" if narrow else "<i8").tobytes()
            yield pa.record_batch({"rows": pa.array([len(part)], pa.int64()), "raw": pa.array([raw], pa.binary())})


def _unpack(raw: bytes, rows: int, d: int) -> np.ndarray:
    kind = "<i4" if len(raw) == 4 * rows * d else "<i8"
    return np.frombuffer(raw, dtype=kind).astype(np.int64).reshape(rows, d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S as whole numbers, over n: each entry is rounded once. ``x`` has no shift."""
    shifted = np.array([s - n * _SHIFT for s in sums], dtype=object)
    if max([abs(int(s)) for s in shifted] + [n * int(np.abs(x).max(initial=0))]) < 1 << 62:
        return (n * x - shifted.astype(np.int64)) / n
    return ((n * x.astype(object) - shifted) / n).astype(float)


@dataclass
class Fit:
    """The distinct vectors (packed, in the shared folder), their number, dimension and sums."""
    packed: DataFrame
    n: int
    d: int
    sums: list[int]

    def total(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``of`` over chunks of centred vectors. Tasks add their chunks in order, groups
        of tasks are added in order, so a task that runs again changes nothing."""
        n, d, sums = self.n, self.d, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for rows, raw in zip(batch.column("rows").to_pylist(), batch.column("raw")):
                    here = of(_centred(_unpack(raw.as_py(), rows, d), n, sums))
                    total = here if total is None else total + here
            if total is not None:
                yield pa.record_batch({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "raw": pa.array([total.tobytes()], pa.binary())})

        def add(group: pa.Table) -> pa.Table:
            group = group.sort_by("part")
            parts = [np.frombuffer(r, dtype=float) for r in group.column("raw").to_pylist()]
            return pa.table({"part": group.column("part")[:1], "raw": pa.array([sum(parts[1:], parts[0]).tobytes()], pa.binary())}, schema=group.schema)

        found = self.packed.mapInArrow(run, "part int, raw binary")
        if self.packed.rdd.getNumPartitions() > GROUPS:
            found = found.groupBy(F.col("part") % GROUPS).applyInArrow(add, "part int, raw binary")
        rows = sorted(found.collect())
        return sum((np.frombuffer(r.raw, dtype=float) for r in rows[1:]), np.frombuffer(rows[0].raw, dtype=float).copy())

    def product(self, columns: np.ndarray) -> np.ndarray:
        """V times the columns, in one pass over the vectors."""
        return self.total(lambda x: (x.T @ (x @ columns)).ravel()).reshape(columns.shape) / self.n


def fit_list(vectors: DataFrame) -> Fit | None:
    """The distinct vectors of ``whole_vectors``; none: None."""
    bounded_batches(vectors.sparkSession)
    packed = durable(vectors.select("x").distinct().mapInArrow(_pack, "rows long, raw binary"), "whitening-vectors")
    first = packed.filter("rows > 0").select("rows", "raw").limit(1).collect()
    if not first or not first[0].raw:
        return None
    size = vectors.select(F.size("x").alias("d")).first().d

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw in zip(batch.column("rows").to_pylist(), batch.column("raw")):
                x = _unpack(raw.as_py(), rows, size)
                yield pa.record_batch({"n": pa.array([rows] * size, pa.int64()), "j": pa.array(np.arange(size), pa.int32()), "s": pa.array(x.sum(axis=0), pa.int64())})

    exact = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    rows = packed.mapInArrow(sums, "n long, j int, s long").groupBy("j").agg(F.sum("n").alias("n"), exact).orderBy("j").collect()
    n = rows[0].n
    return Fit(packed, n, size, [int(r.s) + n * _SHIFT for r in rows])


def _orthonormal(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The block's columns against the bases and each other; columns that depend on them go."""
    out = np.zeros((block.shape[0], 0))
    for column in block.T:
        length = np.linalg.norm(column)
        if not length > 0:
            continue
        column = column / length
        for _ in range(3):
            for basis in (*bases, out):
                column = column - basis @ (basis.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out


def _minres(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on (V - shift) x = right for each column at once; every step is one product. A column
    whose Krylov space is exhausted stops."""
    x, w, w_old = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    v, v_old = np.divide(right, beta, out=np.zeros_like(right), where=live), np.zeros_like(right)
    eta, start = beta.copy(), beta.copy()
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        a = product(v) - v * shifts
        alpha = (v * a).sum(axis=0)
        a = a - v * alpha - v_old * beta
        beta_new = np.linalg.norm(a, axis=0)
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, beta_new)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        live &= rho > 1e-14 * start
        safe = np.where(live, rho, 1.0)
        c_old, s_old, c, s = c, s, delta / safe, beta_new / safe
        w, w_old = (v - w_old * rho3 - w * rho2) / safe, w
        x = np.where(live, x + w * (c * eta), x)
        eta = -s * eta
        live &= (beta_new > 1e-14 * start) & (abs(eta) > 1e-3 * start)
        v, v_old = np.divide(a, beta_new, out=np.zeros_like(a), where=beta_new > 0), v
        beta = beta_new
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int = COMPONENTS, guard: int = GUARD, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the largest ``wanted`` eigenpairs of the symmetric operator behind
    ``product`` (d x k to d x k), by falling value; d of them if there are no more. The residual of
    every pair is at double precision against the largest value."""
    block = min(d, wanted + guard)
    wanted = min(d, wanted)
    q = np.eye(d) if block == d else np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    w = product(q)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    for _ in range(_OUTER):
        h = q.T @ w
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        top = max([*values, *theta[:1], 0.0])
        k = min(len(theta), block - len(values))
        u, r = q @ y[:, :k], w @ y[:, :k] - (q @ y[:, :k]) * theta[:k]
        r = r - locked @ (locked.T @ r)
        good = np.linalg.norm(r, axis=0) <= PRECISION * np.sqrt(d) * top + np.finfo(float).tiny
        whole = q.shape[1] + locked.shape[1] == d
        # Pairs lock from the largest on: one behind a pair that still moves may not be its turn.
        ready = k if whole else int(np.argmin(good)) if not good.all() else k
        if ready:
            locked, values = np.column_stack([locked, u[:, :ready]]), np.concatenate([values, theta[:ready]])
            q, w = q @ y[:, ready:], w @ y[:, ready:]
            u, r, theta = u[:, ready:], r[:, ready:], theta[ready:]
        if len(values) >= wanted:
            order = np.argsort(-values, kind="stable")[:wanted]
            return values[order], locked[:, order]
        k -= ready
        away = np.column_stack([locked, u])
        project = lambda b: b - away @ (away.T @ b)
        t = _minres(lambda b: project(product(project(b))), theta[:k], -project(r[:, :k]), INNER)
        if q.shape[1] + k > LARGEST * block:
            if not ready:
                q, w = q @ y, w @ y
            q, w = q[:, :2 * block], w[:, :2 * block]
        fresh = _orthonormal(np.column_stack([t, r[:, :k]]), locked, q)[:, :max(k, 1)]
        if not fresh.shape[1]:
            fresh = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((d, block)), locked, q)
        q, w = np.column_stack([q, fresh]), np.column_stack([w, product(fresh)])
    raise RuntimeError(f"eigenpairs did not settle in {_OUTER} rounds")


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each usable
    row and component; see the module for nulls, repeats and empty tables."""
    spark, name = rows.sparkSession, id_column
    kind = rows.schema[id_column].dataType.simpleString()
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = whole_vectors(rows, id_column, vector)
    fit = fit_list(vectors)
    if fit is None:
        return spark.createDataFrame([], f"`{name}` {kind}, {schema}")
    values, vecs = jacobi_davidson(fit.product, fit.d, components)
    trace = float(fit.total(lambda x: np.array([(x * x).sum()]))[0]) / fit.n
    stay = values > FLOOR * trace
    values, vecs = values[stay], vecs[:, stay]
    k, n, sums = len(values), fit.n, fit.sums
    if not k:
        return spark.createDataFrame([], f"`{name}` {kind}, {schema}")
    weights, explained = vecs / np.sqrt(values), (values / trace).tolist()

    def squares(x: np.ndarray) -> np.ndarray:
        z = x @ weights
        return (z.T @ z).ravel()

    error = float(np.abs(fit.total(squares).reshape(k, k) / n - np.eye(k)).max())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK // 4):
                part = batch.slice(at, CHUNK // 4)
                m = part.num_rows
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(m, -1) - _SHIFT
                z = _centred(x, n, sums) @ weights
                shifted = [s - n * _SHIFT for s in sums]
                widest = max([abs(s) for s in shifted] + [n * int(np.abs(x).max(initial=0))])
                if len(sums) * (2 * widest) ** 2 < 1 << 63:
                    deviation = ((n * x - np.array(shifted, dtype=np.int64)) ** 2).sum(axis=1).tolist()
                else:
                    deviation = [v if v < 1 << 63 else None for v in ((n * x.astype(object) - np.array(shifted, dtype=object)) ** 2).sum(axis=1).tolist()]
                yield pa.record_batch({name: part.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                                       "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), "n": pa.array(np.full(m * k, n), pa.int64()),
                                       "deviation": pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                                       "whitened": pa.array(z.ravel(), pa.float64()), "explained": pa.array(np.tile(explained, m), pa.float64()),
                                       "identity_error": pa.array(np.full(m * k, error), pa.float64())})

    return vectors.mapInArrow(score, f"`{name}` {kind}, {schema}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: whitened scores of every usable row of ``embeddings``."""
    return whiten(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet").select("vec_id", "embedding"))
