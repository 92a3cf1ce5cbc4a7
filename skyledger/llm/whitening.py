"""Embedding whitening: leading eigenpairs of the covariance by Jacobi-Davidson, without ever forming the covariance.

Vectors become whole numbers x, written once. Their sums S and the number n are exact, so n * x - S, the centred vector
times n, is exact too. The covariance V is only ever applied: each task multiplies its centred rows with a block of
directions and back, and the d rows of the products of all tasks are added up by a shuffle on the dimension. The driver
holds blocks of d by a few dozen numbers and never a row of the table.

Block Jacobi-Davidson for the largest eigenvalues:
- Rayleigh-Ritz: V restricted to the search space gives Ritz values and vectors; products of basis vectors are kept.
- Ritz pairs whose residual is at most ``RESIDUAL`` times the largest eigenvalue are locked, and everything after stays
  orthogonal to them.
- For each wanted pair that is not locked, the correction equation (V - theta) t = -r, projected to the complement of the
  locked and of all wanted Ritz vectors, is solved roughly by ``INNER_STEPS`` steps of MINRES. All pairs step together, so a
  step is one pass over the table for all of them.
- Corrections join the search space; when it would outgrow ``SPACE`` times the wanted pairs, it starts again from the
  best Ritz vectors.
It ends when every wanted pair is locked, and raises after ``ROUNDS`` rounds without that. Starting directions come from a
fixed seed. A search space of all dimensions makes every residual vanish, so small dimensions take few rounds.

Vectors that are null or hold null or non-finite entries take no part. Vectors of different lengths are whitened apart,
each length by its own fit (a length of 0 gives no rows); lengths are a property of models, and few. An entry is floor(64 * c)
+ 1,000,000, and must lie within 2^52 of zero, else the job fails and says so. Components whose eigenvalue is zero to
double precision (fewer different vectors than dimensions, constant entries) cannot be whitened and have no rows. Repeated
rows, repeated and null ids are rows of their own, and all are part of the fit. ``deviation`` is exact as decimal(38,0);
as a long it is null where it does not fit. Other columns are not read and may have any names; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import small_batches, table
from skyledger.session import written

COMPONENTS = 32
INNER_STEPS = 4
#: Directions more than the wanted ones that the search starts with, and its largest size as a multiple of the wanted ones.
GUARDS = 8
SPACE = 4
ROUNDS = 200
#: A pair is done when its residual is this small against the largest eigenvalue: rounding of a double, summed up.
RESIDUAL = 2e-14
#: Eigenvalues below this share of the largest one are zero.
ZERO = 1e-13
#: Vectors that a task multiplies at once.
ROWS = 4096

_SPAN = 1 << 52


def whole_numbers(vectors: DataFrame, vector: str, keep: tuple[str, ...]) -> DataFrame:
    """The vectors that take part as arrays of long ``x``, beside the ``keep`` columns named ``_0``, ``_1`` and so on."""
    entry = F.col("v")
    fine = F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = F.transform(entry, lambda c: F.floor(c * 64).cast("double") + 1_000_000)
    wide = F.exists(scaled, lambda c: F.abs(c) > _SPAN)
    checked = F.when(wide, F.raise_error(F.lit("an entry of a vector is too large to be whitened"))).otherwise(scaled)
    rows = vectors.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(vector).cast("array<double>").alias("v"))
    return rows.where(fine).select(*[f"_{i}" for i in range(len(keep))], checked.cast("array<long>").alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim)


def _blocks(batches: Iterator[pa.RecordBatch], column: int, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, _matrix(part.column(column), dim)


def _summed(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], dim: int, width: int, kind: str = "double") -> np.ndarray:
    """Sum of the matrices of ``width`` columns that ``work`` makes of blocks of vectors: first in each task, then by row number."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, 0, dim):
            made = work(x)
            total = made if total is None else total + made
        if total is not None:
            columns = [pa.array(np.arange(len(total)), pa.int32()), *(pa.array(c) for c in total.T.astype(dtype))]
            yield pa.RecordBatch.from_arrays(columns, ["i", *(f"s{j}" for j in range(width))])

    schema = ", ".join(["i int", *(f"s{j} {kind}" for j in range(width))])
    sums = rows.select("x").mapInArrow(run, schema).groupBy("i").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)])
    out = sums.toArrow().sort_by("i")
    return np.stack([np.asarray(out.column(j + 1)) for j in range(width)], axis=1)


@dataclass(frozen=True)
class Centre:
    """The number of vectors and their exact sums S = n * base + rest, with 0 <= rest < n."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame, dim: int) -> Centre:
        def work(x: np.ndarray) -> np.ndarray:
            # In two halves, so that sums of large numbers fit.
            return np.stack([np.append((x >> 20).sum(axis=0), 0), np.append((x & 0xFFFFF).sum(axis=0), len(x))], axis=1)

        high, low = (list(map(int, column)) for column in _summed(rows, work, dim, 2, "long").T)
        n = low.pop()
        sums = [(h << 20) + v for h, v in zip(high, low, strict=False)]
        return cls(n, np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=np.int64))

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n * x - S; as Python numbers where a long could overflow."""
        y = x - self.base
        if int(np.abs(y).max(initial=0)) + 1 >= (1 << 62) // self.n:
            y = y.astype(object)
        return y * self.n - self.rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from whole numbers, so that nothing is lost by the subtraction."""
        return (self.exact(x) / self.n).astype(np.float64)


def covariance(rows: DataFrame, centre: Centre, dim: int) -> Callable[[np.ndarray], np.ndarray]:
    """The covariance of the written vectors as something that multiplies a block of directions."""

    def times(block: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            u = centre.centred(x)
            return u.T @ (u @ block)

        return _summed(rows, work, dim, block.shape[1]) / centre.n

    return times


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``against``, which is orthonormal."""
    for _ in range(2):
        block = block - against @ (against.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
        left, values, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, values > 1e-8]
    return block


def minres(times: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, shifts: np.ndarray, outside: np.ndarray, steps: int) -> np.ndarray:
    """Steps of MINRES for (A - shift) t = rhs in the complement of ``outside``, one system a column, all in step."""

    def project(v: np.ndarray) -> np.ndarray:
        return v - outside @ (outside.T @ v)

    tiny = np.finfo(float).tiny
    v = project(project(rhs))
    beta = np.linalg.norm(v, axis=0)
    v = v / np.maximum(beta, tiny)
    before, eta = np.zeros_like(v), beta.copy()
    w, w_before = np.zeros_like(v), np.zeros_like(v)
    c, c_before, s, s_before = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    found, link = np.zeros_like(v), np.zeros_like(beta)
    scale = np.maximum(np.abs(shifts), tiny)
    for _ in range(steps):
        # Lanczos: the next direction of each system.
        p = project(times(v) - v * shifts - before * link)
        alpha = np.sum(v * p, axis=0)
        p = project(p - v * alpha)
        following = np.linalg.norm(p, axis=0)
        # Rotations take the new column of the tridiagonal matrix to its triangle.
        delta = c * alpha - c_before * s * link
        top = np.hypot(delta, following)
        second, third = s * alpha + c_before * c * link, s_before * link
        live = top > 1e-14 * scale
        divisor = np.where(live, top, 1)
        c_before, c = c, np.where(live, delta / divisor, 1)
        s_before, s = s, np.where(live, following / divisor, 0)
        w_before, w = w, np.where(live, (v - third * w_before - second * w) / divisor, 0)
        found = found + c * eta * w * live
        eta = -s * eta
        before, v, link = v, p / np.maximum(following, tiny), following
        if not np.any(following > 1e-14 * scale):
            break
        v = np.where(following > 1e-14 * scale, v, 0)
    return project(found)


def leading(times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns, by Jacobi-Davidson."""
    wanted = min(wanted, dim)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    most = min(dim, max(SPACE * wanted, wanted + 2 * GUARDS))
    start = np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + GUARDS)))
    basis = _orthonormal(start, locked)
    products = times(basis)
    for _ in range(ROUNDS):
        inner = basis.T @ products
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, products = basis @ turn, products @ turn
        open_pairs = min(wanted - len(values), basis.shape[1])
        ritz, value = basis[:, :open_pairs], theta[:open_pairs]
        residual = products[:, :open_pairs] - ritz * value
        residual = residual - locked @ (locked.T @ residual)
        largest = max([*values, *theta[:1], np.finfo(float).tiny])
        done = np.linalg.norm(residual, axis=0) <= RESIDUAL * largest * np.sqrt(dim)
        # A space that is the whole complement has nothing to add to a pair, whatever rounding leaves of the residual.
        done |= basis.shape[1] + len(values) >= dim
        if done.any():
            locked = np.concatenate([locked, ritz[:, done]], axis=1)
            values = np.concatenate([values, value[done]])
            rest = np.ones(basis.shape[1], dtype=bool)
            rest[:open_pairs] = ~done
            basis, products = basis[:, rest], products[:, rest]
            ritz, value, residual = ritz[:, ~done], value[~done], residual[:, ~done]
        if len(values) >= wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        outside = np.concatenate([locked, ritz], axis=1)
        correction = minres(times, -residual, value, outside, INNER_STEPS)
        if basis.shape[1] + ritz.shape[1] + len(values) > most and basis.shape[1] > wanted + GUARDS:
            kept = wanted - len(values) + GUARDS
            basis, products = basis[:, :kept], products[:, :kept]
        new = _orthonormal(correction, np.concatenate([locked, basis], axis=1))
        if not new.shape[1]:  # nothing new within rounding: look elsewhere
            new = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((dim, GUARDS)), np.concatenate([locked, basis], axis=1))
        basis, products = np.concatenate([basis, new], axis=1), np.concatenate([products, times(new)], axis=1)
    raise RuntimeError(f"{wanted - len(values)} of {wanted} eigenpairs still have a residual after {ROUNDS} rounds")


def _squares(y: np.ndarray) -> pa.Array:
    """Exact sums of the squares of the rows of whole numbers, as decimals."""
    if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 1 << 62:
        return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(sum(int(v) ** 2 for v in row)) for row in y], pa.decimal128(38, 0))


def _whitened(rows: DataFrame, dim: int, keep: int, components: int) -> DataFrame | None:
    centre = Centre.of(rows, dim)
    n = centre.n
    trace = float(_summed(rows, lambda x: np.sum(centre.centred(x) ** 2).reshape(1, 1), dim, 1)[0, 0]) / n
    if not trace:
        return None
    values, vectors = leading(covariance(rows, centre, dim), dim, components)
    fit = values > ZERO * values[0]
    values, vectors = values[fit], vectors[:, fit]
    spread = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centre.centred(x) @ spread
        return np.concatenate([w.T @ w, w.sum(axis=0)[None]])

    total = _summed(rows, moments, dim, len(values)) / n
    # The vectors were centred before they were projected; what rounding leaves of the mean goes too.
    error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(len(values))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, keep, dim):
            w = centre.centred(x) @ spread
            offsets = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
            made = [_squares(centre.exact(x)), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))]
            yield pa.RecordBatch.from_arrays([*part.columns[:keep], *made], [*part.schema.names[:keep], "deviation", "w"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:keep])
    out = rows.mapInArrow(run, f"{kept}{', ' * bool(kept)}deviation decimal(38,0), w array<double>")
    out = out.select(*out.columns[:keep], "deviation", F.posexplode("w").alias("at", "whitened"))
    explained = F.element_at(F.array(*[F.lit(float(e)) for e in values / trace]), F.col("at") + 1)
    return out.select(
        *out.columns[:keep],
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def whiten(vectors: DataFrame, keep: tuple[str, ...] = ("vec_id",), vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The ``keep`` columns of each vector for each component, with its whitened coordinate and the fit's figures."""
    small_batches(vectors.sparkSession)
    rows = written(whole_numbers(vectors, vector, keep), "whitening-vectors")
    lengths = sorted(r.d for r in rows.groupBy(F.size("x").alias("d")).count().collect() if r.d)
    parts = []
    for dim in lengths:
        own = rows if len(lengths) == 1 else rows.where(F.size("x") == dim)
        parts.append(_whitened(own, dim, len(keep), components))
    parts = [p for p in parts if p is not None]
    if not parts:
        figures = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
        parts = [vectors.sparkSession.createDataFrame([], f"{kept}{', ' * bool(kept)}{figures}")]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *out.columns[len(keep) :])


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
