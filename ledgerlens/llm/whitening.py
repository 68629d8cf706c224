"""Embedding whitening by Chebyshev-filtered subspace iteration.

A vector entry ``c`` becomes the whole number ``floor(64 * c) + 1000000``; the
model is fitted on every distinct vector of such numbers once. The covariance is
never formed: a pass over the distributed vectors takes a block of directions Q
to ``X'XQ / n``, X centred by the exact means before anything is multiplied.
Passes are applied as a Chebyshev polynomial of the covariance whose interval
covers the unwanted part of the spectrum, which damps that part and lifts what
lies above it. QR makes the filtered block orthonormal, Rayleigh-Ritz turns it
into approximate eigenvectors, and the residuals ``|VQ - QE|`` of the wanted ones
say when to stop. The interval runs from a lower bound of the spectrum (smallest
Ritz value of a block Krylov space less its residual; zero where a round makes
no progress) to the smallest Ritz value of the block.

What the driver holds is the block, ``dimensions x (components + guard)``
numbers, never a vector of the table; a pass sums per task, then over the tasks
by dimension.

Edge cases: rows whose vector is null, empty, or holds a null or non-finite
entry (or one that no long holds after scaling) get no result; of vectors of
different lengths only those of the greatest length count; repeated vectors are
fitted once and repeated rows are returned each; an empty table, a single
distinct vector, and directions without variance give no rows; ties between
eigenvalues leave their eigenvectors to the start block, which is fixed; null ids
are kept; other columns are not read. ``deviation`` is exact where a long holds
it, else null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import remove_scratch, scratch_path

SCALE, OFFSET = 64, 1_000_000
GUARD = 16                   # directions carried besides the wanted ones
BOUND = 8                    # images added to the block to bound the spectrum below
DEGREE = 8                   # passes of one polynomial
ROUNDS = 60                  # polynomials before the fit gives up
TOLERANCE = 1e-12            # residual of an eigenvector, relative to the largest eigenvalue
FLAT = 1e-10                 # eigenvalues below this share of the largest count as none
LARGEST = 2.0 ** 62          # scaled entries from here on count as non-finite


@dataclass(frozen=True)
class Whitening:
    """A fitted model; ``base`` holds whole numbers near the means and ``rest``
    the exact difference, so that nothing large is subtracted in floating
    point."""

    n: int
    sums: np.ndarray            # per dimension, exact
    components: np.ndarray      # dimension x component, orthonormal
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    passes: int = 0

    @property
    def base(self) -> np.ndarray:
        return self.sums // max(self.n, 1)

    @property
    def rest(self) -> np.ndarray:
        return (self.sums - self.n * self.base) / max(self.n, 1)

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues


def scaled(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vectors`` with ``x``, the whole numbers, without the rows that have
    none; vectors of less than the greatest length go."""
    own = F.transform(F.col(f"`{column}`"), lambda c: c.cast("double") * SCALE)
    kept = [F.col(f"`{c}`") for c in vectors.columns if c not in ("x", column)]
    good = F.coalesce(F.forall("_c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)), F.lit(False))
    found = vectors.select(*kept, own.alias("_c")).where(good & (F.size("_c") > 0))
    x = F.transform("_c", lambda c: F.floor(c) + OFFSET)
    return found.select(*[F.col(f"`{c}`") for c in found.columns if c != "_c"], x.alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, size)


def _summed(vectors: DataFrame, size: int, width: int,
            partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of ``partial(block)``, a ``rows x width`` matrix
    of doubles for a block of vectors: one sum a task, then by row."""
    names = [f"v{j}" for j in range(width)]
    schema = pa.schema([("i", pa.int64()), *[(name, pa.float64()) for name in names]])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = partial(_matrix(batch.column(0), size))
                total = own if total is None else total + own
        if total is not None:
            columns = [pa.array(np.arange(len(total)))] + [pa.array(np.ascontiguousarray(c)) for c in total.T]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    made = vectors.select("x").mapInArrow(sums, ", ".join(["i long", *[f"{name} double" for name in names]]))
    rows = made.groupBy("i").agg(*[F.sum(name).alias(name) for name in names]).collect()   # `rows` rows
    return np.array([list(r)[1:] for r in sorted(rows)])


def _orthonormal(q: np.ndarray) -> np.ndarray:
    return np.linalg.qr(q)[0]


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (largest first), vectors, their images, residual norms."""
    h = q.T @ vq
    e, u = np.linalg.eigh((h + h.T) / 2)
    order = np.argsort(-e)
    e, u = e[order], u[:, order]
    q, vq = q @ u, vq @ u
    return e, q, vq, np.linalg.norm(vq - q * e, axis=0)


def _filtered(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, low: float, high: float,
              top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the covariance that stays small on
    ``[low, high]``, scaled to 1 at ``top``, on the block ``q`` whose image is
    ``vq``: ``degree - 1`` passes."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (vq - middle * q) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - middle * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def top_eigenpairs(apply: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, guard: int = GUARD,
                   tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator without
    negative ones, and their eigenvectors as columns. ``apply`` takes a block
    of columns to its image. Raises where the residuals stay above
    ``tolerance`` times the largest eigenvalue."""
    wanted, width = min(wanted, size), min(wanted + guard, size)
    q = _orthonormal(np.random.default_rng(12).standard_normal((size, width)))
    image = apply(q)
    # the block and some of its images: where the spectrum ends below
    more = _orthonormal(np.hstack([q, image[:, :min(BOUND, size - width)]]))
    e, q, image, residual = _ritz(more, apply(more))
    low = max(0.0, float(e[-1] - residual[-1]))
    e, q, image, residual = e[:width], q[:, :width], image[:, :width], residual[:width]
    worst = np.inf
    for _ in range(ROUNDS):
        now = float(residual[:wanted].max())
        if now <= tolerance * max(e[0], 0.0):
            return e[:wanted], q[:, :wanted]
        if now > 0.5 * worst:
            low = 0.0                    # the bound may have been too high
        worst = min(worst, now)
        high = float(e[-1])
        if width == size or high - low <= 1e-9 * e[0]:
            block = image                # nothing to damp, or a flat rest: plain iteration
        else:
            block = _filtered(apply, q, image, low, high, float(e[0]), DEGREE)
        q = _orthonormal(block)
        e, q, image, residual = _ritz(q, apply(q))
    raise RuntimeError(f"residual {residual[:wanted].max():.3g} after {ROUNDS} rounds, eigenvalue {e[0]:.3g}")


def fit(vectors: DataFrame, components: int = 16, guard: int = GUARD) -> Whitening:
    """The model of the distinct vectors among ``vectors`` (column ``x``, from
    :func:`scaled`). The distinct vectors are written once and removed when
    the fit is done."""
    spark = vectors.sparkSession
    path = scratch_path(spark, "whitening")
    vectors.select("x").distinct().write.parquet(path)
    try:
        return _fit(spark.read.schema("x array<bigint>").parquet(path), components, guard)
    finally:
        remove_scratch(spark, path)


def _fit(distinct: DataFrame, components: int, guard: int) -> Whitening:
    size = distinct.agg(F.max(F.size("x"))).first()[0]
    if size is None:
        return Whitening(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    distinct = distinct.where(F.size("x") == size)
    rows = distinct.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("c").alias("n")).collect()      # one a dimension
    n = rows[0]["n"]
    sums = np.array([int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])], dtype=object)
    base = (sums // n).astype(np.int64)
    rest = np.array([int(s) % n for s in sums], float) / n
    passes = 0

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def partial(x: np.ndarray) -> np.ndarray:
            centred = (x - base) - rest
            return centred.T @ (centred @ q)
        return _summed(distinct, size, q.shape[1], partial) / n

    trace = float(_summed(distinct, size, 1, lambda x: np.array([[(((x - base) - rest) ** 2).sum()]]))[0, 0]) / n
    if not trace:
        return Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0, 0.0)
    e, q = top_eigenpairs(apply, size, components, guard)
    real = e > FLAT * e[0]
    e, q = e[real], q[:, real]
    scale = q / np.sqrt(e)

    def covariance(x: np.ndarray) -> np.ndarray:
        w = ((x - base) - rest) @ scale
        return np.vstack([w.T @ w, w.sum(axis=0)])
    total = _summed(distinct, size, len(e), covariance) / n
    error = total[:-1] - np.outer(total[-1], total[-1]) - np.eye(len(e))
    return Whitening(n, sums, q, e, trace, float(np.abs(error).max()), passes)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of ``(n * x - S) ** 2``; None where no long holds it."""
    rough = ((x.astype(float) * n - sums.astype(float)) ** 2).sum(axis=1)
    if float(np.abs(sums.astype(float)).max()) < 2.0 ** 62 and float(np.abs(x).max()) * n < 2.0 ** 62:
        gap = x * np.int64(n) - sums.astype(np.int64)
        exact = (gap.view(np.uint64) ** 2).sum(axis=1, dtype=np.uint64).tolist()       # modulo 2 ** 64
    else:
        exact = [None] * len(x)
    out: list[int | None] = []
    for row, about, value in zip(x, rough.tolist(), exact):
        if value is None or 9.0e18 < about < 9.5e18:
            value = sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums))
            about = float(value)
        out.append(value if about < 9.5e18 and value < 2 ** 63 else None)
    return out


OUTPUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """A row per vector (``vec_id``, ``x``) and component; no shuffle."""
    size, k = model.components.shape
    base, rest = model.base.astype(np.int64) if size else None, model.rest.astype(float) if size else None
    scale = model.components / np.sqrt(model.eigenvalues) if k else None
    explained = model.explained

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = _matrix(batch.column(1), size)
            deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64())
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)), deviation.take(each),
                pa.array((((x - base) - rest) @ scale).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, model.identity_error))], schema=OUTPUT)

    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "x").where(F.size("x") == size)
    return own.mapInArrow(rows, "vec_id long, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")


def whiten(table: DataFrame, components: int = 16, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained,
    identity_error``: the fit runs while the plan is built."""
    vectors = scaled(table.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{column}`").alias("_vector")), "_vector")
    return transform(vectors, fit(vectors, components))
