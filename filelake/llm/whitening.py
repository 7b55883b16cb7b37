"""Whitening of vectors: pivoted Cholesky of the centred scatter, one-sided Jacobi on its triangular factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
# Entries beyond this are set to it, so that sums of integers stay exact.
LARGEST = float(1 << 31)
# Rows and columns of the scatter that leave a task as one row.
TILE = 256
# Vectors of which a task holds doubles at a time.
BLOCK = 4096


@dataclass(frozen=True)
class Fit:
    """Statistics of the fit list and the components, as columns of ``directions``."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    directions: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n`` as doubles. The whole part of the mean is taken off first, without rounding."""
        whole, rest = np.divmod(self.sums, self.n)
        return (x - whole).astype(np.float64) - rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of ``(n x - sums) ** 2`` of every row; None where it is no 64-bit number."""
        whole, rest = np.divmod(self.sums, self.n)
        far = x - whole
        largest = self.n * (int(np.abs(far).max(initial=0)) + 1)
        if largest * largest * max(self.size, 1) < 1 << 63:
            return ((self.n * far - rest) ** 2).sum(axis=1).tolist()
        exact = self.n * far.astype(object) - rest.astype(object)
        return [v if v < 1 << 63 else None for v in (exact * exact).sum(axis=1).tolist()]


def usable(vector: Column) -> Column:
    """True for vectors that take part: not null or empty, no entry null or not finite."""
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def scaled(rows: pa.Array, size: int) -> np.ndarray:
    """The entries of usable vectors as integers."""
    entries = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, scaled(part.column("vector"), size)


TILES = "tile int, part binary"


def _total(vectors: DataFrame, size: int, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the matrices that ``of_block`` makes of their integers.

    Tasks add their blocks and return tiles of whole rows; these are added tile by tile, and the driver gets
    the one matrix, whatever the number of rows.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, size):
            own = of_block(x)
            total = own if total is None else total + own
        if total is not None:
            tiles = [total[i : i + TILE].tobytes() for i in range(0, len(total), TILE)]
            yield pa.record_batch({"tile": pa.array(range(len(tiles)), pa.int32()), "part": pa.array(tiles, pa.binary())})

    # One row is enough to know the kind of number and the width.
    like = of_block(np.full((1, size), OFFSET, dtype=np.int64))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for tile, part in zip(batch.column("tile").to_pylist(), batch.column("part").to_pylist()):
                values = np.frombuffer(part, like.dtype)
                total[tile] = total[tile] + values if tile in total else values
        if total:
            yield pa.record_batch({
                "tile": pa.array(list(total), pa.int32()), "part": pa.array([t.tobytes() for t in total.values()], pa.binary()),
            })

    rows = vectors.mapInArrow(parts, TILES).repartition("tile").mapInArrow(add, TILES).collect()
    whole = b"".join(bytes(r["part"]) for r in sorted(rows, key=lambda r: r["tile"]))
    return np.frombuffer(whole, like.dtype).reshape(like.shape)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``f`` with ``a = f @ f.T``: columns of a triangular factor, rows in the order of ``a``.

    The largest remaining diagonal entry is the next pivot. It ends where that is rounding error, so a scatter
    without full rank gives fewer columns.
    """
    rest = np.diag(a).astype(np.float64).copy()
    d = len(rest)
    factor, order = np.zeros((d, d)), []
    least = d * np.finfo(np.float64).eps * rest.max(initial=0.0)
    for k in range(d):
        free = np.setdiff1d(np.arange(d), order, assume_unique=True)
        pivot = free[np.argmax(rest[free])]
        if not rest[pivot] > least:
            return factor[:, :k]
        order.append(pivot)
        below = np.setdiff1d(free, [pivot], assume_unique=True)
        root = np.sqrt(rest[pivot])
        factor[pivot, k] = root
        factor[below, k] = (a[below, pivot] - factor[below, :k] @ factor[pivot, :k]) / root
        rest[below] -= factor[below, k] ** 2
    return factor


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors of ``factor @ factor.T``.

    Plane rotations make the columns of the factor orthogonal; their squared norms are the eigenvalues and the
    normalised columns the eigenvectors. A round rotates disjoint pairs of columns at once, and the rounds
    of a sweep meet every pair once.
    """
    w = factor.astype(np.float64).copy()
    columns = w.shape[1]
    if not columns:
        return np.zeros(0), w
    players = np.arange(columns + columns % 2)
    last = np.inf
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(players) - 1):
            half = len(players) // 2
            p, q = np.minimum(players[:half], players[half:][::-1]), np.maximum(players[:half], players[half:][::-1])
            p, q = p[q < columns], q[q < columns]
            x, y = w[:, p], w[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            both = np.sqrt(xx * yy)
            off = np.divide(np.abs(xy), both, out=np.zeros_like(both), where=both > 0)
            worst = max(worst, off.max(initial=0.0))
            turn = off > 1e-16
            t = np.zeros_like(xy)
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t[turn] = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            w[:, p], w[:, q] = c * x - s * y, s * x + c * y
            players = np.concatenate([players[:1], players[-1:], players[1:-1]])
        # Below 1e-12 only rounding is left once a sweep brings no gain.
        if worst < 1e-15 or (worst < 1e-12 and worst >= last):
            break
        last = worst
    values = (w * w).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], w[:, order] / np.sqrt(values[order])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Statistics and components of all usable ``vector`` of ``vectors``; None if there is none."""
    size = _common_length(vectors)
    if size is None:
        return None
    rows = vectors.filter(F.size("vector") == size).select("vector")
    counted = _total(rows, size, lambda x: np.vstack([x.sum(axis=0), np.full(size, len(x))]))
    made = Fit(int(counted[1, 0]), counted[0], np.zeros(0), np.zeros((size, 0)), 0.0)
    scatter = _total(rows, size, lambda x: _square(made.centred(x))) / made.n
    scatter = (scatter + scatter.T) / 2
    values, directions = jacobi(pivoted_cholesky(scatter))
    return Fit(made.n, made.sums, values[:components], directions[:, :components], float(np.trace(scatter)))


def _square(z: np.ndarray) -> np.ndarray:
    return z.T @ z


def _common_length(vectors: DataFrame) -> int | None:
    """The most frequent length, of equally frequent ones the larger."""
    lengths = vectors.groupBy(F.size("vector").alias("size")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return first and first["size"]


def identity_error(vectors: DataFrame, fitted: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    k = len(fitted.eigenvalues)
    if not k:
        return 0.0
    rows = vectors.filter(F.size("vector") == fitted.size).select("vector")
    return float(np.abs(_total(rows, fitted.size, lambda x: _square(fitted.whitened(x))) / fitted.n - np.eye(k)).max())


def _project(fitted: Fit):
    k = len(fitted.eigenvalues)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, fitted.size):
            if not len(x):
                continue
            z = np.ascontiguousarray(fitted.whitened(x))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(z.ravel(), pa.float64()))
            yield pa.record_batch({
                "row": part.column("row"), "deviation": pa.array(fitted.deviation(x), pa.int64()), "whitened": lists,
            })

    return of


def whiten(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Fit | None]:
    """All rows with a usable vector, with ``deviation long`` and ``whitened array<double>``, and the fit.

    Entries ``c`` become the integers ``floor(64 c) + 1000000``; the fit list is all usable rows, repeated ones
    as often as they occur. Rows whose vector is null, empty, or has a null or non-finite entry are dropped, as
    are vectors of another length than the most frequent one. Entries beyond 2^31 / 64 count as that. Fewer
    components come back where the scatter has a lower rank (equal vectors have none). ``deviation`` is null
    where it exceeds a 64-bit number. Equal eigenvalues are ordered by the pivots. Other columns are kept;
    input columns named ``deviation`` or ``whitened`` are replaced. No usable row gives no rows and no fit.

    Only sums, one matrix of the vectors' length squared, and the components pass the driver; the fit goes to
    the tasks with their code. Three scans: sums, scatter, result.
    """
    keep = [c for c in vectors.columns if c not in ("deviation", "whitened")]
    entries = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.struct(*keep).alias("row"), entries.alias("vector")).filter(usable(F.col("vector")))
    fitted = fit(rows.select("vector"), components)
    if fitted is None:
        empty = rows.limit(0).select("row.*", F.lit(None).cast("long").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
        return empty, None
    schema = T.StructType([
        rows.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ])
    done = rows.filter(F.size("vector") == fitted.size).mapInArrow(_project(fitted), schema)
    return done.select("row.*", "deviation", "whitened"), fitted


def components_long(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``(<id_col>, component, n, deviation, whitened, explained, identity_error)``.

    ``explained`` is the component's eigenvalue over the trace. See ``whiten`` for all other cases.
    """
    source = vectors.select(id_col, F.col(vector_col).alias("vector"))
    done, fitted = whiten(source, "vector", components)
    if fitted is None:
        fitted, error = Fit(0, np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros((0, 0)), 0.0), 0.0
    else:
        entries = source.select(F.col("vector").cast("array<double>").alias("vector"))
        error = identity_error(entries.filter(usable(F.col("vector"))), fitted)
    explained = [float(v / fitted.trace) for v in fitted.eigenvalues]
    return done.select(id_col, "deviation", F.posexplode("whitened").alias("at", "value")).select(
        id_col,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(F.array(*[F.lit(v) for v in explained or [0.0]]), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
