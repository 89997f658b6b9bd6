"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Components become x = floor(1024 * c) + 100000. Three reads of the table fit the model:
exact sums per dimension, then the centred scatter, then, of the whitened vectors, how far
their covariance is from the identity. Every read is one pass in which a task sends a few
numbers per dimension, summed by Spark; no vector is shuffled.

The covariance V = P L L' P' is factored with pivots, so directions without variance end
the factor and are no components. Jacobi rotations act on the columns of P L directly, in
rounds of disjoint pairs, until all are orthogonal: P L W = U S. Their norms squared are
the eigenvalues of V, the normalised columns its eigenvectors. V itself is never rotated,
so small eigenvalues keep their relative accuracy.

Defined cases: vectors that are null or hold a null or non-finite entry, or are empty, take no
part. Vectors of different lengths are whitened apart, each length by its own fit (at
most MAX_LENGTHS lengths, else an error). A fit without variance (a single vector, or equal ones) has no
components and so no rows; fewer directions with variance than components asked for give fewer.
An entry beyond LARGEST in size is an error, as its x would not be exact in what follows.
Rows without an identifier, and repeated rows, count and are returned as any other. Other
columns, whatever their names, do not take part. An empty table gives no rows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import durable

SCALE, OFFSET = 1024, 100_000
LARGEST = 2.0**31
MAX_LENGTHS = 64
COMPONENTS = 8
#: A pivot below this share of the largest variance ends the factor.
FLAT = 1e-13
SWEEPS = 60
#: Where the two halves of a long integer part.
HALF = 1 << 24


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """P L with P L L' P' = v, one column per direction with variance."""
    v = np.array(v, float)
    d = len(v)
    order, left = np.arange(d), np.diag(v).copy()
    factor = np.zeros((d, d))
    least = FLAT * max(left.max(initial=0.0), 0.0)
    for k in range(d):
        pivot = k + int(left[order[k:]].argmax())
        order[[k, pivot]] = order[[pivot, k]]
        p, rest = order[k], order[k + 1 :]
        if left[p] <= least:
            return factor[:, :k]
        factor[p, k] = np.sqrt(left[p])
        factor[rest, k] = (v[rest, p] - factor[rest, :k] @ factor[p, :k]) / factor[p, k]
        left[rest] -= factor[rest, k] ** 2
    return factor


def rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint ones, as in a tournament."""
    seats = np.arange(n + n % 2)
    half = len(seats) // 2
    for _ in range(max(len(seats) - 1, 0)):
        a, b = seats[:half], seats[half:][::-1]
        real = (a < n) & (b < n)
        yield a[real], b[real]
        seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of factor factor'."""
    g = np.array(factor, float)
    for _ in range(SWEEPS):
        turned = False
        for a, b in rounds(g.shape[1]):
            x, y = g[:, a], g[:, b]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            a, b, x, y, xx, yy, xy = a[turn], b[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
            zeta = (yy - xx) / (2 * xy)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            g[:, a], g[:, b] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    values = (g * g).sum(axis=0)
    falling = np.argsort(-values, kind="stable")
    return values[falling], g[:, falling] / np.sqrt(values[falling])


@dataclasses.dataclass(frozen=True)
class Whitener:
    """The fit over n vectors of one length."""

    n: int
    sums: tuple[int, ...]  # exact, per dimension
    values: np.ndarray  # eigenvalues of the components
    components: np.ndarray  # dims x components
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part of the mean is taken off in integers."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])
        return (x - np.array(whole, np.int64)).astype(float) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2, exact.

        With z = x - w and R = S - n w, w the whole part of the mean, this is
        n^2 sum z^2 - 2 n sum z R + sum R^2. The sums over dimensions stay in eight bytes,
        with R in two halves; only what belongs to a row is a long integer.
        """
        n, whole = self.n, [s // self.n for s in self.sums]
        rest = [s - w * n for s, w in zip(self.sums, whole, strict=True)]
        z = x - np.array(whole, np.int64)
        if max(int(z.max()), -int(z.min())) < HALF and len(rest) < 1 << 14 and n < HALF * HALF:
            squares = (z * z).sum(axis=1).tolist()
            high, low = (z @ np.array([f(r, HALF) for r in rest], np.int64) for f in (int.__floordiv__, int.__mod__))
            last = sum(r * r for r in rest)
            exact = (n * (n * a - 2 * (h * HALF + b)) + last for a, h, b in zip(squares, high.tolist(), low.tolist(), strict=True))
        else:
            exact = (sum((int(v) * n - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x)
        return pa.array([Decimal(v) for v in exact], pa.decimal128(38, 0))


def taking_part(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, v (doubles), of the vectors that take part."""
    rows = vectors.select(vectors[id_col].alias("id"), F.transform(vectors[vec_col], lambda c: c.cast("double")).alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where((F.size("v") > 0) & fine)


def by_length(b: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and x of the vectors of each length in a batch."""
    column = b.column(at)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        c = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        if np.abs(c).max() > LARGEST:
            raise ValueError(f"an entry is beyond {LARGEST} in size")
        yield rows, np.floor(c * SCALE).astype(np.int64) + OFFSET


def fit(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> dict[int, Whitener]:
    """The whitener of each length of vectors."""
    given = taking_part(vectors, id_col, vec_col).select("v")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in by_length(b, 0):
                d = x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array([d] * d), pa.array(range(d)), pa.array([len(rows)] * d), pa.array(x.sum(axis=0))], ["d", "i", "n", "s"])

    exact = given.mapInArrow(sums, "d long, i long, n long, s long").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    lengths = [r["d"] for r in exact.select("d").distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"vectors have more than {MAX_LENGTHS} lengths")
    found: dict[int, list] = {}
    for r in exact.orderBy("d", "i").collect():  # one number per dimension
        found.setdefault(r["d"], []).append(r)
    centres = {d: Whitener(rows[0]["n"], tuple(int(r["s"]) for r in rows), np.empty(0), np.empty((d, 0)), 0.0) for d, rows in found.items()}

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for b in batches:
            for _, x in by_length(b, 0):
                z = centres[x.shape[1]].centred(x)
                total[x.shape[1]] = total.get(x.shape[1], 0.0) + z.T @ z
        for d, cells in total.items():
            i, j = np.tril_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(i)), pa.array(i), pa.array(j), pa.array(cells[i, j])], ["d", "i", "j", "s"])

    cells = given.mapInArrow(scatter, "d long, i long, j long, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s"))
    covariance = {d: np.zeros((d, d)) for d in centres}
    for d, i, j, s in cells.collect():  # half a matrix of dimensions squared
        covariance[d][i, j] = covariance[d][j, i] = s / centres[d].n
    fits = {}
    for d, v in covariance.items():
        values, columns = jacobi(pivoted_cholesky(v))
        keep = min(components, len(values))
        fits[d] = dataclasses.replace(centres[d], values=values[:keep], components=columns[:, :keep], trace=float(np.trace(v)))
    return fits


def whiten(vectors: DataFrame, fits: dict[int, Whitener], id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, d (length), n, deviation (a decimal), whitened (one number per component)."""
    given = taking_part(vectors, id_col, vec_col)
    kind = given.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in by_length(b, 1):
                model = fits[x.shape[1]]
                w = model.whiten(x)
                lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1) * w.shape[1], pa.array(w.ravel()))
                lengths = pa.array(np.full(len(rows), x.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), lengths, pa.array(np.full(len(rows), model.n)), model.deviations(x), lists], ["id", "d", "n", "deviation", "whitened"])

    return given.mapInArrow(run, f"id {kind}, d int, n long, deviation decimal(38,0), whitened array<double>").withColumnRenamed("id", id_col)


def identity_errors(whitened: DataFrame) -> dict[int, float]:
    """For each length, the largest absolute entry of the whitened vectors' covariance minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(0).to_numpy()
            for d in np.unique(lengths):
                w = b.column(1).filter(pa.array(lengths == d)).flatten().to_numpy(zero_copy_only=False).reshape(int((lengths == d).sum()), -1)
                w = np.hstack([np.ones((len(w), 1)), w])
                i, j = np.tril_indices(w.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(i)), pa.array(i), pa.array(j), pa.array((w.T @ w)[i, j])], ["d", "i", "j", "s"])

    cells = whitened.select("d", "whitened").mapInArrow(run, "d int, i long, j long, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s"))
    moments: dict[int, dict] = {}
    for d, i, j, s in cells.collect():
        moments.setdefault(d, {})[i, j] = s
    errors = {}
    for d, m in moments.items():
        size = max(i for i, _ in m)
        n, means = m[0, 0], [m[i, 0] / m[0, 0] for i in range(1, size + 1)]  # the vectors are centred already, so their means are rounding
        errors[d] = max((abs(m[i, j] / n - means[i - 1] * means[j - 1] - (i == j)) for i in range(1, size + 1) for j in range(1, i + 1)), default=0.0)
    return errors


def whitened_rows(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, component, n, deviation (a decimal), whitened, explained, identity_error: one row per vector and component."""
    fits = fit(vectors, components, id_col, vec_col)
    rows = durable(whiten(vectors, fits, id_col, vec_col))
    errors = identity_errors(rows)
    about = F.create_map(
        *[x for d, f in fits.items() for x in (F.lit(d), F.struct(F.array(*map(F.lit, f.explained.tolist())).cast("array<double>").alias("explained"), F.lit(errors.get(d, 0.0)).alias("error")))]
    ) if fits else F.lit(None).cast("map<int,struct<explained:array<double>,error:double>>")
    one = rows.select(f"`{id_col}`", "n", "deviation", about[F.col("d")].alias("about"), F.posexplode("whitened").alias("at", "whitened"))
    return one.select(
        f"`{id_col}`", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("about.explained", F.col("at")).alias("explained"), F.col("about.error").alias("identity_error"),
    )
