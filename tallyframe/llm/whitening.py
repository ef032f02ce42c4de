"""Whitening of embeddings: the leading principal components, scaled to unit variance.

Entries are counted in steps of 1/256, so vectors are whole numbers and sums are exact. The covariance
of the distinct vectors is added up in parallel, centred before it is multiplied; only one matrix of
dimensions x dimensions comes to the driver. Its eigenvectors are found in single precision and then
corrected by the iteration of Ogita and Aishima, which takes nothing but matrix products: first in
double precision, at last in extended precision. Where eigenvalues lie so close together that
single precision has mixed their vectors, the iteration settles the space they span and a small
eigenproblem inside that space separates them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, written

STEP = 256
COMPONENTS = 4
ROUNDS = 30
LONG = 1 << 63
RESULT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


# --- eigenvectors on the driver -------------------------------------------------------------------

def corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One step of the iteration: better vectors, their values, the pairs too close to part, the step's size."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    gap = values[None, :] - values[:, None]
    close = np.abs(gap) <= 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    step = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
    return x + x @ step, values, close, float(np.abs(step).max())


def clusters(values: np.ndarray, close: np.ndarray) -> list[np.ndarray]:
    """Runs of neighbouring eigenvalues, in falling order, that the last step could not tell apart."""
    order = np.argsort(-values, kind="stable")
    cut = np.flatnonzero(~close[order[:-1], order[1:]]) + 1
    return [run for run in np.split(order, cut) if len(run) > 1]


def parted(a: np.ndarray, x: np.ndarray, run: np.ndarray) -> np.ndarray:
    """``x`` with the vectors of one cluster turned to the eigenvectors inside the space they span.

    The cluster's middle is taken off first, so that what is left is small and the small problem sees
    differences far below the precision of the values themselves.
    """
    part = x[:, run]
    middle = np.trace(part.T @ (a @ part)) / len(run)
    small = part.T @ (a @ part - middle * part)
    _, turn = np.linalg.eigh(((small + small.T) / 2).astype(np.float64))
    out = x.copy()
    out[:, run] = part @ turn[:, ::-1].astype(x.dtype)
    return out


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    scale = float(np.abs(a).max()) or 1.0
    a = np.asarray(a, np.float64) / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start.astype(np.float64)
    for kind in (np.float64, np.longdouble):
        exact, x = a.astype(kind), x.astype(kind)
        floor, last = 4 * len(a) * float(np.finfo(kind).eps), np.inf
        for _ in range(ROUNDS):
            x, values, close, size = corrected(exact, x)
            # Steps shrink quadratically until rounding is all that is left of them.
            if size <= floor or size > last / 2:
                break
            last = size
        for run in clusters(values, close):
            x = parted(exact, x, run)
        x, values, _, _ = corrected(exact, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order].astype(np.float64)
    return np.asarray(values[order], np.float64) * scale, x / np.sqrt((x * x).sum(axis=0))


# --- vectors in tasks -----------------------------------------------------------------------------

def usable(df: DataFrame, key: str, column: str) -> DataFrame:
    """``vec_id`` and ``embedding`` of rows whose vector is there and holds finite numbers only."""
    c = F.col(f"`{column}`").cast("array<double>")
    fine = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return df.where(fine).select(F.col(f"`{key}`").alias("vec_id"), c.alias("embedding"))


def dimension(rows: DataFrame) -> int:
    """The length that most vectors have, the larger one on ties; 0 without rows."""
    best = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return best.d if best else 0


def steps_of(vectors: pa.Array, d: int) -> np.ndarray:
    """Whole numbers floor(256 * c), one row a vector; what no long holds becomes the nearest long."""
    c = np.floor(STEP * vectors.flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)
    return np.where(c >= LONG, LONG - 1, np.where(c < -LONG, -LONG, c).astype(np.int64))


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes, in the narrowest of four widths that holds it, so that equal rows give equal bytes."""
    need = np.maximum(x.max(axis=1), ~x.min(axis=1))
    width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], need, side="right")
    rows = [x.astype(f"<i{1 << w}") if (width == w).any() else None for w in range(4)]
    return [rows[w][i].tobytes() for i, w in enumerate(width)]


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    rows = [np.frombuffer(b.as_buffer(), f"<i{b.as_buffer().size // d}") for b in column]
    return np.array(rows, np.int64).reshape(-1, d)


def distinct_vectors(rows: DataFrame, d: int) -> DataFrame:
    """Every distinct vector once (``x``, packed). Copies merge before they are shuffled."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([pa.array(packed(steps_of(batch.column(0), d)), pa.binary())], ["x"])

    return rows.select("embedding").mapInArrow(pack, "x binary").distinct()


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors there are and their exact sum in each dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for batch in batches:
            x = unpacked(batch.column(0), d)
            high, low, n = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0), n + len(x)
        yield pa.record_batch([pa.array(np.arange(d + 1), pa.int32()), pa.array([*high, 0]), pa.array([*low, n])], ["i", "high", "low"])

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = {r.i: (int(r.high) << 32) + int(r.low) for r in fit.mapInArrow(add, "i int, high long, low long").groupBy("i").agg(*exact).collect()}
    return found[d], [found[i] for i in range(d)]


@dataclass
class Centre:
    """Count and sums of the distinct vectors: the mean is ``whole`` plus ``rest`` / ``n`` in each dimension."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        whole = [s // n for s in sums]
        return cls(n, np.array(whole, np.int64), np.array([s - n * w for s, w in zip(sums, whole)], np.int64))

    def away(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean: whole parts are taken off exactly."""
        far = np.maximum(np.abs(x).max(initial=0), np.abs(self.whole).max(initial=0)) >= 1 << 62
        whole = x.astype(np.float64) - self.whole if far else (x - self.whole).astype(np.float64)
        return whole - self.rest / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)**2, exact; null beyond the largest long.

        Wrapping integers give the right sum whenever it fits; its size is known from the same sum in floats.
        """
        near = ((self.away(x) * self.n) ** 2).sum(axis=1)
        with np.errstate(over="ignore"):
            exact = ((self.n * (x - self.whole) - self.rest) ** 2).sum(axis=1)
        fits = near < LONG * (1 - 1e-9)
        for i in np.flatnonzero(~fits & (near < LONG * (1 + 1e-9))):
            true = sum((self.n * (int(v) - int(w)) - int(r)) ** 2 for v, w, r in zip(x[i], self.whole, self.rest))
            if true < LONG:
                exact[i], fits[i] = true, True
        return pa.array(exact, pa.int64(), mask=~fits)


def covariance(fit: DataFrame, d: int, centre: Centre) -> np.ndarray:
    """Covariance of the distinct vectors, divisor n. A task hands on one matrix; matrices are added by entry."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            away = centre.away(unpacked(batch.column(0), d))
            total += away.T @ away
        i, j = np.triu_indices(d)
        yield pa.record_batch([pa.array(i * d + j, pa.int64()), pa.array(total[i, j])], ["at", "v"])

    cells = fit.mapInArrow(multiply, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(d * d)
    out[[c.at for c in cells]] = [c.v for c in cells]
    out = out.reshape(d, d) / centre.n
    return out + np.triu(out, 1).T


@dataclass
class Whitening:
    """What a fit has learned: the centre, ``axes`` (dimensions x components, scaled) and shares of variance."""

    centre: Centre
    axes: np.ndarray
    explained: list[float]

    @property
    def d(self) -> int:
        return len(self.axes)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN where a component has no variance."""
        return self.centre.away(x) @ self.axes


def fitted(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Fit on the distinct vectors. Components whose variance is nothing but rounding count as zero."""
    centre = Centre.of(*totals(fit, d))
    v = covariance(fit, d, centre)
    values, vectors = eigenvectors(v)
    whole, k = float(np.trace(v)), min(components, d)
    values = np.where(values[:k] > d * np.finfo(float).eps * whole, values[:k], 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        axes = np.where(values > 0, vectors[:, :k] / np.sqrt(values), np.nan)
    return Whitening(centre, axes, [float(e / whole) if whole else 0.0 for e in values])


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened distinct vectors' covariance minus the identity; null without variance."""
    live = [i for i, e in enumerate(model.explained) if e > 0]
    if not live:
        return None
    d, names = model.d, [f"w{i}" for i in live]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.project(unpacked(batch.column(0), d))
            yield pa.record_batch([pa.array(w[:, i]) for i in live], names)

    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = fit.mapInArrow(project, ", ".join(f"{n} double" for n in names)).agg(*[F.covar_pop(a, b) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs))


def whitened(df: DataFrame, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The first whitened components of every vector, fitted on the distinct vectors.

    Needs ``key`` and ``column`` (an array of numbers); other columns are ignored. Rows whose vector is
    null, or holds null, NaN or infinity, are left out, and so are vectors of another length than most
    have (the longer on ties). One row a remaining row and component, numbered from 1: ``vec_id``,
    ``component``, ``n`` (distinct vectors), ``deviation`` (exact; null beyond a long), ``whitened``
    (null where the component has no variance), ``explained``, ``identity_error`` (one value; null
    without any variance). Repeated rows and null keys stay, but equal vectors enter the fit once.
    Fewer dimensions than components give fewer rows; an empty table or empty vectors give none.
    The driver holds one matrix of dimensions x dimensions, whatever the number of rows.
    """
    spark = df.sparkSession
    rows = usable(df, key, column)
    schema = RESULT.format(id=rows.schema["vec_id"].dataType.simpleString())
    d = dimension(rows)
    if not d:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == d)
    fit = written(distinct_vectors(rows, d), "vectors")
    model = fitted(fit, d, components)
    error, k = identity_error(fit, model), len(model.explained)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = steps_of(batch.column(1), d)
            rows = np.repeat(np.arange(len(x)), k)
            number = np.tile(np.arange(k), len(x))
            w = model.project(x).ravel()
            yield pa.record_batch([
                batch.column(0).take(pa.array(rows)), pa.array(number + 1, pa.int32()), pa.array(np.full(len(rows), model.centre.n)),
                model.centre.deviation(x).take(pa.array(rows)), pa.array(w, mask=np.isnan(w)),
                pa.array(np.array(model.explained)[number]), pa.array([error] * len(rows), pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of all embeddings."""
    return whitened(read_table(spark, folder, "embeddings"))
