"""Whitening of embeddings from a covariance by polarisation.

Entries become whole numbers, so every sum is exact. One pass gives the row
count and the sum of every dimension. A second pass adds up squared centred
values: of every dimension, and of the sum of every two dimensions. Since
Var(x + y) = Var(x) + Var(y) + 2 Cov(x, y), differences of these variances are
the cross-covariances. What reaches the driver are dimensions squared numbers,
whatever the rows; they are assembled there for ``eigh``.

Tasks centre with the whole part of the mean, so that squares stay small; the
rest of the mean (a fraction r / n, equal in all rows) is taken off the sums
exactly: with y = x - floor(S / n) and r = S - n * floor(S / n), the sum of
(n * y - r)^2 is n^2 * sum(y^2) - n * r^2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import pick


@dataclass(frozen=True)
class WhitenParams:
    """Entries c become floor(``scale`` * c) + ``offset``; ``components``: at
    most so many are returned; ``max_dimensions``: more are an error, as the
    driver holds a matrix of their square."""
    scale: int = 1024
    offset: int = 100_000
    components: int = 8
    max_dimensions: int = 2048


@dataclass(frozen=True)
class Fitted:
    """``n`` rows, exact ``sums`` (S) and mean of every dimension, eigenvalues
    and unit eigenvectors (columns) by falling eigenvalue, and their total."""
    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _usable(df: DataFrame) -> DataFrame:
    """Rows whose vector is there and holds finite entries only."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.filter(F.col("v").isNotNull()).filter(finite)


def _whole(rows: pa.RecordBatch, width: int, p: WhitenParams) -> np.ndarray:
    """The rows' entries as whole numbers (rows x width)."""
    c = rows.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = np.floor(p.scale * c)
    if len(x) and np.abs(x).max() >= 2.0 ** 62:
        raise ValueError("an entry is too large for a whole number of 64 bits")
    return x.astype(np.int64) + p.offset


def _total(x: np.ndarray) -> list:
    """Exact column sums as Python numbers: high and low halves apart, so that
    none overflows (fewer than 2^31 rows in a batch)."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(k) for h, k in zip(high, low, strict=True)]


def _added(parts: DataFrame, *keys: str) -> dict:
    """Exact totals of ``part`` by key; bounded by the dimensions, not by rows.
    A task sends one row a key, and these are summed by key."""
    rows = parts.groupBy(*keys).agg(F.sum("part").alias("part")).toArrow().to_pydict()
    return dict(zip(zip(*[rows[k] for k in keys], strict=True), map(int, rows["part"]), strict=True))


def _sums(d: DataFrame, width: int, p: WhitenParams) -> list:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for b in batches:
            total = [s + t for s, t in zip(total, _total(_whole(b, width, p)), strict=True)]
        yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["i", "part"])

    got = _added(d.mapInArrow(run, "i int, part decimal(38,0)"), "i")
    return [got.get((i,), 0) for i in range(width)]


def _squares(y: np.ndarray) -> np.ndarray:
    """Column sums of squares, in whole numbers of any size where 64 bits do not hold them."""
    most = int(np.abs(y).max()) if y.size else 0
    return (y * y).sum(axis=0) if most * most * len(y) < 1 << 62 else (y.astype(object) ** 2).sum(axis=0)


def _variances(d: DataFrame, width: int, base: np.ndarray, p: WhitenParams) -> dict:
    """(i, j) -> sum of (y_i + y_j)^2 for i < j, and of y_i^2 for i = j, with y = x - ``base``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for b in batches:
            for k in range(0, b.num_rows, 4096):
                y = _whole(b.slice(k, 4096), width, p) - base
                if len(y) and np.abs(y).max() >= 1 << 61:
                    y = y.astype(object)
                for i in range(width):
                    total[i, i] += int(_squares(y[:, i:i + 1])[0])
                    total[i, i + 1:] += _squares(y[:, i + 1:] + y[:, i:i + 1])
        i, j = np.triu_indices(width)
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                               pa.array([Decimal(int(t)) for t in total[i, j]], pa.decimal128(38, 0))], names=["i", "j", "part"])

    return _added(d.mapInArrow(run, "i int, j int, part decimal(38,0)"), "i", "j")


def _covariance(n: int, sums: list, got: dict) -> np.ndarray:
    """The covariance from exact sums of squares: every number is exact up to
    the last division."""
    width = len(sums)
    rest = [s - n * (s // n) for s in sums]
    own = [n * n * got[i, i] - n * rest[i] ** 2 for i in range(width)]  # n^3 times the variance
    out = np.empty((width, width))
    for i in range(width):
        out[i, i] = own[i] / n ** 3
        for j in range(i + 1, width):
            both = n * n * got[i, j] - n * (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n ** 3)
    return out


def _fit(d: DataFrame, n: int, width: int, p: WhitenParams) -> Fitted | None:
    """From ``d (v)`` with ``n`` vectors of ``width`` entries."""
    if not n:
        return None
    sums = _sums(d, width, p)
    base = np.array([s // n for s in sums], np.int64)
    values, vectors = np.linalg.eigh(_covariance(n, sums, _variances(d, width, base, p)))
    return Fitted(n, sums, values[::-1], vectors[:, ::-1], float(values.sum()))


def _prepared(df: DataFrame, p: WhitenParams) -> tuple:
    """The usable rows of the most frequent length (of equally frequent ones the
    longest), their number and that length."""
    d = _usable(df)
    sizes = d.filter(F.size("v") > 0).groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    width, n = (sizes[0]["size"], sizes[0]["count"]) if sizes else (-1, 0)
    if width > p.max_dimensions:
        raise ValueError(f"more than {p.max_dimensions} dimensions")
    return d.filter(F.size("v") == width), n, width


def fit(vectors: DataFrame, params: WhitenParams = WhitenParams(), vector_col: str = "embedding") -> Fitted | None:
    """Mean, eigenvalues and eigenvectors over all usable rows; None without any."""
    return _fit(*_prepared(pick(vectors, v=vector_col).withColumn("v", F.col("v").cast("array<double>")), params), params)


def _projection(f: Fitted, p: WhitenParams) -> tuple:
    """Components that are returned, and the matrix that whitens centred rows.
    An eigenvalue that rounding alone can explain gives no whitened value."""
    k = min(p.components, len(f.values))
    held = f.values[:k] > len(f.values) * np.finfo(float).eps * max(f.values[0], 0.0)
    scale = np.where(held, 1.0 / np.sqrt(np.where(held, f.values[:k], 1.0)), 0.0)
    return k, held, f.vectors[:, :k] * scale


def _whitened(rows: pa.RecordBatch, f: Fitted, matrix: np.ndarray, p: WhitenParams) -> tuple:
    """(x - floor(S / n), whitened values) of the rows."""
    whole = np.array([s // f.n for s in f.sums], np.int64)
    part = np.array([(s - f.n * (s // f.n)) / f.n for s in f.sums])
    y = _whole(rows, len(f.sums), p) - whole
    return y, (y - part) @ matrix


def _identity_error(d: DataFrame, f: Fitted, p: WhitenParams) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the
    identity, over the components that have values: measured on all rows."""
    k, held, matrix = _projection(f, p)
    if not held.any():
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = _whitened(b, f, matrix, p)[1]
            first, second = first + w.sum(axis=0), second + w.T @ w
        yield pa.record_batch([pa.array([first.tolist()], pa.list_(pa.float64())), pa.array([second.ravel().tolist()], pa.list_(pa.float64()))],
                              names=["first", "second"])

    parts = d.mapInArrow(run, "first array<double>, second array<double>")
    row = parts.agg(*[F.sum(F.col("first")[i]).alias(f"a{i}") for i in range(k)], *[F.sum(F.col("second")[i]).alias(f"b{i}") for i in range(k * k)]).first()
    mean, square = np.array(row[:k]) / f.n, np.array(row[k:]).reshape(k, k) / f.n
    off = np.abs(square - np.outer(mean, mean) - np.eye(k))
    return float(off[held][:, held].max())


def whiten(vectors: DataFrame, params: WhitenParams = WhitenParams(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: ``vec_id, component`` (from 1,
    by falling eigenvalue)``, n, deviation`` (sum over dimensions of
    (n * x - S)^2, exact)``, whitened, explained, identity_error``.

    Left out are null vectors, vectors with null or non-finite entries, empty
    ones and those of another length than the most frequent one. Null ids and
    repeated rows stay. A component without variance (too few or equal rows)
    has a null ``whitened``; ``explained`` is null where no dimension varies. An
    entry or a sum beyond its type is an error."""
    p = params
    df = pick(vectors, vec_id=id_col, v=vector_col).withColumn("v", F.col("v").cast("array<double>"))
    d, n, width = _prepared(df, p)
    kind = d.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    f = _fit(d.select("v"), n, width, p)
    if f is None:
        return d.sparkSession.createDataFrame([], schema)
    error = _identity_error(d.select("v"), f, p)
    k, held, matrix = _projection(f, p)
    share = [float(e / f.trace) if f.trace > 0 else None for e in f.values[:k]]
    rest = np.array([s - f.n * (s // f.n) for s in f.sums], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (b.slice(i, 4096) for b in batches for i in range(0, b.num_rows, 4096)):
            y, w = _whitened(rows, f, matrix, p)
            small = f.n * (int(np.abs(y).max()) + 1) < 1 << 28 and len(f.sums) <= 64
            centred = y * f.n - rest.astype(np.int64) if small else y.astype(object) * f.n - rest
            deviation = [Decimal(int(x)) for x in (centred * centred).sum(axis=1)]
            m = rows.num_rows
            at = np.repeat(np.arange(m), k)
            yield pa.record_batch([
                rows.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, f.n), pa.int64()),
                pa.array([x for x in deviation for _ in range(k)], pa.decimal128(38, 0)), pa.array(w.ravel(), pa.float64(), mask=np.tile(~held, m)),
                pa.array(share * m, pa.float64()), pa.array([error] * (m * k), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return d.mapInArrow(run, schema)
