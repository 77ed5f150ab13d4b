"""Whitened embeddings from exact covariances, recovered from variances of single dimensions and of pair sums.

For centred values a and b, cov(a, b) = (var(a + b) - var(a) - var(b)) / 2. So tasks only add up squares: of every
dimension and of every sum of two. Entries are integers and centred by integers close to the means before they are
squared; the rest of the mean is taken off in exact arithmetic at the end. One matrix of dimensions times dimensions
reaches the driver, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plantmetrics.llm.arrow import record_batch
from plantmetrics.sources import stage

#: Integer units in 1.0, and the largest entry: sums of squares of up to 2^36 rows then fit 38 digits.
SCALE, LARGEST = 256, 1 << 40
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class WhiteningSettings:
    components: int = 4
    #: Components whose variance is at most this share of the largest have no whitened values (null).
    least_share: float = 1e-12


@dataclass(frozen=True)
class Whitening:
    """What rows need: ``n`` fitted vectors, sums, axes as columns, eigenvalues, all by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centres(self) -> np.ndarray:
        """The integers nearest to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=object)


def integer_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` whose vector is not null and has finite entries only, with ``x``, the entries as integers."""
    entry = F.transform(F.col(vector), lambda c: c.cast("double"))
    good = F.col(vector).isNotNull() & ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    bound = F.lit(float(LARGEST))
    whole = F.transform(entry, lambda c: F.floor(F.greatest(-bound, F.least(bound, c * SCALE))))
    return rows.where(good).withColumn("x", whole)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _exact(matrix: np.ndarray, bits: int) -> np.ndarray:
    """Python integers in the place of longs where an entry is too large to be squared and added up in a long."""
    return matrix if matrix.size == 0 or np.abs(matrix).max() < 1 << bits else matrix.astype(object)


def square_sums(y: np.ndarray) -> list[int]:
    """Sums over the rows of y_i^2, then of (y_i + y_j)^2 for i < j, in this order; exact."""
    y = _exact(y, 22)
    single = [(y * y).sum(axis=0)]
    pairs = []
    for i in range(y.shape[1] - 1):
        both = y[:, i : i + 1] + y[:, i + 1 :]
        pairs.append((both * both).sum(axis=0))
    return [int(v) for part in (*single, *pairs) for v in part]


def _pair_squares(fit: DataFrame, centres: np.ndarray, dims: int) -> list[int]:
    """``square_sums`` of all centred rows: added up within each task, then by Spark."""
    kind = StructType.fromDDL("k int, total decimal(38,0)")
    arrow = to_arrow_schema(kind)
    count = dims * (dims + 1) // 2
    middle = centres

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for start in range(0, len(x), 4096):
                y = x[start : start + 4096] - middle.astype(np.int64)
                part = np.array(square_sums(y), dtype=object)
                total = part if total is None else total + part
        if total is not None:
            yield record_batch([list(range(count)), pa.array([int(v) for v in total], pa.decimal128(38, 0))], arrow)

    rows = fit.select("x").mapInArrow(add, kind).groupBy("k").agg(F.sum("total").alias("total")).collect()
    found = {row["k"]: int(row["total"]) for row in rows}
    return [found[k] for k in range(count)]


def covariance(squares: list[int], n: int, sums: list[int], centres: np.ndarray) -> list[list[Fraction]]:
    """The exact covariance matrix (divisor ``n``) by polarisation of centred squares.

    ``squares`` hold values centred by integers; what these miss of the means is r = (sum - n * centre) / n, and
    n times the square of r is what the squares have too much.
    """
    dims = len(sums)
    rest = [int(s) - n * int(c) for s, c in zip(sums, centres, strict=True)]
    var = [Fraction(n * squares[i] - rest[i] ** 2, n * n) for i in range(dims)]
    result = [[Fraction(0)] * dims for _ in range(dims)]
    k = dims
    for i in range(dims):
        result[i][i] = var[i]
        for j in range(i + 1, dims):
            together = Fraction(n * squares[k] - (rest[i] + rest[j]) ** 2, n * n)
            result[i][j] = result[j][i] = (together - var[i] - var[j]) / 2
            k += 1
    return result


def fit_whitening(fit: DataFrame, dims: int, settings: WhiteningSettings) -> Whitening | None:
    """Two passes over the written table of distinct vectors: sums, then squares of what is centred."""
    at = [F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    first = fit.agg(F.count(F.lit(1)).alias("n"), *at).first()
    n = first["n"]
    if not n:
        return None
    sums = [int(first[f"s{i}"]) for i in range(dims)]
    plain = Whitening(n, tuple(sums), np.zeros((dims, 0)), np.zeros(0), np.zeros(0))
    exact = covariance(_pair_squares(fit, plain.centres(), dims), n, sums, plain.centres())
    values, axes = np.linalg.eigh(np.array([[float(v) for v in row] for row in exact]))
    order = np.argsort(-values, kind="stable")[: settings.components]
    values, axes = np.maximum(values[order], 0.0), axes[:, order]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    trace = float(sum(exact[i][i] for i in range(dims)))
    explained = values / trace if trace else np.zeros(len(values))
    return Whitening(n, tuple(sums), axes * np.where(signs < 0, -1.0, 1.0), values, explained)


def project(x: np.ndarray, fitted: Whitening, settings: WhiteningSettings) -> np.ndarray:
    """Whitened values, a column per component; not a number where a component has no variance."""
    centres = fitted.centres()
    rest = np.array([float(Fraction(s, fitted.n) - int(c)) for s, c in zip(fitted.sums, centres, strict=True)])
    y = (x - centres.astype(np.int64)).astype(np.float64) - rest
    flat = fitted.values <= settings.least_share * (fitted.values.max() if len(fitted.values) else 0.0)
    scale = np.where(flat, np.nan, np.sqrt(np.where(flat, 1.0, fitted.values)))
    return (y @ fitted.axes) / scale


def deviations(x: np.ndarray, fitted: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None beyond a long.

    With y = x - centre and r = S - n * centre this is n^2 sum(y^2) - 2 n sum(y r) + sum(r^2).
    """
    n, centres = fitted.n, fitted.centres()
    rest = np.array([s - n * int(c) for s, c in zip(fitted.sums, centres, strict=True)], dtype=object)
    y = x - centres.astype(np.int64)
    squares = (_exact(y, 28) ** 2).sum(axis=1)
    small = max((abs(v) for v in rest), default=0) < 1 << 32
    crossed = (_exact(y, 24) @ rest.astype(np.int64)) if small and np.abs(y).max(initial=0) < 1 << 24 else y.astype(object) @ rest
    own = sum(int(v) ** 2 for v in rest)
    every = [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, crossed, strict=True)]
    return [v if v <= LONG else None for v in every]


def _identity_error(fit: DataFrame, fitted: Whitening, dims: int, settings: WhiteningSettings) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    names = [f"w{k}" for k in range(len(fitted.values))]
    kind = StructType.fromDDL(", ".join(f"{name} double" for name in names))
    arrow = to_arrow_schema(kind)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = project(_matrix(batch.column(0), dims), fitted, settings)
            yield record_batch([pa.array(w[:, k]) for k in range(w.shape[1])], arrow)

    white = stage(fit.select("x").mapInArrow(whiten, kind), "whitened")
    means = white.agg(*(F.avg(name).alias(name) for name in names)).first()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    centred = [F.col(name) - F.lit(means[name]) for name in names]
    products = white.agg(*(F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    off = [abs(products[f"c{i}_{j}"] - (i == j)) for i, j in pairs]
    return max((v for v in off if v == v), default=0.0)


def whiten_embeddings(
    rows: DataFrame,
    settings: WhiteningSettings = WhiteningSettings(),
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """A row per kept row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped. Vectors must be of one
    length to have covariances: where lengths differ, the most frequent holds (among equals the longer) and rows
    of others are dropped. Entries become floor(256 * c), bounded to +-2^40. The fit list has each distinct
    integer vector once, so copies, a third of all rows even, weigh once; they are combined before the shuffle.
    Repeated rows and null ids give rows like others; other columns are ignored; an empty table gives an empty
    result. A component without variance (one distinct vector, constant or dependent dimensions) has a null
    ``whitened``, stays out of ``identity_error``, and ``explained`` is 0 if there is no variance at all. Fewer
    dimensions than components give as many components as dimensions. ``deviation`` is null beyond a long.
    """
    kept = integer_vectors(rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding")))
    kept = kept.where(F.size("embedding") > 0).select("vec_id", "x")
    lengths = kept.groupBy(F.size("x").alias("dims")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    result = StructType.fromDDL(kind)
    dims = common["dims"] if common else 0
    kept = kept.where(F.size("x") == dims)
    fit = stage(kept.select("x").distinct(), "distinct-vectors") if common else None
    fitted = fit_whitening(fit, dims, settings) if common else None
    if fitted is None:
        return kept.sparkSession.createDataFrame([], result)
    error = _identity_error(fit, fitted, dims, settings)
    arrow = to_arrow_schema(result)
    count = len(fitted.values)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            white, away = project(x, fitted, settings), deviations(x, fitted)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), count)))
            yield record_batch(
                [
                    ids,
                    np.tile(np.arange(1, count + 1, dtype=np.int32), len(x)),
                    np.full(len(x) * count, fitted.n, np.int64),
                    [one for one in away for _ in range(count)],
                    pa.array(white.reshape(-1), from_pandas=True),
                    np.tile(fitted.explained, len(x)),
                    np.full(len(x) * count, error),
                ],
                arrow,
            )

    return kept.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(spread, result)
