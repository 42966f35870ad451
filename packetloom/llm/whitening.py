"""Embedding whitening from a polarisation covariance.

Entries are put on a grid: ``c`` becomes the integer ``floor(grid * c)``. Over the distinct grid vectors (n of them,
sums S) every dimension i and every pair i < j get one exact sum of squares of centred integers,

    A(i) = sum (n x_i - S_i)^2        P(i, j) = sum ((n x_i - S_i) + (n x_j - S_j))^2

and half the difference P(i, j) - A(i) - A(j) is n^3 times the covariance of i and j, exactly. Tasks hold these
d (d + 1) / 2 sums, whatever they read, and Spark adds them up; the driver gets one number per dimension and pair,
makes the matrix and takes its eigenvectors. So neither the order of rows nor the partitions change a bit of the matrix.

Squares are summed in 64-bit integers where they fit: values are cut into two parts of w bits, and so many rows are
added at once that no part can overflow; values beyond that are summed as Python's integers.

Null vectors, vectors with null or non-finite entries and vectors of another length than the most frequent one (of
equally frequent ones the shortest) take no part and give no row. Grid values beyond 64 bits stop at the largest; a
deviation of more than 38 digits is null.
Repeated vectors count once in the fit, and each row of them gets its rows; ids may be null or repeated. Directions
without spread (eigenvalue within rounding of 0: constant or dependent dimensions, one distinct vector) have no
whitened value and are left out, so a table may give fewer components or no row. Empty tables give no rows. Other
columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm.common import arrow_schema, batch_of, release, small, store

GRID = 256
TOP = 4
_SUMS = "at int, high decimal(38,0), low decimal(38,0)"
_LOW = 10**28  # sums of more than a decimal's 38 digits are carried in two numbers
_ROWS = 512  # whose pair sums are held at once: 512 x d (d + 1) / 2 integers


def on_grid(vectors: DataFrame, id_col: str, vector_col: str, grid: int) -> DataFrame:
    """(id, x array<long>) of the rows that take part, all of one length."""
    v = F.col("v")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda c: c.cast("double")).alias("v"))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & fine)
    return rows.select("id", F.transform(v, lambda c: F.floor(c * float(grid))).alias("x"))


def width_of(rows: DataFrame) -> int:
    found = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return found.d if found else 0


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def column_sums(values: np.ndarray) -> list[int]:
    if largest(values) * len(values) >= 1 << 62:
        values = values.astype(object)
    return [int(s) for s in values.sum(0)]


def square_sums(values: np.ndarray) -> list[int]:
    """Exact sums over the rows of the squares of an integer matrix."""
    most = largest(values)
    if most >= 1 << 60 or values.dtype == object:
        return [sum(int(z) ** 2 for z in column) for column in values.T]
    cut = max(1, (most.bit_length() + 1) // 2)  # both parts are below 2^cut
    step = 1 << min(20, 62 - 2 * cut)
    sums = [0] * values.shape[1]
    for start in range(0, len(values), step):
        z = np.abs(values[start : start + step])
        high, low = z >> cut, z & ((1 << cut) - 1)
        for scale, part in ((2 * cut, high * high), (cut + 1, high * low), (0, low * low)):
            sums = [s + (int(p) << scale) for s, p in zip(sums, part.sum(0))]
    return sums


def totals(rows: DataFrame, per_batch, width: int) -> list[int]:
    """Sums of the numbers that ``per_batch`` gives for a matrix of rows, by their place."""
    types = arrow_schema(rows.sparkSession, _SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[int] | None = None
        for batch in small(batches):
            if batch.num_rows:
                more = per_batch(matrix(batch.column(0), width))
                sums = more if sums is None else [a + b for a, b in zip(sums, more)]
        if sums is not None:
            parts = [divmod(s, _LOW) for s in sums]
            yield batch_of({"at": list(range(len(sums))), "high": [Decimal(p) for p, _ in parts], "low": [Decimal(p) for _, p in parts]}, types)

    found = rows.select("x").mapInArrow(run, _SUMS).groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    # a number per dimension or pair
    return [int(r.high) * _LOW + int(r.low) for r in sorted(found.collect(), key=lambda r: r.at)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S as integers, of Python's kind where 64 bits might not hold twice the value."""
    if n * largest(x) + max(map(abs, sums), default=0) < 1 << 61:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


@dataclass
class Whitening:
    """A fitted transform: rows of ``directions`` are unit eigenvectors, ``values`` their eigenvalues, falling."""

    grid: int
    width: int
    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(x - S/n) on every direction over the square root of its eigenvalue."""
        away = centred(x, self.n, self.sums).astype(float) / self.n
        return away @ (self.directions / np.sqrt(self.values)[:, None]).T


def covariance(squares: list[int], width: int, n: int) -> np.ndarray:
    """The matrix from the square sums of the dimensions, then of the pairs in row order."""
    out, pair = np.zeros((width, width)), width
    for i in range(width):
        out[i, i] = float(Fraction(squares[i], n**3))
        for j in range(i + 1, width):
            out[i, j] = out[j, i] = float(Fraction(squares[pair] - squares[i] - squares[j], 2 * n**3))
            pair += 1
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", grid: int = GRID, top: int = TOP) -> Whitening | None:
    """Fit on the distinct grid vectors; None if no row takes part."""
    rows = on_grid(vectors, vector_col, vector_col, grid).select("x")
    width = width_of(rows)
    if not width:
        return None
    distinct = store(rows.where(F.size("x") == width).distinct(), "grid")
    n = distinct.count()
    sums = totals(distinct, column_sums, width)
    one, two = np.triu_indices(width, 1)

    def squares(x: np.ndarray) -> list[int]:
        found: list[int] | None = None
        for start in range(0, len(x), _ROWS):
            y = centred(x[start : start + _ROWS], n, sums)
            part = square_sums(np.concatenate([y, y[:, one] + y[:, two]], axis=1))
            found = part if found is None else [a + b for a, b in zip(found, part)]
        return found

    v = covariance(totals(distinct, squares, width), width, n)
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions.T[::-1]
    real = values > max(values[0], 0.0) * width * np.finfo(float).eps * 8
    directions = directions[real][:top]
    signs = np.sign(directions[np.arange(len(directions)), np.abs(directions).argmax(1)])
    model = Whitening(grid, width, n, sums, values[real][:top], directions * signs[:, None], float(np.trace(v)))
    model.identity_error = identity_error(distinct, model)
    release(distinct.sparkSession, distinct)
    return model


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened values' covariance, less the identity, over the vectors of the fit."""
    k = len(model.values)
    if not k:
        return 0.0
    names = [f"w{i}" for i in range(k)]
    schema = ", ".join(f"{w} double" for w in names)
    types = arrow_schema(distinct.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield batch_of(dict(zip(names, model.scores(matrix(batch.column(0), model.width)).T)), types)

    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    white = distinct.select("x").mapInArrow(run, schema)
    found = white.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, component, n, deviation decimal(38,0), whitened, explained, identity_error of every row that takes part."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    names = {"id": id_col}
    if model is None or not len(model.values):
        return empty(vectors.sparkSession, schema).withColumnsRenamed(names)
    types = arrow_schema(vectors.sparkSession, schema)
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x = matrix(batch.column(1), model.width)
            y = centred(x, model.n, model.sums)
            deviation = [Decimal(s) if s < 10**38 else None for s in square_sums(y.T)]
            each = np.repeat(np.arange(len(x)), k)
            yield batch_of({
                "id": batch.column(0).take(pa.array(each)), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "n": np.full(len(each), model.n), "deviation": pa.array(deviation, type=pa.decimal128(38, 0)).take(pa.array(each)),
                "whitened": model.scores(x).ravel(), "explained": np.tile(explained, len(x)),
                "identity_error": np.full(len(each), model.identity_error)}, types)

    rows = on_grid(vectors, id_col, vector_col, model.grid).where(F.size("x") == model.width)
    return rows.mapInArrow(run, schema).withColumnsRenamed(names)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
