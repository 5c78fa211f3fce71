"""Small ridge regressions by the million: one half-step of alternating least squares.

Given factors on one side, the other side's factors solve a rank x rank system
each: (sum y y' + lambda n I) x = sum r y over the id's ratings. The matrices
are sums, which Spark adds up into one row per id; the systems are then
factorised (Cholesky) in batches. Used to fold users in that come after
training, and to redo or check either side of a model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.constants import ALS_LAMBDA


#: Ratings of one id that a task may have to sum up.
DEALT_RATINGS = 5_000_000


def normal_equations(ratings: DataFrame, factors: DataFrame, key: str, other: str, column: str, rank: int) -> DataFrame:
    """(key, n, a, b): the upper triangle of sum y y' row by row, and sum r y.

    ``ratings`` has (key, other, rating), ``factors`` (other, column). Ratings
    whose other side has no factors, and null ratings, count nothing. An id
    with few ratings makes a larger row of sums than of factors, so the rows
    are dealt by id and then summed; with very many of one id, they are summed
    map-side.
    """
    j = ratings.select(key, other, "rating").where("rating is not null").join(factors.select(other, column), other)
    most = ratings.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if (most or 0) <= DEALT_RATINGS:
        j = j.select(key, "rating", column).repartition(key)
    y = [F.get(column, F.lit(k)).cast("double") for k in range(rank)]
    triangle = [y[i] * y[k] for i in range(rank) for k in range(i, rank)]
    return j.groupBy(key).agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(v) for v in triangle]).alias("a"),
        F.array(*[F.sum(F.col("rating") * v) for v in y]).alias("b"),
    )


def solve(equations: DataFrame, key: str, column: str, rank: int, reg_param: float = ALS_LAMBDA) -> DataFrame:
    """(key, column): the solution of each row of ``normal_equations``.

    ``reg_param`` is above zero, so every matrix is positive definite.
    """
    if reg_param <= 0:
        raise ValueError("reg_param must be above zero")
    upper = np.triu_indices(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            n = batch.column(1).to_numpy(zero_copy_only=False)
            flat = [batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) for i in (2, 3)]
            a = np.zeros((rows, rank, rank))
            a[:, upper[0], upper[1]] = flat[0]
            a[:, upper[1], upper[0]] = flat[0]
            a += (reg_param * n)[:, None, None] * np.eye(rank)
            low = np.linalg.cholesky(a)
            x = np.linalg.solve(low.transpose(0, 2, 1), np.linalg.solve(low, flat[1][:, :, None]))[:, :, 0]
            ends = np.arange(rows + 1, dtype=np.int32) * rank
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, x.ravel())], [key, column])

    kind = dict(equations.dtypes)[key]
    return equations.select(key, "n", "a", "b").mapInArrow(run, f"`{key}` {kind}, `{column}` array<double>")


def fold_in(ratings: DataFrame, factors: DataFrame, key: str, other: str, rank: int, reg_param: float = ALS_LAMBDA) -> DataFrame:
    """(key, <key>_factors) of every ``key`` with a rating whose ``other`` side has factors (other, <other>_factors)."""
    eq = normal_equations(ratings, factors, key, other, f"{other}_factors", rank)
    return solve(eq, key, f"{key}_factors", rank, reg_param)


def residuals(ratings: DataFrame, solved: DataFrame, factors: DataFrame, key: str, other: str, rank: int, reg_param: float = ALS_LAMBDA) -> DataFrame:
    """(key, residual): how far ``solved`` is from the equations, relative to their right-hand side.

    Worked out from the errors of the single ratings, not from the matrices.
    """
    j = ratings.join(factors, other).join(solved, key)
    dot = F.aggregate(F.zip_with(f"{key}_factors", f"{other}_factors", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    j = j.withColumn("_e", dot - F.col("rating"))
    y = [F.get(f"{other}_factors", F.lit(k)).cast("double") for k in range(rank)]
    s = j.groupBy(key).agg(F.count("*").alias("n"), F.first(f"{key}_factors").alias("x"),
                           F.array(*[F.sum(F.col("_e") * v) for v in y]).alias("g"), F.array(*[F.sum(F.col("rating") * v) for v in y]).alias("b"))
    left = F.zip_with("g", "x", lambda g, x: g + F.lit(reg_param) * F.col("n") * x.cast("double"))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x))
    return s.select(key, (norm(left) / F.greatest(norm(F.col("b")), F.lit(1e-300))).alias("residual"))
