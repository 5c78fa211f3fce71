"""Alternating-least-squares factor model (Spark ML) and pair scoring.

Spark ML's ALS needs INT ids. Ids are checked with one small aggregate; when
they do not fit, a dense index is built with DataFrame operations (hash
buckets + per-bucket row numbers + bucket offsets), never on the driver.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.constants import ALS_ITERATIONS, ALS_LAMBDA, ALS_RANK

INT_MAX = 2**31 - 1


class FactorModel(NamedTuple):
    model: ALSModel
    user_index: DataFrame | None   # (user, user_ix) when ids were re-indexed
    item_index: DataFrame | None   # (item, item_ix)


def dense_index(ids: DataFrame, col: str, buckets: int = 1024) -> DataFrame:
    """(col, col_ix) with col_ix = 0..n-1 over the distinct ids of ``col``.

    Distinct ids are spread over ``buckets`` hash buckets (balanced, since ids
    are unique), numbered inside each bucket, and shifted by the running total
    of the bucket sizes. Only the ``buckets``-row size table is broadcast.
    """
    d = ids.select(col).distinct().withColumn(
        "_bk", F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")
    )
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy("_bk").orderBy(col)) - 1)
    sizes = d.groupBy("_bk").agg(F.count("*").alias("_sz"))
    offs = sizes.select(
        "_bk",
        (F.sum("_sz").over(Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"),
    ).fillna(0, ["_off"])
    return d.join(F.broadcast(offs), "_bk").select(
        col, (F.col("_off") + F.col("_rn")).cast("int").alias(f"{col}_ix")
    )


def _fits_int(train: DataFrame) -> tuple[bool, bool]:
    r = train.agg(
        F.min("user").alias("umin"), F.max("user").alias("umax"),
        F.min("item").alias("imin"), F.max("item").alias("imax"),
    ).first()
    def ok(lo, hi):
        return lo is None or (lo >= -INT_MAX - 1 and hi <= INT_MAX)
    return ok(r["umin"], r["umax"]), ok(r["imin"], r["imax"])


def als_blocks(n_rows: int) -> int:
    """User and item blocks for a training set: 10 up to ten million rows, then
    growing with the square root, as the number of block pairs is its square."""
    return max(10, math.isqrt(n_rows // 100_000))


def fit_als(
    train: DataFrame,
    rank: int = ALS_RANK,
    max_iter: int = ALS_ITERATIONS,
    reg_param: float = ALS_LAMBDA,
    seed: int = 42,
    num_blocks: int | None = None,
    checkpoint_interval: int = 10,
    n_rows: int | None = None,
) -> FactorModel:
    """Explicit-feedback ALS. Defaults follow the reference call: rank 5,
    4 iterations, lambda 0.01 (the default of the RDD-based ``ALS.train``;
    Spark ML's own default is 0.1, so it is set explicitly), fixed seed.

    ``num_blocks`` (user and item blocks) defaults to ``als_blocks`` of the
    number of training rows (``n_rows``, counted if not given), never of the
    cluster's cores: the factors depend on the block count, so the same data
    and seed must give the same count everywhere."""
    u_ok, i_ok = _fits_int(train)
    uix = None if u_ok else dense_index(train, "user")
    iix = None if i_ok else dense_index(train, "item")
    t = train
    t = t.withColumn("_u", F.col("user").cast("int")) if u_ok else t.join(uix, "user").withColumnRenamed("user_ix", "_u")
    t = t.withColumn("_i", F.col("item").cast("int")) if i_ok else t.join(iix, "item").withColumnRenamed("item_ix", "_i")
    als = ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        implicitPrefs=False,
        userCol="_u",
        itemCol="_i",
        ratingCol="rating",
        coldStartStrategy="drop",
        seed=seed,
        checkpointInterval=checkpoint_interval,
    )
    blocks = num_blocks or als_blocks(train.count() if n_rows is None else n_rows)
    als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    model = als.fit(t.select("_u", "_i", "rating"))
    return FactorModel(model, uix, iix)


def factor_tables(fm: FactorModel) -> tuple[DataFrame, DataFrame]:
    """(user, user_factors) and (item, item_factors), by the original ids."""
    def table(factors: DataFrame, name: str, index: DataFrame | None) -> DataFrame:
        f = factors.select(F.col("id").alias(f"{name}_ix"), F.col("features").alias(f"{name}_factors"))
        if index is None:
            return f.select(F.col(f"{name}_ix").cast("bigint").alias(name), f"{name}_factors")
        return f.join(index, f"{name}_ix").select(name, f"{name}_factors")

    return (table(fm.model.userFactors, "user", fm.user_index),
            table(fm.model.itemFactors, "item", fm.item_index))


def factor_dot(a: str = "user_factors", b: str = "item_factors"):
    """Dot product of two factor columns, in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def dot_differences(fm: FactorModel, predictions: DataFrame) -> DataFrame:
    """(user, item, difference): how far each prediction is from the dot
    product of its user's and item's factors."""
    users, items = factor_tables(fm)
    j = predictions.join(users, "user").join(items, "item")
    return j.select("user", "item", F.abs(F.col("prediction") - factor_dot()).alias("difference"))


def user_residuals(fm: FactorModel, train: DataFrame, reg_param: float = ALS_LAMBDA) -> DataFrame:
    """(user, residual): how far each user's factors are from solving that
    user's ridge equations given the item factors, relative to the right-hand
    side. The last half-step solves the users, so all are about zero.

    Per user: sum_i (x . y_i - r_i) y_i + lambda n x = 0, with right-hand side
    sum_i r_i y_i; sums per factor, combined map-side."""
    users, items = factor_tables(fm)
    rank = fm.model.rank
    j = train.join(items, "item").join(users, "user")
    j = j.withColumn("_e", factor_dot() - F.col("rating"))
    y = [F.get("item_factors", F.lit(k)).cast("double") for k in range(rank)]
    s = j.groupBy("user").agg(
        F.count("*").alias("n"),
        F.first("user_factors").alias("x"),
        F.array(*[F.sum(F.col("_e") * v) for v in y]).alias("g"),
        F.array(*[F.sum(F.col("rating") * v) for v in y]).alias("b"),
    )
    left = F.zip_with("g", "x", lambda g, x: g + F.lit(reg_param) * F.col("n") * x.cast("double"))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x))
    rhs = norm(F.col("b"))
    return s.select("user", (norm(left) / F.when(rhs > 0, rhs).otherwise(F.lit(1.0))).alias("residual"))


def als_predict(fm: FactorModel, pairs: DataFrame) -> DataFrame:
    """(user, item, prediction) for the pairs whose user and item both have
    factors; other pairs are dropped (cold start)."""
    p = pairs.select("user", "item")
    if fm.user_index is None:
        p = p.filter(F.col("user").between(-INT_MAX - 1, INT_MAX)).withColumn("_u", F.col("user").cast("int"))
    else:
        p = p.join(fm.user_index, "user").withColumnRenamed("user_ix", "_u")
    if fm.item_index is None:
        p = p.filter(F.col("item").between(-INT_MAX - 1, INT_MAX)).withColumn("_i", F.col("item").cast("int"))
    else:
        p = p.join(fm.item_index, "item").withColumnRenamed("item_ix", "_i")
    out = fm.model.transform(p)
    return out.select("user", "item", F.col("prediction").cast("double").alias("prediction"))


def score_pairs(users: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """As ``als_predict``, from factor tables (user, user_factors) and (item,
    item_factors) of any origin: folded in, re-solved, or another program's."""
    j = pairs.select("user", "item").join(users, "user").join(items, "item")
    return j.select("user", "item", factor_dot().alias("prediction"))
