"""Hold-out evaluation: error-band histogram and RMSE in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.functions.columns import band_aggregates
from corate.functions.exact import ExactSum


def score(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """truth (user, item, rating) joined with predictions (user, item, prediction)."""
    p = predictions.select("user", "item", "prediction")
    return truth.select("user", "item", "rating").join(p, ["user", "item"])


def evaluate(scored: DataFrame) -> DataFrame:
    """One row: band_0_1 .. band_4_up (counts of |rating - prediction| in
    [0,1) [1,2) [2,3) [3,4) [4,inf)), n_scored, rmse (NULL on empty input).
    The sum of squares is exact, so the RMSE does not hang on the row order."""
    err = F.abs(F.col("rating") - F.col("prediction"))
    squares = ExactSum(err * err, "_squares", 60, 6)
    row = scored.agg(
        *band_aggregates(err),
        F.count("*").alias("n_scored"),
        F.count(err).alias("_n"),
        F.max(F.isnan(err)).alias("_nan"),
        *squares.aggregates(),
    )
    row = squares.finish(row)
    rmse = F.when(F.col("_nan"), F.lit(float("nan"))).otherwise(F.sqrt(F.try_divide(F.col("_squares"), F.col("_n"))))
    return row.withColumn("rmse", rmse).drop("_n", "_nan", "_squares")
