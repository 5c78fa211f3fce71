"""Cold-start cases and the fallback chains that fill them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.operators.sizing import broadcast_if_small
from corate.operators.stats import item_stats, user_genre_stats, user_stats
from corate.session import materialize

IMPUTE_MODES = ("genre", "item_mean")


def unscorable_by_factors(pairs: DataFrame, train: DataFrame) -> DataFrame:
    """Pairs a factor model trained on ``train`` cannot score: the user or the
    item has no training rating. Adds ``reason`` (cold_user / cold_item /
    cold_both)."""
    users = train.select("user").distinct().withColumn("_u", F.lit(True))
    items = train.select("item").distinct().withColumn("_i", F.lit(True))
    j = pairs.join(users, "user", "left").join(items, "item", "left")
    reason = (
        F.when(F.col("_u").isNull() & F.col("_i").isNull(), F.lit("cold_both"))
        .when(F.col("_u").isNull(), F.lit("cold_user"))
        .otherwise(F.lit("cold_item"))
    )
    keep = F.col("_u").isNull() | F.col("_i").isNull()
    return j.filter(keep).withColumn("reason", reason).drop("_u", "_i")


def impute(
    cases: DataFrame,
    train: DataFrame,
    genres: DataFrame | None,
    global_mean: Column,
    how: str = "genre",
    ustats: DataFrame | None = None,
) -> DataFrame:
    """Fill (user, item[, rating]) cases.

    ``genre``: the user's mean over training items with exactly the same
    genre string as the item; else the user's mean; else the global mean.
    ``item_mean``: the item's training mean; else the user's mean; else the
    global mean. Returns the input columns + prediction, source.

    Only the cases' users (and, for ``item_mean``, items) are looked up, so
    the training ratings are first cut to those users / items with a
    semi-join; every mean is still over all of that user's (item's) ratings,
    and the genre join runs on the cut set instead of the whole training set.
    The cases are read up to four times, so they are materialized first.
    ``ustats`` reuses the training set's ``user_stats``.
    """
    if how not in IMPUTE_MODES:
        raise ValueError(f"how must be one of {IMPUTE_MODES}")
    if how == "genre" and genres is None:
        raise ValueError("genre imputation needs a genre table")
    cases = materialize(cases, "auto", "cases")
    users = cases.select("user").distinct()
    us = user_stats(train.join(users, "user", "left_semi")) if ustats is None else ustats
    j = cases.join(us.select("user", F.col("mean_rating").alias("_umean")), "user", "left")
    if how == "genre":
        user_train = train.join(users, "user", "left_semi")
        ug = user_genre_stats(user_train, genres).select(
            "user", "genre", F.col("mean_rating").alias("_first")
        )
        j = j.join(broadcast_if_small(genres.select("item", "genre")), "item", "left").join(
            ug, ["user", "genre"], "left"
        )
        first_src = "genre_mean"
    else:
        item_train = train.join(cases.select("item").distinct(), "item", "left_semi")
        it = item_stats(item_train).select("item", F.col("mean_rating").alias("_first"))
        j = j.join(it, "item", "left")
        first_src = "item_mean"
    pred = F.coalesce(F.col("_first"), F.col("_umean"), global_mean)
    src = (
        F.when(F.col("_first").isNotNull(), F.lit(first_src))
        .when(F.col("_umean").isNotNull(), F.lit("user_mean"))
        .otherwise(F.lit("global_mean"))
    )
    out_cols = [c for c in cases.columns]
    return j.select(*out_cols, pred.alias("prediction"), src.alias("source"))
