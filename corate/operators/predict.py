"""Weighted neighbour predictions with mean fallbacks.

Every output row carries ``source``: which rule produced the prediction.
Predictions are not clamped to the rating scale unless ``clamp`` is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.functions.exact import ExactSum

LOO_MODES = ("literal", "corrected")


def with_rating(pairs: DataFrame) -> DataFrame:
    """Pairs to score; a NULL ``rating`` is added when there is no answer."""
    if "rating" in pairs.columns:
        return pairs
    return pairs.withColumn("rating", F.lit(None).cast("double"))


def _clamp(c: Column, clamp: tuple[float, float] | None) -> Column:
    if clamp is None:
        return c
    lo, hi = clamp
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def _rank_ordered_sums(top: DataFrame, weighted: Column) -> DataFrame:
    """Per test pair: num = sum(weighted), den = sum(|sim|), n_neighbors.

    Both sums are folded left to right in neighbour-rank order, so the result
    does not depend on how rows reach the aggregate (a plain ``sum`` of
    irrational similarities can differ in the last bit between plans, which
    can move an error that is an exact integer across a band edge). The list
    per pair holds at most k rows because ``top`` is already cut to k.
    """
    nb = F.sort_array(
        F.collect_list(
            F.struct(
                F.col("nbr_rank"),
                weighted.alias("w"),
                F.abs(F.col("sim")).alias("a"),
            )
        )
    )
    return (
        top.groupBy("user", "item")
        .agg(nb.alias("_nb"))
        .select(
            "user",
            "item",
            F.aggregate("_nb", F.lit(0.0), lambda acc, x: acc + x["w"]).alias("num"),
            F.aggregate("_nb", F.lit(0.0), lambda acc, x: acc + x["a"]).alias("den"),
            F.size("_nb").cast("bigint").alias("n_neighbors"),
        )
    )


def _all_sums(scored: DataFrame, weighted: Column) -> DataFrame:
    """As ``_rank_ordered_sums``, over all neighbours of a pair, however many:
    plain aggregates of exact sums, which need no order and no list."""
    num, den = ExactSum(weighted, "num"), ExactSum(F.abs("sim"), "den")
    rows, nums = num.cut(scored)
    rows, dens = den.cut(rows)
    sums = rows.groupBy("user", "item").agg(
        *nums, *dens, F.count("*").cast("bigint").alias("n_neighbors"))
    return den.finish(num.finish(sums)).select("user", "item", "num", "den", "n_neighbors")


def neighbour_sums(neighbours: DataFrame, weighted: Column) -> DataFrame:
    """num, den and n_neighbors of each test pair, over ranked neighbours (of
    ``top_k``) or, without a rank, over all of them."""
    return (_rank_ordered_sums if "nbr_rank" in neighbours.columns else _all_sums)(neighbours, weighted)


def _fallback_chain(first_ok: Column, first: Column, fallbacks, global_mean: Column):
    """(prediction, source) from the first rule that applies."""
    pred = F.when(first_ok, first)
    src = F.when(first_ok, F.lit("neighbors"))
    for c, label in fallbacks:
        pred = pred.when(F.col(c).isNotNull(), F.col(c))
        src = src.when(F.col(c).isNotNull(), F.lit(label))
    return pred.otherwise(global_mean), src.otherwise(F.lit("global_mean"))


def item_based_prediction(
    truth: DataFrame,
    top: DataFrame,
    ustats: DataFrame,
    global_mean: Column,
    fallbacks: list[tuple[str, str]] | None = None,
    clamp: tuple[float, float] | None = None,
) -> DataFrame:
    """sum(r_nbr * sim) / sum(|sim|) over the top neighbours when both sums
    are non-zero; otherwise the first non-null of ``fallbacks`` (columns of
    ``truth`` with their source label, e.g. a genre mean), then the user's
    training mean, then the global training mean (user with no rating).

    Returns (user, item, rating, prediction, source, n_neighbors).
    """
    fallbacks = list(fallbacks or [])
    agg = neighbour_sums(top, F.col("nbr_rating") * F.col("sim"))
    extra = [c for c, _ in fallbacks]
    j = (
        with_rating(truth).select("user", "item", "rating", *extra)
        .join(agg, ["user", "item"], "left")
        .join(ustats.select("user", "mean_rating"), "user", "left")
    )
    ok = F.coalesce((F.col("num") != 0) & (F.col("den") != 0), F.lit(False))
    pred, src = _fallback_chain(
        ok,
        F.col("num") / F.when(ok, F.col("den")),
        fallbacks + [("mean_rating", "user_mean")],
        global_mean,
    )
    return j.select(
        "user",
        "item",
        "rating",
        _clamp(pred, clamp).alias("prediction"),
        src.alias("source"),
        F.coalesce(F.col("n_neighbors"), F.lit(0).cast("bigint")).alias("n_neighbors"),
    )


def leave_one_out_deviation(loo: str = "literal") -> Column:
    """r_nbr minus the neighbour's mean without this rating.

    ``literal`` reproduces the reference formula, where the ``- 1`` sits
    outside the division: (sum - r) / n - 1.
    ``corrected``: (sum - r) / (n - 1); a neighbour with one rating has no
    other ratings, so its deviation is taken as 0.
    """
    r, n, s = F.col("nbr_rating"), F.col("nbr_n").cast("double"), F.col("nbr_sum")
    if loo == "literal":
        return r - ((s - r) / n - F.lit(1.0))
    if loo == "corrected":
        many = F.col("nbr_n") > 1
        return F.when(many, r - (s - r) / F.when(many, n - F.lit(1.0))).otherwise(F.lit(0.0))
    raise ValueError(f"loo must be one of {LOO_MODES}")


def user_based_prediction(
    truth: DataFrame,
    top: DataFrame,
    ustats: DataFrame,
    global_mean: Column,
    loo: str = "literal",
    clamp: tuple[float, float] | None = None,
) -> DataFrame:
    """mean(u) + sum(dev_nbr * sim) / sum(|sim|) when both sums are non-zero;
    else mean(u) (also when nobody else rated the item); global mean for a
    user with no training rating.

    Returns (user, item, rating, prediction, source, n_neighbors).
    """
    agg = neighbour_sums(top, leave_one_out_deviation(loo) * F.col("sim"))
    j = (
        with_rating(truth).select("user", "item", "rating")
        .join(agg, ["user", "item"], "left")
        .join(ustats.select("user", "mean_rating"), "user", "left")
    )
    ok = F.coalesce(
        (F.col("num") != 0) & (F.col("den") != 0) & F.col("mean_rating").isNotNull(), F.lit(False)
    )
    pred, src = _fallback_chain(
        ok,
        F.col("mean_rating") + F.col("num") / F.when(ok, F.col("den")),
        [("mean_rating", "user_mean")],
        global_mean,
    )
    return j.select(
        "user",
        "item",
        "rating",
        _clamp(pred, clamp).alias("prediction"),
        src.alias("source"),
        F.coalesce(F.col("n_neighbors"), F.lit(0).cast("bigint")).alias("n_neighbors"),
    )
