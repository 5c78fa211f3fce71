"""Candidate neighbours of each test pair, their similarity, and the top k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.operators.skew import HOT_PAIRS, product_join


def item_candidates(truth: DataFrame, train: DataFrame, budget: int | None = HOT_PAIRS) -> DataFrame:
    """For test pair (user, item): every item ``nbr`` the user rated in training.

    Returns (user, item, nbr, nbr_rating). The held-out answer is not carried
    through the shuffles; it is joined back at the end. A cold user has no
    rows here. Users with more than ``budget`` candidates are split over tasks.
    """
    t = truth.select("user", "item")
    r = train.select("user", F.col("item").alias("nbr"), F.col("rating").alias("nbr_rating"))
    return product_join(t, r, "user", "item", "nbr", budget).select("user", "item", "nbr", "nbr_rating")


def item_needed(truth: DataFrame, train: DataFrame, budget: int | None = HOT_PAIRS) -> DataFrame:
    """The item pairs of ``item_candidates`` as lists: (m1, m2s), m1 less than
    all of m2s; pairs repeat over users. A neighbour without an id gives the
    pair of the item with itself. ``budget`` as there: beyond it the pairs are
    made one by one."""
    if budget is not None:
        cand = item_candidates(truth, train, budget)
        return cand.select(F.least("item", "nbr").alias("m1"), F.array(F.greatest("item", "nbr")).alias("m2s"))
    return _needed_lists(truth, train, "user", "item")


def user_needed(truth: DataFrame, train: DataFrame, budget: int | None = HOT_PAIRS) -> DataFrame:
    """The user pairs of ``user_candidates``, as in ``item_needed``."""
    if budget is not None:
        cand = product_join(truth.select("user", "item"), train.select("item", F.col("user").alias("nbr")), "item", "user", "nbr", budget)
        return cand.select(F.least("user", "nbr").alias("m1"), F.array(F.greatest("user", "nbr")).alias("m2s"))
    return _needed_lists(truth, train, "item", "user")


def _needed_lists(truth: DataFrame, train: DataFrame, group: str, member: str) -> DataFrame:
    """(m1, m2s): each member of ``truth`` with the members of ``train`` in its
    group, from the lesser one. Lists are never broadcast: the planner takes
    each for one element."""
    def later(each: DataFrame, listed: DataFrame) -> DataFrame:
        lists = listed.groupBy(group).agg(F.collect_list(member).alias("_ids"), F.count_if(F.col(member).isNull()).alias("_none"))
        met = each.where(F.col(member).isNotNull()).select(group, F.col(member).alias("m1")).join(lists.hint("merge"), group)
        own = F.when(F.col("_none") > 0, F.array("m1")).otherwise(F.array().cast("array<bigint>"))
        return met.select("m1", F.concat(F.filter("_ids", lambda x: x > F.col("m1")), own).alias("m2s")).where(F.size("m2s") > 0)

    return later(truth, train).unionByName(later(train, truth))


def user_candidates(truth: DataFrame, centred_train: DataFrame, budget: int | None = HOT_PAIRS) -> DataFrame:
    """For test pair (user, item): every user ``nbr`` who rated the item in
    training, with that user's rating count and sum (for the leave-one-out mean).

    Returns (user, item, nbr, nbr_rating, nbr_n, nbr_sum). Items with more than
    ``budget`` candidates (test pairs x raters) are split over tasks.
    """
    t = truth.select("user", "item")
    r = centred_train.select(
        F.col("user").alias("nbr"),
        "item",
        F.col("rating").alias("nbr_rating"),
        F.col("n_ratings").alias("nbr_n"),
        F.col("sum_rating").alias("nbr_sum"),
    )
    return product_join(t, r, "item", "user", "nbr", budget).select("user", "item", "nbr", "nbr_rating", "nbr_n", "nbr_sum")


def attach_similarity(
    cand: DataFrame, sims: DataFrame, self_col: str, key1: str, key2: str
) -> DataFrame:
    """Add ``sim`` for the unordered pair (cand[self_col], cand.nbr).

    ``sims`` holds one row per pair with key1 < key2; absent pairs get 0.0,
    so zero-similarity neighbours stay candidates (they rank above negatives).
    Pairs whose similarity is exactly 0 are dropped from the lookup side
    first: the default supplies the same value, and on sparse data most
    co-rated pairs have one co-rater and similarity 0. The lookup side is never
    broadcast: the planner takes its size from the ratings' files and knows
    nothing of the pairs made of them, which may be hundreds of times as many.
    """
    lo = F.least(F.col(self_col), F.col("nbr"))
    hi = F.greatest(F.col(self_col), F.col("nbr"))
    c = cand.withColumn("_k1", lo).withColumn("_k2", hi)
    s = sims.filter(F.col("sim") != 0).select(
        F.col(key1).alias("_k1"), F.col(key2).alias("_k2"), F.col("sim")
    )
    return (
        c.join(s.hint("merge"), ["_k1", "_k2"], "left")
        .withColumn("sim", F.coalesce(F.col("sim"), F.lit(0.0)))
        .drop("_k1", "_k2")
    )


def candidate_pair_similarity(
    cand: DataFrame, sims: DataFrame, self_col: str, key1: str, key2: str, count_col: str
) -> DataFrame:
    """The distinct unordered pairs (cand[self_col], cand.nbr) with their
    similarity and co-rating count; pairs absent from ``sims`` get 0 and 0."""
    pairs = cand.select(
        F.least(F.col(self_col), F.col("nbr")).alias(key1),
        F.greatest(F.col(self_col), F.col("nbr")).alias(key2),
    ).distinct()
    return pairs.join(sims.hint("merge"), [key1, key2], "left").select(
        key1,
        key2,
        F.coalesce(F.col(count_col), F.lit(0).cast("bigint")).alias(count_col),
        F.coalesce(F.col("sim"), F.lit(0.0)).alias("sim"),
    )


def top_k(scored: DataFrame, k: int | None, by=("user", "item")) -> DataFrame:
    """Keep the k neighbours with the highest signed similarity per test pair
    (None: all, without a rank).

    Ties are broken by neighbour id ascending. ``row_number() <= k`` is planned
    as a partial group limit before the shuffle and a final one after it, so no
    test pair ships more than k rows per map task.
    """
    if k is None:
        return scored
    w = Window.partitionBy(*by).orderBy(F.col("sim").desc(), F.col("nbr").asc())
    return (
        scored.withColumn("nbr_rank", F.row_number().over(w))
        .filter(F.col("nbr_rank") <= k)
        .withColumn("nbr_rank", F.col("nbr_rank").cast("bigint"))
    )
