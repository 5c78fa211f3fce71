"""Item-item and user-user similarity tables.

Both are built from the co-rating self-join followed by one ``groupBy`` on the
pair. On sparse data most pairs have one co-rater, so combining them map-side
saves nothing: the rows are dealt by first member as lists (``skew.dealt_pairs``)
and summed behind that one exchange. Pairs that share no rater / no item are
not in the tables; lookups treat them as similarity 0.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from corate.functions.exact import ExactMoments
from corate.functions.columns import centred_pearson, noise, pearson_from_moments, sum_normalized
from corate.operators.exact_pairs import exact_pearson
from corate.operators.skew import DEFAULT_HOT_ROWS, DEFAULT_MAX_BUCKETS, dealt_pairs, later_members, member_pairs

ITEM_METRICS = ("pearson", "sum_normalized")


class Pairs(NamedTuple):
    """What is known of the co-rating self-join, so that it need not be counted."""

    rows: int = -1            # its rows, -1 if unknown
    most: int | None = None   # bound of the rows of one first member


def _pair_rows(
    df: DataFrame, group: str, member: str, value: str, hot_rows: int | None, max_buckets: int | None, anchors: DataFrame | None,
    no_hot: bool, keep: Callable[[DataFrame], DataFrame] | None, known: Pairs, needed: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """(rows (m1, m2, v_1, v_2) of members m1 < m2 of a group, key of a pair).

    All pairs are dealt as lists by first member. Where ``anchors`` or ``keep``
    leave few of them, these rows are made at once and combined map-side."""
    if anchors is None and keep is None:
        return dealt_pairs(later_members(df, group, member, value, hot_rows, max_buckets, no_hot), *known, needed)
    rows = member_pairs(df, group, member, [value], hot_rows, max_buckets, anchors, no_hot, keep)
    return rows.withColumnRenamed(f"{value}_1", "v_1").withColumnRenamed(f"{value}_2", "v_2"), ["m1", "m2"]


def item_pair_moments(
    train: DataFrame,
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    max_buckets: int | None = DEFAULT_MAX_BUCKETS,
    anchors: DataFrame | None = None,
    no_hot: bool = False,
    shift: Column | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    known: Pairs = Pairs(),
    needed: DataFrame | None = None,
) -> DataFrame:
    """(item1, item2, n_corated, sx, sy, sxy, sxx, syy) over users who rated
    both items; item1 < item2; x is the rating of item1, y of item2, both less
    ``shift`` (rounded to a whole number, which keeps grid ratings on a grid).
    ``anchors`` (column ``item``) limits it to pairs touching those items;
    ``no_hot``: no user is known to exceed ``hot_rows``; ``keep`` drops rows
    of pairs (m1, m2) that are not needed; ``needed`` (m1, m2s): only these
    pairs, also those without a co-rater."""
    p, key = _pair_rows(train, "user", "item", "rating", hot_rows, max_buckets, anchors, no_hot, keep, known, needed)
    x, y = F.col("v_1"), F.col("v_2")
    if shift is not None:
        by = F.coalesce(F.round(shift), F.lit(0.0))
        x, y = x - by, y - by
    sums = {"sx": x, "sy": y, "sxy": x * y, "sxx": x * x, "syy": y * y}
    return _pair_sums(p, key, [F.sum(v).alias(k) for k, v in sums.items()])


def _pair_sums(rows: DataFrame, key: list[str], sums: list[Column], member: str = "item", count: str = "n_corated") -> DataFrame:
    """(item1, item2, n_corated, sums) of the rows of each pair; of those in need only, if rows say which are."""
    if "need" not in rows.columns:
        found = rows.groupBy(*key).agg(F.count("*").alias(count), *sums)
    else:
        found = rows.groupBy(*key).agg(F.count_if(~F.col("need")).alias(count), F.bool_or("need").alias("_asked"), *sums)
        found = found.where("_asked").drop("_asked")
    return found.withColumnRenamed("m1", f"{member}1").withColumnRenamed("m2", f"{member}2").drop("_b")


def item_similarity(
    train: DataFrame,
    metric: str = "pearson",
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    max_buckets: int | None = DEFAULT_MAX_BUCKETS,
    anchors: DataFrame | None = None,
    no_hot: bool = False,
    shift: Column | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    exact_top: int | None = None,
    known: Pairs = Pairs(),
    needed: DataFrame | None = None,
) -> DataFrame:
    """(item1, item2, n_corated, sim) for every co-rated item pair (touching
    ``anchors``, when given; ``no_hot``, ``keep`` and ``needed`` as in
    ``item_pair_moments``).

    ``pearson``: correlation with means taken over the co-raters only.
    Ratings on a grid have exact sums as doubles; for others give
    ``exact_top`` (|rating| < 2^exact_top) for exact integer sums, which are
    the same whatever the order of rows and right to the last places however
    nearly constant a series is. Without it ``shift``, the mean training
    rating, keeps double sums from cancelling more than they must.
    ``sum_normalized``: Sxy / (Sx * Sy) over the co-raters.
    Either is 0 when its numerator or denominator is 0.
    """
    if metric not in ITEM_METRICS:
        raise ValueError(f"metric must be one of {ITEM_METRICS}")
    if metric == "pearson" and exact_top is not None and anchors is None and keep is None and needed is None and isinstance(train.schema["item"].dataType, IntegralType):
        # a group by pair would hold 16 sums of every pair
        lists = later_members(train, "user", "item", "rating", hot_rows, max_buckets, no_hot)
        m = exact_pearson(dealt_pairs(lists, *known, in_order=True)[0], exact_top)
        return m.withColumnsRenamed({"m1": "item1", "m2": "item2"})
    if metric == "pearson" and exact_top is not None:
        p, key = _pair_rows(train, "user", "item", "rating", hot_rows, max_buckets, anchors, no_hot, keep, known, needed)
        cut, sums = ExactMoments.of(p, "v_1", "v_2", exact_top)
        m = _pair_sums(cut, key, sums.aggregates())
        return sums.finish(m, "n_corated").select("item1", "item2", "n_corated", "sim")
    if metric != "pearson":
        shift = None
    m = item_pair_moments(train, hot_rows, max_buckets, anchors, no_hot, shift, keep, known, needed)
    if metric == "pearson":
        sim = pearson_from_moments("n_corated", "sx", "sy", "sxy", "sxx", "syy")
    else:
        sim = sum_normalized("sxy", "sx", "sy")
    return m.select("item1", "item2", "n_corated", sim.alias("sim"))


def centred_ratings(train: DataFrame, ustats: DataFrame) -> DataFrame:
    """train + ``dev = n_u * rating - sum_u`` (n_u times the deviation from
    the user's overall training mean, which keeps grid ratings exact; 0 when
    within the rounding errors of the sum)."""
    n = F.col("n_ratings").cast("double")
    dev = n * F.col("rating") - F.col("sum_rating")
    return train.join(ustats.select("user", "n_ratings", "sum_rating"), "user").withColumn(
        "dev", F.when(F.abs(dev) > noise(n) * n * F.abs("rating"), dev).otherwise(F.lit(0.0))
    )


def user_similarity(
    train: DataFrame,
    ustats: DataFrame,
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    max_buckets: int | None = DEFAULT_MAX_BUCKETS,
    anchors: DataFrame | None = None,
    centred: DataFrame | None = None,
    no_hot: bool = False,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    known: Pairs = Pairs(),
    needed: DataFrame | None = None,
) -> DataFrame:
    """(user1, user2, n_common, sim): Pearson over the items both rated, with
    each user's deviation taken from that user's overall training mean.
    ``anchors`` (column ``user``) limits it to pairs touching those users;
    ``centred`` reuses a ``centred_ratings`` frame (e.g. laid out by item);
    ``no_hot``: no item is known to exceed ``hot_rows`` raters; ``keep`` drops
    rows of pairs (m1, m2) that are not needed; ``needed`` (m1, m2s): only these
    pairs, also those without a common item."""
    if centred is None:
        centred = centred_ratings(train, ustats)
    c = centred.select("item", "user", "dev")
    p, key = _pair_rows(c, "item", "user", "dev", hot_rows, max_buckets, anchors, no_hot, keep, known, needed)
    a, b = F.col("v_1"), F.col("v_2")
    sums = {"sab": a * b, "saa": a * a, "sbb": b * b}
    m = _pair_sums(p, key, [F.sum(v).alias(k) for k, v in sums.items()], "user", "n_common")
    return m.select("user1", "user2", "n_common", centred_pearson("sab", "saa", "sbb").alias("sim"))
