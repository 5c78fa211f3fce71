"""Per-user, per-item and per-(user, genre) statistics over the training set,
and bounded adjacency listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.operators.sizing import broadcast_if_small


def user_stats(train: DataFrame) -> DataFrame:
    """(user, n_ratings, sum_rating, mean_rating)."""
    return train.groupBy("user").agg(
        F.count("*").alias("n_ratings"),
        F.sum("rating").alias("sum_rating"),
        F.avg("rating").alias("mean_rating"),
    )


def item_stats(train: DataFrame) -> DataFrame:
    """(item, n_ratings, sum_rating, mean_rating)."""
    return train.groupBy("item").agg(
        F.count("*").alias("n_ratings"),
        F.sum("rating").alias("sum_rating"),
        F.avg("rating").alias("mean_rating"),
    )


def user_genre_stats(train: DataFrame, genres: DataFrame) -> DataFrame:
    """(user, genre, n_ratings, mean_rating): the user's mean over training
    items whose genre string is exactly ``genre``.

    The genre table has one row per item: it is broadcast when its row count
    is within ``sizing.DEFAULT_BROADCAST_ROWS`` (checked), so the ratings do not
    move and, on the user layout, the (user, genre) aggregate needs no
    exchange; a larger catalogue is a shuffle join.
    """
    return (
        train.join(broadcast_if_small(genres.select("item", "genre")), "item")
        .groupBy("user", "genre")
        .agg(F.count("*").alias("n_ratings"), F.avg("rating").alias("mean_rating"))
    )


def adjacency_lists(
    train: DataFrame, key: str, member: str, block: int = 1000
) -> DataFrame:
    """The key -> members grouping, paged by member-id block.

    Returns (key, <member>_block, n_members, members) where ``members`` is the
    space-separated ascending member ids in ``[block*b, block*(b+1))``.
    (key, member) is unique in ``train``, so no output row ever holds more
    than ``block`` members, however many ratings a single key has.
    """
    blk = F.floor(F.col(member) / F.lit(block)).cast("bigint")
    return (
        train.select(key, member)
        .withColumn(f"{member}_block", blk)
        .groupBy(key, f"{member}_block")
        .agg(
            F.count("*").alias("n_members"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(member)), lambda x: x.cast("string")),
                " ",
            ).alias("members"),
        )
    )
