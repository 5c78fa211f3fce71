"""Rating dedup and the hold-out split."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Split(NamedTuple):
    train: DataFrame   # user, item, rating: ratings whose key is not a test pair
    truth: DataFrame   # user, item, rating: ratings whose key is a test pair
    test: DataFrame    # user, item: all test pairs, answered or not


def dedup_last(events: DataFrame, order_col: str = "seq", keys=("user", "item")) -> DataFrame:
    """One rating per key; the event that is last in ``order_col`` wins.

    Uses ``max_by`` as an aggregate rather than a ranking window, so the work
    is combined map-side and a key repeated a billion times costs one small
    buffer per task instead of one sorted group in one task.
    """
    return events.groupBy(*keys).agg(F.max_by("rating", order_col).alias("rating"))


def flag_holdout(ratings: DataFrame, test: DataFrame) -> DataFrame:
    """ratings + ``held_out`` (true when the key is a test pair), one join.

    Writing this frame once (partitioned by ``held_out``) yields both the
    training and the truth set from a single pass over the ratings.
    """
    keys = test.select("user", "item").withColumn("held_out", F.lit(True))
    return ratings.join(keys, ["user", "item"], "left").withColumn(
        "held_out", F.coalesce(F.col("held_out"), F.lit(False))
    )


def holdout_split(ratings: DataFrame, test: DataFrame) -> Split:
    """train = ratings without any test pair; truth = ratings of test pairs.

    ``test`` must be distinct on (user, item) (``prepare`` makes it so).
    Both joins shuffle on (user, item); when ``ratings`` comes straight from
    ``dedup_last`` it is already partitioned that way and only ``test`` moves.
    """
    keys = test.select("user", "item")
    train = ratings.join(keys, ["user", "item"], "left_anti")
    truth = ratings.join(keys, ["user", "item"], "left_semi")
    return Split(train, truth, keys)
