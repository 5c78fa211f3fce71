"""Number of co-rated item pairs without building the pairs.

Items are numbered by popularity; a user's items become bitmaps of 64 items a
word. The words of all users of an item are OR-ed: the bits below the item's
own are the more popular items it forms a pair with, each pair counted once.
An item and a user's words up to its own are shuffled as one row of lists,
dealt by item; the more raters an item has, the fewer words come before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.operators.skew import DEALT_PAIRS, HOT_PAIRS, product_join
from corate.session import materialize


def numbered_items(train: DataFrame) -> DataFrame:
    """(item, ix): a number for each item, the most rated first, so that items rated together share words.

    Written once: numbers hold for one run only.
    """
    n = train.groupBy("item").agg(F.count("*").alias("n"))
    order = [F.desc("n"), "item"]
    ix = n.repartitionByRange(*order).sortWithinPartitions(*order).select("item", F.monotonically_increasing_id().alias("ix"))
    return materialize(ix, "auto", "item-ix")


def corated_pair_count(train: DataFrame, budget: int = HOT_PAIRS) -> DataFrame:
    """(n_pairs): unordered pairs of different items that some user rated both."""
    rows = train.where("user is not null").select("user", "item").join(numbered_items(train), "item").select("user", "ix")
    one = F.lit(1).cast("bigint")
    bit = F.call_function("shiftleft", one, (F.col("ix") % 64).cast("int"))
    words = rows.groupBy("user", F.shiftright("ix", 6).alias("w")).agg(F.bit_or(bit).alias("bits"))
    words = materialize(words, "auto", "item-words")
    spark = train.sparkSession
    n, m = F.sum(F.bit_count("bits")), F.count("*")
    load = words.groupBy("user").agg(n.alias("n"), m.alias("m")).select("user", (F.col("n") * F.col("m")).alias("met"))
    hot = load.where(F.col("met") > budget).select("user")
    known = load.agg(F.sum(F.col("met").cast("double")).alias("met"), F.count_if(F.col("met") > budget).alias("hot")).first()
    # the items of a word, one row each
    items = F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit("bits", b) == 1)).alias("b")
    ix = (F.shiftleft("w", 6) + F.col("b")).alias("ix")

    ordinary = words.join(hot, "user", "left_anti") if known["hot"] else words
    held = ordinary.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("held"))
    each = held.select(F.col("held.w").alias("ws"), F.col("held.bits").alias("bs"), F.posexplode("held").alias("at", "own"))
    each = each.select("at", F.col("own.w").alias("w"), F.col("own.bits").alias("bits"), "ws", "bs")
    first = lambda c: F.slice(c, 1, F.col("at") + 1).alias(c)
    lists = each.select("w", first("ws"), first("bs"), items).select(ix, "ws", "bs")
    if known["hot"]:
        much = words.join(hot, "user")
        met = product_join(much.select("user", "w", items).select("user", ix), much, "user", "ix", "w", budget)
        met = met.where(F.col("w") <= F.shiftright("ix", 6))
        lists = lists.unionByName(met.select("ix", F.array("w").alias("ws"), F.array("bits").alias("bs")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int((known["met"] or 0) / 2) // DEALT_PAIRS + 1)
    dealt = lists.repartition(parts, "ix").select("ix", "bs", F.posexplode("ws").alias("at", "w"))
    together = dealt.groupBy("ix", "w").agg(F.bit_or(F.get("bs", F.col("at"))).alias("bits"))
    # in the item's own word only the bits below its own
    own = (F.col("ix") % 64).cast("int")
    below = F.when(own > 0, F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(64) - own)).otherwise(F.lit(0).cast("bigint"))
    earlier = F.when(F.col("w") < F.shiftright("ix", 6), F.col("bits")).otherwise(F.col("bits").bitwiseAND(below))
    return together.agg(F.coalesce(F.sum(F.bit_count(earlier)), F.lit(0)).cast("bigint").alias("n_pairs"))
