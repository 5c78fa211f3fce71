"""Pairs of members that share a group, with hot groups split into buckets.

The co-rating self-join (items rated by the same user, users who rated the
same item) emits one row per pair of members of a group. A group holding a
large share of all rows would put its quadratic pair work into one task, so
groups above ``hot_rows`` members are salted: each member gets a bucket
``b = xxhash64(member) mod nb``; a left row of bucket b1 is sent to every key
(group, b1, *) and a right row of bucket b2 to every key (group, *, b2). Each
(left, right) pair then meets under exactly one key (group, b1, b2), and the
group's work is spread over nb*nb keys, dealt to ``spark.sql.shuffle.partitions``
tasks by an explicit repartition that the adaptive planner leaves alone. Ordinary
groups are joined as they are, without an exchange if they are laid out by
group. The bound is on the pairs of a key, not on its rows: ``HOT_PAIRS``.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs of one join key that a task may have to make (seconds of work); a
#: group of more members than give so many is split.
HOT_PAIRS = 5_000_000
DEFAULT_HOT_ROWS = isqrt(2 * HOT_PAIRS)
DEFAULT_MAX_BUCKETS = None  # as many as the group needs
#: Co-rating rows of a partition of ``dealt_pairs``, and of one first member
#: beyond which its rows are dealt to several partitions.
DEALT_PAIRS = 2_000_000
HOT_MEMBER_PAIRS = 20_000_000
MAX_BROADCAST_GROUPS = 100_000


def hot_groups(df: DataFrame, group: str, hot_rows: int, max_buckets: int | None) -> DataFrame:
    """(group, _nb) for groups with more than ``hot_rows`` rows, with
    ``_nb = ceil(rows / hot_rows)`` buckets each (at most ``max_buckets``, if given)."""
    nb = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    nb = nb if max_buckets is None else F.least(nb, F.lit(max_buckets))
    return (
        df.groupBy(group)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(group, nb.alias("_nb"))
    )


def attach_buckets(
    df: DataFrame, group: str, hot_rows: int, max_buckets: int | None,
    max_broadcast: int | None = None,
) -> DataFrame | None:
    """df + ``_nb`` (bucket count of the row's group, 1 if not hot), or None
    when no group is hot (then no salting is needed at all).

    The hot list is counted first and broadcast only when it has at most
    ``max_broadcast`` groups (about 16 bytes each); beyond that it is a shuffle
    join, where AQE's skew handling splits the hot groups' partitions (the
    other side has one row per group).
    """
    limit = MAX_BROADCAST_GROUPS if max_broadcast is None else max_broadcast
    hot = hot_groups(df, group, hot_rows, max_buckets)
    n_hot = hot.count()
    if n_hot == 0:
        return None
    side = F.broadcast(hot) if n_hot <= limit else hot
    return df.join(side, group, "left").withColumn("_nb", F.coalesce("_nb", F.lit(1)))


def member_pairs(
    df: DataFrame,
    group: str,
    member: str,
    values: list[str],
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    max_buckets: int | None = DEFAULT_MAX_BUCKETS,
    anchors: DataFrame | None = None,
    no_hot: bool = False,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows (group, m1, m2, <v>_1..., <v>_2...) for members m1 < m2 of a group.

    ``df`` must be unique on (group, member). ``hot_rows=None`` disables the
    salting (plain self-join on ``group``). ``anchors`` (a frame with a
    ``member`` column) restricts the output to pairs with at least one member
    among the anchors; the left side of the join then holds anchor rows only,
    so the work shrinks with the anchor set. ``no_hot``: the caller already
    knows that no group exceeds ``hot_rows`` (skips counting them again).
    ``keep`` is applied to the rows, e.g. to drop pairs nobody asks for.
    """
    d = df.select(group, member, *values)
    if anchors is not None:
        a = anchors.select(member).distinct().withColumn("_anc", F.lit(True))
        d = d.join(a, member, "left").withColumn("_anc", F.coalesce("_anc", F.lit(False)))
        anc = F.col("_anc")
    else:
        # no column for it: both join sides then prune to the same projection
        # and can share one exchange
        anc = F.lit(True)
    sides = lambda rows, left, right: (
        (rows.filter(F.col("_anc")) if anchors is not None else rows).select(
            group, *left, F.col(member).alias("_l"), *[F.col(v).alias(f"_l_{v}") for v in values]),
        rows.select(group, *right, F.col(member).alias("_r"), anc.alias("_r_anc"), *[F.col(v).alias(f"_r_{v}") for v in values]),
    )
    salted = None if hot_rows is None or no_hot else attach_buckets(d, group, hot_rows, max_buckets)
    ordinary = d if salted is None else salted.filter(F.col("_nb") == 1)
    left, right = sides(ordinary, [], [])
    j = left.join(right, group)
    if salted is not None:
        hot = salted.filter(F.col("_nb") > 1).withColumn("_b", F.pmod(F.xxhash64(member), F.col("_nb")).cast("int"))
        fan = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
        left, right = sides(hot, [F.col("_b").alias("_b1"), fan.alias("_b2")], [fan.alias("_b1"), F.col("_b").alias("_b2")])
        # dealt explicitly: the adaptive planner merges partitions by their bytes,
        # which would put all buckets of a group back into one task
        keys = [group, "_b1", "_b2"]
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        j = j.unionByName(left.repartition(n, *keys).join(right.repartition(n, *keys), keys).drop("_b1", "_b2"))
    if anchors is None:
        j = j.filter(F.col("_l") < F.col("_r"))
        out = j.select(
            group,
            F.col("_l").alias("m1"),
            F.col("_r").alias("m2"),
            *[F.col(f"_l_{v}").alias(f"{v}_1") for v in values],
            *[F.col(f"_r_{v}").alias(f"{v}_2") for v in values],
        )
        return out if keep is None else keep(out)
    # anchor on the left; a pair of two anchors is kept once (left < right)
    j = j.filter((F.col("_l") != F.col("_r")) & (~F.col("_r_anc") | (F.col("_l") < F.col("_r"))))
    lo_left = F.col("_l") < F.col("_r")
    out = j.select(
        group,
        F.least("_l", "_r").alias("m1"),
        F.greatest("_l", "_r").alias("m2"),
        *[F.when(lo_left, F.col(f"_l_{v}")).otherwise(F.col(f"_r_{v}")).alias(f"{v}_1") for v in values],
        *[F.when(lo_left, F.col(f"_r_{v}")).otherwise(F.col(f"_l_{v}")).alias(f"{v}_2") for v in values],
    )
    return out if keep is None else keep(out)


def _lists(rows: DataFrame, keys: list[str], member: str, value: str) -> DataFrame:
    """(keys, _ids, _vs): the members of each key in ascending order, and their values."""
    held = F.sort_array(F.collect_list(F.struct(member, value))).alias("_held")
    found = rows.groupBy(*keys).agg(held)
    return found.select(*keys, F.col("_held").getField(member).alias("_ids"), F.col("_held").getField(value).alias("_vs"))


def later_members(
    df: DataFrame, group: str, member: str, value: str, hot_rows: int | None = DEFAULT_HOT_ROWS,
    max_buckets: int | None = DEFAULT_MAX_BUCKETS, no_hot: bool = False,
) -> DataFrame:
    """(m1, v1, m2s, v2s): each member of a group with the greater members of
    the group and their values, as lists. Groups above ``hot_rows`` are dealt
    in buckets as in ``member_pairs``, so no list is longer than a bucket."""
    d = df.select(group, member, value).where(F.col(group).isNotNull() & F.col(member).isNotNull())
    salted = None if hot_rows is None or no_hot else attach_buckets(d, group, hot_rows, max_buckets)
    ordinary = _lists(d if salted is None else salted.where("_nb = 1"), [group], member, value)
    after = lambda c, at: F.slice(c, at + 1, F.size(c)).alias("m2s" if c == "_ids" else "v2s")
    each = ordinary.where(F.size("_ids") > 1).select("_ids", "_vs", F.posexplode("_ids").alias("_at", "m1"))
    at = F.col("_at") + 1
    out = each.where(at < F.size("_ids")).select("m1", F.get("_vs", F.col("_at")).alias("v1"), after("_ids", at), after("_vs", at))
    if salted is None:
        return out
    hot = salted.where("_nb > 1").withColumn("_b", F.pmod(F.xxhash64(member), F.col("_nb")).cast("int"))
    fan = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    left = hot.select(group, F.col("_b").alias("_b1"), fan.alias("_b2"), F.col(member).alias("m1"), F.col(value).alias("v1"))
    right = _lists(hot, [group, "_nb", "_b"], member, value).select(group, fan.alias("_b1"), F.col("_b").alias("_b2"), "_ids", "_vs")
    keys = [group, "_b1", "_b2"]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = left.repartition(n, *keys).join(right.repartition(n, *keys), keys)
    met = met.withColumn("_at", F.size(F.filter("_ids", lambda x: x <= F.col("m1")))).where(F.col("_at") < F.size("_ids"))
    return out.unionByName(met.select("m1", "v1", after("_ids", F.col("_at")), after("_vs", F.col("_at"))))


def dealt_pairs(
    lists: DataFrame, pair_rows: int = -1, most: int | None = None, needed: DataFrame | None = None, in_order: bool = False
) -> tuple[DataFrame, list[str]]:
    """(rows (m1, m2, v_1, v_2), key): the pairs of ``later_members``, dealt by
    first member, so that grouping them by ``key`` (m1 and m2) needs no exchange.

    What is shuffled is a member with a list, about a quarter of a row per pair.
    ``pair_rows``: pairs in all, -1 if unknown (sizes the partitions).
    ``most``: bound of the pairs of one first member, those of ``needed`` among
    them (None: they are counted);
    a member with more than ``HOT_MEMBER_PAIRS`` is dealt by its pairs.
    ``needed`` (m1, m2s): pairs somebody asks for; they are put between the
    others with ``need`` true and null values. ``in_order``: the rows of a
    partition are in order of m1 (the lists are sorted, not the pairs)."""
    none = F.lit(None).cast("double")
    if needed is not None:
        asked = needed.select("m1", none.alias("v1"), "m2s", F.transform("m2s", lambda x: none).alias("v2s"), F.lit(True).alias("need"))
        lists = lists.withColumn("need", F.lit(False)).unionByName(asked)
    dealt, key = deal_lists(lists, pair_rows, most)
    if in_order:
        dealt = dealt.sortWithinPartitions("m1")
    kept = [c for c in dealt.columns if c not in ("m2s", "v2s")]
    rows = dealt.select(*kept, "v2s", F.posexplode("m2s").alias("_at", "m2"))
    rows = rows.select(*[c for c in kept if c != "v1"], "m2", F.col("v1").alias("v_1"), F.get("v2s", F.col("_at")).alias("v_2"))
    ordered = F.col("m1") < F.col("m2")
    return rows.where(ordered if needed is None else ordered | F.col("need")), [*key, "m2"]


def deal_lists(
    lists: DataFrame, pair_rows: int = -1, most: int | None = None, listed: tuple[str, ...] = ("m2s", "v2s"), hot_pairs: int | None = None
) -> tuple[DataFrame, list[str]]:
    """(``lists`` dealt by first member, key): a first member with more pairs
    than ``hot_pairs`` (``HOT_MEMBER_PAIRS``) is dealt by its pairs, each with
    lists of one element. ``listed``: the columns that are lists, ids first."""
    limit = HOT_MEMBER_PAIRS if hot_pairs is None else hot_pairs
    key, ids, rest = ["m1"], listed[0], listed[1:]
    if most is None or most > limit:
        load = lists.groupBy("m1").agg(F.sum(F.size(ids)).alias("_n")).where(F.col("_n") > limit)
        load = load.select("m1", F.ceil(F.col("_n") / F.lit(max(1, limit // 4))).cast("int").alias("_parts"))
        n_hot = load.count()
        if n_hot:
            key = ["m1", "_b"]
            side = F.broadcast(load) if n_hot <= MAX_BROADCAST_GROUPS else load
            known = lists.join(side, "m1", "left")
            single = known.where("_parts is not null").select(*[c for c in known.columns if c != ids], F.posexplode(ids).alias("_at", "_m2"))
            single = single.withColumn(ids, F.array("_m2"))
            for c in rest:
                single = single.withColumn(c, F.array(F.get(c, F.col("_at"))))
            single = single.withColumn("_b", F.pmod(F.xxhash64("_m2"), F.col("_parts")).cast("int"))
            lists = known.where("_parts is null").withColumn("_b", F.lit(0)).drop("_parts").unionByName(single.drop("_parts", "_at", "_m2"))
    n = max(int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pair_rows // DEALT_PAIRS))
    return lists.repartition(n, *key), key


def product_join(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, budget: int | None = HOT_PAIRS) -> DataFrame:
    """``left`` joined with ``right`` on ``key``, where few keys may have many rows on both sides.

    A key with more than ``budget`` (left rows x right rows) is dealt into
    blocks of about that many pairs: its left rows into some buckets by
    ``left_id``, its right rows by ``right_id``, every left bucket meeting
    every right bucket once. Other keys are joined as they are. ``budget``
    None: the caller knows of no such key (skips counting). Neither side is
    broadcast: the planner takes their sizes from compressed files, a few
    bytes for a row that the driver would hold in ten times as many.
    """
    right = right.hint("merge")
    if budget is None:
        return left.join(right, key)
    side = int(isqrt(budget))
    n = left.groupBy(key).agg(F.count("*").alias("_t")).join(right.groupBy(key).agg(F.count("*").alias("_r")).hint("merge"), key)
    parts = lambda c: F.ceil(F.col(c) / F.lit(side)).cast("int")
    hot = n.filter(F.col("_t") * F.col("_r") > budget).select(key, parts("_t").alias("_nl"), parts("_r").alias("_nr"))
    n_hot = hot.count()
    if n_hot == 0:
        return left.join(right, key)
    hot = F.broadcast(hot) if n_hot <= MAX_BROADCAST_GROUPS else hot
    names = [*left.columns, *[c for c in right.columns if c != key]]
    out = left.join(hot, key, "left_anti").join(right, key).select(*names)
    bucket = lambda i, c: F.pmod(F.xxhash64(i), F.col(c)).cast("int")
    fan = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    a = left.join(hot, key).select(*left.columns, bucket(left_id, "_nl").alias("_bl"), fan("_nr").alias("_br"))
    b = right.join(hot, key).select(*right.columns, fan("_nl").alias("_bl"), bucket(right_id, "_nr").alias("_br"))
    keys = [key, "_bl", "_br"]
    p = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.unionByName(a.repartition(p, *keys).join(b.repartition(p, *keys), keys).select(*names))
