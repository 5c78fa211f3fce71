"""Salting a hot group must not change the pair set or the similarities."""

from pyspark.sql import functions as F

from corate.operators.similarity import item_similarity, user_similarity
from corate.operators.skew import member_pairs
from corate.operators.stats import user_stats


def _train(spark):
    # user 0 rated 300 items (the hot group); others rate a few
    rows = [(0, i, float(i % 10 + 1) / 2) for i in range(300)]
    rows += [(u, (u * 37 + j * 11) % 300, float((u + j) % 10 + 1) / 2) for u in range(1, 80) for j in range(6)]
    df = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")
    return df.dropDuplicates(["user", "item"])


def test_member_pairs_salted_equals_plain(spark):
    t = _train(spark)
    plain = member_pairs(t, "user", "item", ["rating"], hot_rows=None)
    salted = member_pairs(t, "user", "item", ["rating"], hot_rows=50, max_buckets=5)
    a = sorted(tuple(r) for r in plain.select("user", "m1", "m2", "rating_1", "rating_2").collect())
    b = sorted(tuple(r) for r in salted.select("user", "m1", "m2", "rating_1", "rating_2").collect())
    assert a == b
    assert len(a) == 300 * 299 // 2 + sum(1 for _ in a if _[0] != 0)


def test_similarities_unchanged_by_salting(spark):
    t = _train(spark)
    a = {(r[0], r[1]): (r[2], r[3]) for r in item_similarity(t, hot_rows=None).collect()}
    b = {(r[0], r[1]): (r[2], r[3]) for r in item_similarity(t, hot_rows=40, max_buckets=8).collect()}
    assert a == b
    us = user_stats(t)
    c = {(r[0], r[1]): r[3] for r in user_similarity(t, us, hot_rows=None).collect()}
    d = {(r[0], r[1]): r[3] for r in user_similarity(t, us, hot_rows=3, max_buckets=4).collect()}
    assert c == d


def test_hot_group_is_spread_over_tasks(spark):
    """The pairs of one large group, counted per task with broadcasts off and AQE as it is."""
    n = 3000
    t = spark.range(n).selectExpr("id div 1000000 AS user", "id AS item", "1.0D AS rating")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        pairs = member_pairs(t, "user", "item", ["rating"], hot_rows=200)
        per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(per_task) == n * (n - 1) // 2
    assert max(per_task) <= 0.1 * sum(per_task)


def test_anchored_pairs_equal_filtered_full_pairs(spark):
    t = _train(spark)
    anchors = spark.createDataFrame([(5,), (17,), (250,), (299,)], "item BIGINT")
    full = item_similarity(t, hot_rows=None).filter(
        F.col("item1").isin(5, 17, 250, 299) | F.col("item2").isin(5, 17, 250, 299))
    a = sorted(tuple(r) for r in full.collect())
    for hr in (None, 40):
        b = sorted(tuple(r) for r in item_similarity(t, hot_rows=hr, max_buckets=6, anchors=anchors).collect())
        assert a == b


def test_anchored_user_sims_and_no_broadcast_path(spark):
    from corate.operators import skew

    t = _train(spark)
    us = user_stats(t)
    anchors = spark.createDataFrame([(0,), (3,), (40,)], "user BIGINT")
    full = {(r[0], r[1]): r[3] for r in user_similarity(t, us, hot_rows=None).collect()
            if r[0] in (0, 3, 40) or r[1] in (0, 3, 40)}
    old = skew.MAX_BROADCAST_GROUPS
    try:
        skew.MAX_BROADCAST_GROUPS = 0  # force the shuffle-join path for the hot list
        got = {(r[0], r[1]): r[3] for r in user_similarity(t, us, hot_rows=3, max_buckets=4, anchors=anchors).collect()}
    finally:
        skew.MAX_BROADCAST_GROUPS = old
    # no group above the threshold: plain self-join path
    got2 = {(r[0], r[1]): r[3] for r in user_similarity(t, us, hot_rows=10**9, anchors=anchors).collect()}
    assert got2 == full
    assert got == full


def test_restricted_item_based_equals_full(spark):
    from corate.plans import queries as Q
    from corate.plans import pipelines as P

    prep = Q.prepared(spark, "/root/testdata/sf0.001")
    few = prep.truth.filter(F.col("item") % 5 == 0)
    a = {(r["user"], r["item"]): (r["prediction"], r["source"])
         for r in P.item_based(prep, pairs=few, restrict=False).predictions.collect()}
    b = {(r["user"], r["item"]): (r["prediction"], r["source"])
         for r in P.item_based(prep, pairs=few, restrict=True).predictions.collect()}
    assert a == b and len(a) > 0
    c = {(r["user"], r["item"]): (r["prediction"], r["source"])
         for r in P.user_based(prep, pairs=few, restrict=False).predictions.collect()}
    d = {(r["user"], r["item"]): (r["prediction"], r["source"])
         for r in P.user_based(prep, pairs=few, restrict=True).predictions.collect()}
    assert c == d


def test_hot_user_disables_user_layout_and_keeps_results(spark):
    from corate.plans import pipelines as P

    rows = [(0, i, float(i % 10 + 1) / 2) for i in range(60)]
    rows += [(u, (u * 7 + j) % 60, float((u + j) % 10 + 1) / 2) for u in range(1, 25) for j in range(4)]
    r = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE").dropDuplicates(["user", "item"])
    t = spark.createDataFrame([(0, 3), (0, 17), (5, (5 * 7) % 60), (9, (9 * 7 + 1) % 60)], "user BIGINT, item BIGINT")
    hot = P.prepare(r, t, order_col=None, materialize_how="persist", hot_rows=20)
    plain = P.prepare(r, t, order_col=None, materialize_how="persist", by_user=True, hot_rows=None)
    # the layout was skipped for the hot run: train is not a repartitioned cache
    assert "REPARTITION_BY_NUM" not in hot.train._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plain.train._jdf.queryExecution().executedPlan().toString()
    a = {(x["user"], x["item"]): x["prediction"] for x in P.item_based(hot, hot_rows=20).predictions.collect()}
    b = {(x["user"], x["item"]): x["prediction"] for x in P.item_based(plain, hot_rows=None).predictions.collect()}
    assert a == b and len(a) == 4
