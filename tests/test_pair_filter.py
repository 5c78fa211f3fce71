"""The needed-pair filter and the split candidate join."""
import random

import pytest
from pyspark.sql import functions as F

from corate.operators import pair_filter
from corate.operators.neighbors import item_candidates, user_candidates
from corate.operators.skew import product_join
from corate.plans import pipelines as P
from corate.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _pairs(spark, n, seed):
    r = random.Random(seed)
    return spark.createDataFrame([(r.randrange(10**9), r.randrange(10**9)) for _ in range(n)], "a BIGINT, b BIGINT")


@pytest.mark.parametrize("n", [1, 500, 40_000])
def test_no_needed_pair_is_lost_and_few_others_pass(spark, n):
    need, other = _pairs(spark, n, 1), _pairs(spark, 20_000, 2)
    found = pair_filter.build(need, "a", "b")
    assert found.n_blocks == pair_filter.n_blocks(n) or n > 1000  # the count is approximate
    assert pair_filter.probe(need, found, "a", "b").count() == n
    assert pair_filter.probe(need, found, "b", "a").count() == n  # pairs have no direction
    assert pair_filter.probe(other, found, "a", "b").count() < 0.05 * 20_000


def test_filters_merge_over_partitions(spark):
    need = _pairs(spark, 3000, 3)
    words = [{r.block: r.words for r in pair_filter.build(need.repartition(p), "a", "b").blocks.collect()} for p in (1, 7)]
    assert words[0] == words[1]


def test_size_is_checked(spark):
    assert pair_filter.n_blocks(0) == 1
    most = pair_filter.MAX_BYTES * 8
    assert pair_filter.n_blocks(most // 2) * pair_filter.BLOCK_BITS == most
    assert pair_filter.n_blocks(most // 2 + 1) is None
    assert pair_filter.build(_pairs(spark, 100, 1), "a", "b", max_bytes=0) is None


def test_filter_of_nothing_passes_nothing(spark):
    found = pair_filter.build(spark.createDataFrame([], "a BIGINT, b BIGINT"), "a", "b")
    assert pair_filter.probe(_pairs(spark, 50, 1), found, "a", "b").count() == 0


def test_jobs_do_not_change_with_the_filter(spark):
    prep = Q.prepared(spark, SF)
    for job in (P.item_based, P.user_based):
        with_filter = sorted(map(tuple, job(prep, restrict=True).predictions.collect()))
        without = sorted(map(tuple, job(prep, restrict=False).predictions.collect()))
        assert with_filter == without == sorted(map(tuple, job(prep).predictions.collect()))


def test_filter_cuts_the_rows_that_are_aggregated(spark):
    prep = Q.prepared(spark, SF)
    cand = item_candidates(prep.truth, prep.train)
    keep = P.needed_pairs(cand, "item")
    every, left = P.item_pairs(prep).count(), P.item_pairs(prep, keep=keep).count()
    assert 0 < left < 0.7 * every


def _hot(spark, n_left=300, n_right=2000):
    left = spark.range(n_left).selectExpr("7L AS k", "id AS l").union(spark.range(50).selectExpr("id AS k", "id AS l"))
    right = spark.range(n_right).selectExpr("7L AS k", "id AS r").union(spark.range(60).selectExpr("id AS k", "id AS r"))
    return left, right


def test_split_join_equals_plain_join(spark):
    left, right = _hot(spark)
    plain = sorted(map(tuple, left.join(right, "k").select("k", "l", "r").collect()))
    split = product_join(left, right, "k", "l", "r", budget=10_000)
    assert sorted(map(tuple, split.select("k", "l", "r").collect())) == plain


def test_hot_item_is_spread_over_tasks(spark):
    """One item with many raters and many test pairs: no task makes a tenth of its candidates."""
    truth = spark.range(500).selectExpr("id + 100000 AS user", "id div 1000000 AS item")
    train = spark.range(5000).selectExpr("id AS user", "id div 1000000 AS item", "1.0D AS rating", "3L AS n_ratings", "3.0D AS sum_rating")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        cand = user_candidates(truth, train, budget=20_000)
        per_task = [r["count"] for r in cand.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 500 * 5000 and max(per_task) < 0.1 * sum(per_task)
