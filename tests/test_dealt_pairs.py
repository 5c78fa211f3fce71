"""Co-rating pairs dealt as lists, against the plain self-join."""
import pytest
from pyspark.sql import functions as F

from corate.functions.exact import ExactMoments, ExactSum
from corate.operators import pair_filter, skew
from corate.operators.neighbors import attach_similarity, candidate_pair_similarity, item_candidates, item_needed, user_candidates, user_needed
from corate.operators.similarity import item_similarity, user_similarity
from corate.operators.skew import dealt_pairs, later_members
from corate.operators.stats import user_stats
from corate.plans import pipelines as P
from corate.sources.tables import benchmark_inputs

DDL = "user BIGINT, item BIGINT, rating DOUBLE"


def _train(spark):
    rows = [(0, i, float(i % 10 + 1) / 2) for i in range(120)]
    rows += [(u, (u * 37 + j * 11) % 120, float((u + j) % 10 + 1) / 2) for u in range(1, 60) for j in range(6)]
    rows += [(None, 1, 2.0), (None, 2, 3.0), (3, None, 2.5), (4, 121, None), (4, 122, 1.0)]
    return spark.createDataFrame(rows, DDL).dropDuplicates(["user", "item"])


def _plain(t):
    a, b = t.alias("a"), t.alias("b")
    j = a.join(b, F.col("a.user") == F.col("b.user")).where("a.item < b.item")
    return sorted(map(str, j.select("a.item", "b.item", "a.rating", "b.rating").collect()))


@pytest.mark.parametrize("hot_rows, most, hot_member", [(None, 10**9, None), (40, None, None), (40, None, 50)])
def test_dealt_pairs_equal_the_self_join(spark, monkeypatch, hot_rows, most, hot_member):
    if hot_member:
        monkeypatch.setattr(skew, "HOT_MEMBER_PAIRS", hot_member)
    t = _train(spark)
    rows, key = dealt_pairs(later_members(t, "user", "item", "rating", hot_rows), -1, most)
    assert key == (["m1", "_b", "m2"] if hot_member else ["m1", "m2"])
    got = rows.select(F.col("m1").alias("item"), F.col("m2").alias("item"), F.col("v_1").alias("rating"), F.col("v_2").alias("rating"))
    assert sorted(map(str, got.collect())) == _plain(t)


def test_pairs_are_summed_behind_one_exchange(spark):
    """Rows of lists are shuffled, not a row per pair; the pairs of an item meet in its partition."""
    t = _train(spark)
    plan = item_similarity(t, hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1
    sums = plan[: plan.index("REPARTITION_BY_NUM")]
    assert "Exchange" not in sums.replace(sums[sums.rindex("Exchange"):], "")


def test_only_needed_pairs_with_those_no_user_rated_both(spark):
    train = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 1, 3.0), (2, 2, 5.0), (2, 3, 1.0), (3, 4, 2.0), (4, 5, 1.0), (4, None, 1.0)], DDL)
    truth = spark.createDataFrame([(3, 1), (1, 3), (4, 2)], "user BIGINT, item BIGINT")
    want = {(1, 4): 0, (1, 3): 1, (2, 3): 1, (2, 5): 0, (2, 2): 0}
    for budget in (None, 1):
        found = item_similarity(train, hot_rows=None, needed=item_needed(truth, train, budget))
        assert {(r.item1, r.item2): r.n_corated for r in found.collect()} == want
    assert all(r.sim == 0.0 for r in found.collect())


@pytest.mark.parametrize("hot_member", [None, 20])
def test_similarities_do_not_hang_on_the_dealing(spark, monkeypatch, hot_member):
    t = _train(spark).where("user is not null and item is not null and rating is not null")
    wants = [sorted(map(tuple, f(t, user_stats(t)).collect())) for f in (lambda x, _: item_similarity(x), lambda x, s: user_similarity(x, s), lambda x, _: item_similarity(x, exact_top=3))]
    if hot_member:
        monkeypatch.setattr(skew, "HOT_MEMBER_PAIRS", hot_member)
    gots = [sorted(map(tuple, f(t, user_stats(t)).collect())) for f in (lambda x, _: item_similarity(x, hot_rows=30), lambda x, s: user_similarity(x, s, hot_rows=5), lambda x, _: item_similarity(x, hot_rows=30, exact_top=3))]
    assert gots == wants


def test_no_filter_that_the_driver_cannot_hold():
    """The needed pairs of 1 GB gave a filter of 256 MB, sent through the driver."""
    assert pair_filter.n_blocks(163_000_000) is None
    assert pair_filter.n_blocks(10_000_000) * pair_filter.BLOCK_BITS <= 16 << 23


def test_limbs_as_columns_give_the_same_sums(spark):
    rows = [(i % 7, (i * 37 % 101) / 19997.0 * (-1) ** i, (i * 53 % 97) / 1999.7) for i in range(900)] + [(8, 0.3, 0.7), (9, None, 1.0)]
    df = spark.createDataFrame(rows, "g INT, x DOUBLE, y DOUBLE")
    s = ExactSum(F.col("x") * F.col("y"), "t")
    cut, sums = s.cut(df)
    plain = s.finish(df.groupBy("g").agg(*s.aggregates())).collect()
    assert sorted(map(str, s.finish(cut.groupBy("g").agg(*sums)).collect())) == sorted(map(str, plain))
    m = ExactMoments(F.col("x"), F.col("y"), 3)
    cut, n = ExactMoments.of(df, "x", "y", 3)
    count = F.count("*").alias("n")
    plain = sorted(map(str, m.finish(df.groupBy("g").agg(count, *m.aggregates()), "n").collect()))
    assert sorted(map(str, n.finish(cut.groupBy("g").agg(count, *n.aggregates()), "n").collect())) == plain


@pytest.mark.parametrize("job", [P.item_based, P.user_based])
def test_similarities_are_not_broadcast(spark, job):
    """The planner took their size from the files of the ratings: pairs of 0.1 GB went to the driver."""
    t = _train(spark).where("user is not null and item is not null and rating is not null")
    prep = P.prepare(t, t.where("(user + item) % 5 = 0").select("user", "item"))
    cand, sims = t.select("user", "item", F.col("item").alias("nbr")), P.item_pairs(prep)
    for joined in (attach_similarity(cand, sims, "item", "item1", "item2"), candidate_pair_similarity(cand, sims, "item", "item1", "item2", "n_corated")):
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    plan = job(prep).predictions._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.split("\n") if "Join" in x and "_k2" in x and "SortMergeJoin" not in x] == []
    assert "SortMergeJoin [_k1" in plan


def test_orders_and_held_out_pairs_are_not_broadcast(spark):
    """The planner took their size from compressed files: at 0.1 GB the driver held 311 MB for them."""
    inputs = benchmark_inputs(spark, "/root/testdata/sf0.001")
    t = _train(spark)
    truth = t.where("item % 5 = 0")
    centred = t.withColumn("n_ratings", F.lit(1)).withColumn("sum_rating", F.col("rating"))
    for df in (inputs.events, inputs.test, item_candidates(truth, t, None), item_candidates(truth, t), user_candidates(truth, centred, None)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_only_needed_user_pairs(spark):
    train = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0), (1, 2, 3.0), (2, 2, 5.0), (3, 2, 1.0), (4, 3, 2.0), (5, 4, 1.0), (None, 4, 1.0), (3, 5, 2.5), (1, 5, 4.0)], DDL)
    truth = spark.createDataFrame([(1, 3), (3, 1), (2, 4), (2, 5)], "user BIGINT, item BIGINT")
    want = {(1, 4): 0, (1, 3): 2, (2, 3): 1, (2, 5): 0, (2, 2): 0, (1, 2): 2}
    every = {(r.user1, r.user2): r.sim for r in user_similarity(train, user_stats(train), hot_rows=None).collect()}
    for budget in (None, 1):
        asked = user_needed(truth, train, budget)
        if budget is None:
            assert "BroadcastHashJoin" not in asked._jdf.queryExecution().executedPlan().toString()
        found = user_similarity(train, user_stats(train), hot_rows=None, needed=asked).collect()
        assert {(r.user1, r.user2): r.n_common for r in found} == want
        assert {(r.user1, r.user2): r.sim for r in found} == {p: every.get(p, 0.0) for p in want}


def test_user_job_sends_the_lookup_the_needed_pairs_only(spark, monkeypatch):
    """All co-rating users have a similarity: five times the candidates' pairs were shuffled and sorted."""
    t = _train(spark).where("user is not null and item is not null and rating is not null")
    prep = P.prepare(t, t.where("(user + item) % 5 = 0").select("user", "item"))
    sent = []
    attach = P.attach_similarity
    monkeypatch.setattr(P, "attach_similarity", lambda cand, sims, *a: sent.append((cand, sims)) or attach(cand, sims, *a))
    some, whole = P.user_based(prep, k=3).predictions, P.user_based(prep, k=3, restrict=False).predictions
    (cand, sims), (_, every) = sent
    pairs = cand.select(F.least("user", "nbr"), F.greatest("user", "nbr")).distinct().count()
    assert sims.count() == pairs != every.count()
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))
    n = sims.groupBy("user1").count().agg(F.max("count")).first()[0]
    assert P._most_pairs(prep, needed=True) >= n
