"""Factor-model invariants (no SQL oracle exists for the factors)."""

import pytest
from pyspark.sql import functions as F

from corate.operators import als as A
from corate.operators.impute import unscorable_by_factors
from corate.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prep(spark):
    return Q.prepared(spark, SF)


def test_scored_pairs_are_pairs_with_both_ids_in_train(spark, prep):
    fm = A.fit_als(prep.train)
    scored = {tuple(r) for r in A.als_predict(fm, prep.test).select("user", "item").collect()}
    cold = {tuple(r) for r in unscorable_by_factors(prep.test, prep.train).select("user", "item").collect()}
    allp = {tuple(r) for r in prep.test.collect()}
    assert scored == allp - cold


def test_prediction_is_factor_dot_product(spark, prep):
    fm = A.fit_als(prep.train)
    pred = A.als_predict(fm, prep.test)
    uf = fm.model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("uf"))
    itf = fm.model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("if_"))
    j = pred.join(uf, "user").join(itf, "item")
    for r in j.limit(50).collect():
        dot = sum(a * b for a, b in zip(r["uf"], r["if_"]))
        assert r["prediction"] == pytest.approx(dot, abs=1e-4)


def test_same_seed_same_result(spark, prep):
    a = {(r[0], r[1]): r[2] for r in A.als_predict(A.fit_als(prep.train, seed=7), prep.test).collect()}
    b = {(r[0], r[1]): r[2] for r in A.als_predict(A.fit_als(prep.train, seed=7), prep.test).collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_dense_index_is_dense_and_unique(spark):
    ids = spark.range(0, 5000).select((F.col("id") * 1_000_003 + 3_000_000_000).alias("user"))
    ix = A.dense_index(ids, "user", buckets=16)
    got = sorted(r["user_ix"] for r in ix.collect())
    assert got == list(range(5000))
    assert ix.select("user").distinct().count() == 5000


def test_wide_ids_are_reindexed(spark):
    big = 5_000_000_000
    rows = [(big + u, big + i, float((u * i) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")
    fm = A.fit_als(train, seed=1)
    assert fm.user_index is not None and fm.item_index is not None
    pairs = spark.createDataFrame([(big + 1, big + 2), (big + 999, big + 2)], "user BIGINT, item BIGINT")
    out = A.als_predict(fm, pairs).collect()
    assert [(r["user"], r["item"]) for r in out] == [(big + 1, big + 2)]


def test_beats_global_mean_on_low_rank_data(spark):
    import random

    rnd = random.Random(3)
    u_f = [[rnd.uniform(0.5, 1.5) for _ in range(2)] for _ in range(60)]
    i_f = [[rnd.uniform(0.5, 1.5) for _ in range(2)] for _ in range(40)]
    rows = [(u, i, sum(a * b for a, b in zip(u_f[u], i_f[i])))
            for u in range(60) for i in range(40) if rnd.random() < 0.5]
    df = spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")
    train, hold = df.filter((F.col("user") + F.col("item")) % 7 != 0), df.filter((F.col("user") + F.col("item")) % 7 == 0)
    fm = A.fit_als(train, rank=2, max_iter=15, reg_param=0.01, seed=1)
    p = A.als_predict(fm, hold.select("user", "item")).join(hold, ["user", "item"])
    rmse = p.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]
    g = train.agg(F.avg("rating")).first()[0]
    base = hold.agg(F.sqrt(F.avg((F.col("rating") - F.lit(g)) ** 2))).first()[0]
    assert rmse < 0.5 * base
