"""Hand-worked values (FIXTURES.md section 3), tolerance 1e-9."""

import math

import pytest
from pyspark.sql import functions as F

from corate.operators.impute import impute
from corate.operators.similarity import item_similarity, user_similarity
from corate.plans import pipelines as P
from tests import micro

TOL = 1e-9


@pytest.fixture(scope="module")
def prep(spark):
    return micro.prepared(spark)


def _pairs(df, a, b):
    return {(r[a], r[b]): r["sim"] for r in df.collect()}


def test_split(prep):
    assert {tuple(r) for r in prep.truth.select("user", "item", "rating").collect()} == {(3, 30, 3.0)}
    assert prep.train.count() == 10
    assert prep.test.count() == 3


def test_user_means(prep):
    got = {r["user"]: r["mean_rating"] for r in prep.ustats.collect()}
    assert got == pytest.approx({1: 4.0, 2: 4.0, 3: 3.0, 4: 3.25}, abs=TOL)


def test_item_pearson(prep):
    s = _pairs(item_similarity(prep.train, "pearson"), "item1", "item2")
    assert s[(10, 30)] == pytest.approx(-1.0, abs=TOL)
    assert s[(20, 30)] == 0.0  # numerator is exactly 0


def test_item_sum_normalized(prep):
    s = _pairs(item_similarity(prep.train, "sum_normalized"), "item1", "item2")
    assert s[(10, 30)] == pytest.approx(40 / 81, abs=TOL)
    assert s[(20, 30)] == pytest.approx(36 / 108, abs=TOL)


def test_item_based_k10_negative_unclamped(prep):
    r = P.item_based(prep, k=10).predictions.collect()
    assert len(r) == 1
    assert r[0]["prediction"] == pytest.approx(-2.0, abs=TOL)
    assert r[0]["source"] == "neighbors"
    m = P.item_based(prep, k=10).metrics.first()
    assert m["band_4_up"] == 1 and m["n_scored"] == 1
    assert m["rmse"] == pytest.approx(5.0, abs=TOL)


def test_item_based_k1_zero_weight_falls_back(prep):
    r = P.item_based(prep, k=1).predictions.first()
    assert r["prediction"] == pytest.approx(3.0, abs=TOL)
    assert r["source"] == "user_mean"


def test_user_pearson(prep):
    s = _pairs(user_similarity(prep.train, prep.ustats), "user1", "user2")
    assert s[(1, 3)] == pytest.approx(-1 / math.sqrt(2), abs=1e-8)
    assert s[(2, 3)] == pytest.approx(-1.0, abs=TOL)
    assert s[(3, 4)] == pytest.approx(-1.0, abs=TOL)


def test_user_based_literal(prep):
    r = P.user_based(prep, k=1, loo="literal").predictions.first()
    assert r["prediction"] == pytest.approx(-2 / 3, abs=1e-8)


def test_user_based_corrected(prep):
    r = P.user_based(prep, k=1, loo="corrected").predictions.first()
    assert r["prediction"] == pytest.approx(1.5, abs=TOL)


def test_genre_imputation(spark, prep):
    cases = spark.createDataFrame([(3, 40), (3, 50)], "user BIGINT, item BIGINT")
    got = {r["item"]: (r["prediction"], r["source"])
           for r in impute(cases, prep.train, prep.genres, F.lit(None).cast("double")).collect()}
    assert got[40][0] == pytest.approx(2.0, abs=TOL) and got[40][1] == "genre_mean"
    assert got[50][0] == pytest.approx(3.0, abs=TOL) and got[50][1] == "user_mean"


def test_item_mean_imputation(spark, prep):
    cases = spark.createDataFrame([(3, 30), (3, 40)], "user BIGINT, item BIGINT")
    got = {r["item"]: (r["prediction"], r["source"])
           for r in impute(cases, prep.train, None, F.lit(None).cast("double"), "item_mean").collect()}
    assert got[30][0] == pytest.approx((5.0 + 4.0 + 4.5) / 3, abs=TOL) and got[30][1] == "item_mean"
    assert got[40][0] == pytest.approx(3.0, abs=TOL) and got[40][1] == "user_mean"


def test_item_based_genre_fallback(prep):
    # k=1: neighbour weight 0 -> genre fallback; user 3 has no 'Comedy|Drama'
    # training item, so it falls through to the user mean
    r = P.item_based(prep, k=1, fallback="genre").predictions.first()
    assert r["source"] == "user_mean" and r["prediction"] == pytest.approx(3.0, abs=TOL)
