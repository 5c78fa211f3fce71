"""Edge cases: cold user / item, duplicates, unanswered pairs, empty test set,
single co-rater, constant ratings, ties at rank k, NaN errors, clamping."""

import math

import pytest
from pyspark.sql import functions as F

from corate.operators.evaluate import evaluate
from corate.operators.neighbors import top_k
from corate.operators.similarity import item_similarity
from corate.operators.split import dedup_last
from corate.plans import pipelines as P


def _prep(spark, ratings, test, genres=None):
    r = spark.createDataFrame(ratings, "user BIGINT, item BIGINT, rating DOUBLE")
    t = spark.createDataFrame(test, "user BIGINT, item BIGINT")
    g = spark.createDataFrame(genres, "item BIGINT, genre STRING") if genres else None
    return P.prepare(r, t, g, order_col=None, materialize_how="none")


def test_duplicate_last_wins(spark):
    ev = spark.createDataFrame(
        [(1, 1, 2.0, 1), (1, 1, 5.0, 3), (1, 1, 4.0, 2), (2, 1, 1.0, 1)],
        "user BIGINT, item BIGINT, rating DOUBLE, seq BIGINT",
    )
    got = {(r["user"], r["item"]): r["rating"] for r in dedup_last(ev, "seq").collect()}
    assert got == {(1, 1): 5.0, (2, 1): 1.0}


def test_cold_user_gets_global_mean(spark):
    p = _prep(spark, [(1, 1, 4.0), (1, 2, 2.0), (9, 1, 5.0)], [(9, 1)])
    r = P.item_based(p).predictions.first()
    assert r["source"] == "global_mean" and r["prediction"] == pytest.approx(3.0)
    u = P.user_based(p).predictions.first()
    assert u["source"] == "global_mean" and u["prediction"] == pytest.approx(3.0)


def test_cold_item_falls_back_to_user_mean(spark):
    p = _prep(spark, [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 3.0), (1, 7, 5.0)], [(1, 7)])
    r = P.item_based(p).predictions.first()
    assert r["source"] == "user_mean" and r["prediction"] == pytest.approx(3.0)
    u = P.user_based(p).predictions.first()
    assert u["source"] == "user_mean" and u["prediction"] == pytest.approx(3.0)


def test_unanswered_pair_not_scored(spark):
    p = _prep(spark, [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 3.0)], [(1, 2), (5, 5)])
    assert p.truth.count() == 1
    assert P.item_based(p).predictions.count() == 1


def test_empty_test_set(spark):
    p = _prep(spark, [(1, 1, 4.0), (1, 2, 2.0)], [])
    m = P.item_based(p).metrics.first()
    assert m["n_scored"] == 0 and m["rmse"] is None and m["band_0_1"] == 0


def test_single_corater_and_constant_ratings_give_zero(spark):
    tr = spark.createDataFrame(
        [(1, 1, 3.0), (1, 2, 4.0), (2, 3, 2.0), (2, 4, 2.0), (3, 3, 2.0), (3, 4, 5.0)],
        "user BIGINT, item BIGINT, rating DOUBLE",
    )
    s = {(r["item1"], r["item2"]): r["sim"] for r in item_similarity(tr).collect()}
    assert s[(1, 2)] == 0.0   # one co-rater: deviations are 0
    assert s[(3, 4)] == 0.0   # item 3 constant over its co-raters


def test_ties_at_rank_k_break_by_neighbour_id(spark):
    sc = spark.createDataFrame(
        [(1, 9, 5, 0.0), (1, 9, 3, 0.0), (1, 9, 4, 0.0), (1, 9, 8, -0.5), (1, 9, 2, 0.7)],
        "user BIGINT, item BIGINT, nbr BIGINT, sim DOUBLE",
    )
    got = [r["nbr"] for r in top_k(sc, 3).orderBy("nbr_rank").collect()]
    assert got == [2, 3, 4]


def test_nan_error_in_no_band(spark):
    df = spark.createDataFrame(
        [(1, 1, 3.0, float("nan")), (1, 2, 3.0, 3.5), (1, 3, 1.0, 5.0)],
        "user BIGINT, item BIGINT, rating DOUBLE, prediction DOUBLE",
    )
    m = evaluate(df).first()
    assert [m["band_0_1"], m["band_1_2"], m["band_2_3"], m["band_3_4"], m["band_4_up"]] == [1, 0, 0, 0, 1]
    assert math.isnan(m["rmse"])


def test_band_edges_half_open(spark):
    df = spark.createDataFrame(
        [(1, i, 0.0, float(e)) for i, e in enumerate([0, 1, 2, 3, 4, 0.999, 3.999])],
        "user BIGINT, item BIGINT, rating DOUBLE, prediction DOUBLE",
    )
    m = evaluate(df).first()
    assert [m["band_0_1"], m["band_1_2"], m["band_2_3"], m["band_3_4"], m["band_4_up"]] == [2, 1, 1, 2, 1]


def test_clamp_option(spark):
    from tests import micro

    p = micro.prepared(spark)
    r = P.item_based(p, k=10, clamp=(0.5, 5.0)).predictions.first()
    assert r["prediction"] == 0.5


def test_model_based_impute_unanswered(spark):
    from tests import micro

    p = micro.prepared(spark)
    mr = P.model_based(p, impute_unanswered=True)
    got = {(r["user"], r["item"]): r["source"] for r in mr.predictions.collect()}
    assert got[(3, 40)] == "genre_mean" and got[(3, 50)] == "user_mean"
    assert got[(3, 30)] == "als"
    mr2 = P.model_based(p)
    assert {(r["user"], r["item"]) for r in mr2.predictions.collect()} == {(3, 30)}


def test_both_cold_and_reasons(spark):
    from corate.operators.impute import impute, unscorable_by_factors

    p = _prep(spark, [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 3.0), (8, 8, 5.0), (8, 1, 1.0), (1, 9, 2.0)],
              [(8, 8), (8, 1), (1, 9)], [(1, "A"), (2, "B"), (8, "A"), (9, "B")])
    reasons = {(r["user"], r["item"]): r["reason"] for r in unscorable_by_factors(p.truth, p.train).collect()}
    assert reasons == {(8, 8): "cold_both", (8, 1): "cold_user", (1, 9): "cold_item"}
    ib = {(r["user"], r["item"]): r["source"] for r in P.item_based(p).predictions.collect()}
    assert ib[(8, 8)] == "global_mean" and ib[(1, 9)] == "user_mean"
    cases = unscorable_by_factors(p.truth, p.train).drop("reason")
    imp = {(r["user"], r["item"]): (r["source"], r["prediction"])
           for r in impute(cases, p.train, p.genres, p.gmean).collect()}
    assert imp[(8, 8)][0] == "global_mean" and imp[(8, 8)][1] == pytest.approx(3.0)
    assert imp[(1, 9)] == ("genre_mean", 2.0)   # user 1's only 'B' item is item 2


def test_repeated_test_pairs_and_genres_change_nothing(spark):
    from corate.plans import pipelines as P
    from tests import micro

    r, g, t = micro.frames(spark)
    once = P.item_based(P.prepare(r, t, g, order_col=None)).metrics.first()
    twice = P.item_based(P.prepare(r, t.union(t), g.union(g), order_col=None)).metrics.first()
    assert once == twice


def test_pearson_off_the_half_star_grid(spark):
    """Constant series and non-grid ratings against the centred formula."""
    from corate.operators.similarity import item_similarity

    series = {1: [3.3, 3.3, 3.3], 2: [2.1, 3.7, 4.9], 3: [0.1, 0.2, 0.4], 4: [2.2, 2.2, 2.2]}
    rows = [(u, i, v) for i, vs in series.items() for u, v in enumerate(vs)]
    got = {(x["item1"], x["item2"]): x["sim"] for x in item_similarity(spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE")).collect()}
    for (a, b), sim in got.items():
        if {a, b} & {1, 4}:
            assert sim == 0
        else:
            x, y = ([v - sum(s) / 3 for v in s] for s in (series[a], series[b]))
            want = sum(p * q for p, q in zip(x, y)) / (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5
            assert abs(sim - want) < 1e-9


def test_als_blocks_follow_the_rows_only(spark):
    from corate.operators.als import als_blocks

    assert [als_blocks(n) for n in (0, 10**6, 10**7, 10**9, 10**12)] == [10, 10, 10, 100, 3162]
