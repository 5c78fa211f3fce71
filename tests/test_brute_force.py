"""Property tests: the Spark jobs against a brute-force implementation of the
same semantics (tests/brute.py) on random small rating sets."""

from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corate.plans import pipelines as P
from tests import brute

HALF_STARS = [x / 2 for x in range(1, 11)]
# name -> ratings as exact fractions: finer grids, far from zero
OFF_GRID = {
    "tenths": [Fraction(x, 10) for x in range(1, 51)],
    "hundredths": [Fraction(x, 100) for x in range(1, 501)],
    "few": [Fraction(x, 10) for x in (22, 33, 49)],
    "far": [100_000_000 + Fraction(x, 2) for x in range(1, 11)],
}


@st.composite
def rating_sets(draw, values=None):
    values = draw(st.sampled_from(list(OFF_GRID.values()))) if values is None else values
    n_users = draw(st.integers(2, 7))
    n_items = draw(st.integers(2, 7))
    cells = draw(st.sets(st.tuples(st.integers(0, n_users - 1), st.integers(0, n_items - 1)),
                         min_size=3, max_size=n_users * n_items))
    ratings = [(u, i, draw(st.sampled_from(values))) for u, i in sorted(cells)]
    test = draw(st.sets(st.sampled_from(sorted(cells)), min_size=1, max_size=max(1, len(cells) // 3)))
    return ratings, sorted(test)


def _split(ratings, test):
    t = set(test)
    return [r for r in ratings if (r[0], r[1]) not in t], [r for r in ratings if (r[0], r[1]) in t]


def _prep(spark, ratings, test):
    ratings = [(u, i, float(r)) for u, i, r in ratings]
    r = spark.createDataFrame(ratings, "user BIGINT, item BIGINT, rating DOUBLE")
    t = spark.createDataFrame(test, "user BIGINT, item BIGINT")
    return P.prepare(r, t, None, order_col=None, materialize_how="none")


def _same(got, want, rel=1e-9):
    assert got.keys() == want.keys()
    for key in want:
        gp, gs = got[key]
        wp, ws = want[key]
        assert gs == ws, (key, got[key], want[key])
        assert gp == pytest.approx(wp, rel=rel, abs=1e-9), (key, got[key], want[key])


SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(data=rating_sets(HALF_STARS), k=st.sampled_from([1, 2, 10]), metric=st.sampled_from(["pearson", "sum_normalized"]))
def test_item_based_matches_brute_force(spark, data, k, metric):
    ratings, test = data
    train, truth = _split(ratings, test)
    prep = _prep(spark, ratings, test)
    got = {(r["user"], r["item"]): (r["prediction"], r["source"])
           for r in P.item_based(prep, k=k, metric=metric).predictions.collect()}
    _same(got, brute.item_based(train, truth, k, metric))


@SETTINGS
@given(data=rating_sets(HALF_STARS), k=st.sampled_from([1, 3]), loo=st.sampled_from(["literal", "corrected"]))
def test_user_based_matches_brute_force(spark, data, k, loo):
    ratings, test = data
    train, truth = _split(ratings, test)
    prep = _prep(spark, ratings, test)
    got = {(r["user"], r["item"]): (r["prediction"], r["source"])
           for r in P.user_based(prep, k=k, loo=loo).predictions.collect()}
    _same(got, brute.user_based(train, truth, k, loo))


# off the grid, equal similarities may differ by rounding, so all neighbours count

@SETTINGS
@given(data=rating_sets())
def test_item_based_off_the_grid(spark, data):
    ratings, test = data
    train, truth = _split(ratings, test)
    prep = _prep(spark, ratings, test)
    got = {(r["user"], r["item"]): (r["prediction"], r["source"])
           for r in P.item_based(prep, k=100).predictions.collect()}
    _same(got, brute.item_based(train, truth, 100), rel=1e-7)


@SETTINGS
@given(data=rating_sets())
def test_user_based_off_the_grid(spark, data):
    ratings, test = data
    train, truth = _split(ratings, test)
    prep = _prep(spark, ratings, test)
    got = {(r["user"], r["item"]): (r["prediction"], r["source"])
           for r in P.user_based(prep, k=100, loo="corrected").predictions.collect()}
    _same(got, brute.user_based(train, truth, 100, "corrected"), rel=1e-7)


def test_constant_off_grid_series_has_no_correlation(spark):
    rows = [(u, 1, 3.3) for u in (1, 2, 3)] + [(1, 2, 2.1), (2, 2, 3.7), (3, 2, 4.9), (9, 1, 1.0), (9, 3, 5.0), (9, 2, 4.0)]
    prep = _prep(spark, rows, [(9, 2)])
    sims = {(r["item1"], r["item2"]): r["sim"] for r in P.item_pairs(prep).collect()}
    assert sims[1, 2] == 0
    (r,) = P.item_based(prep).predictions.collect()
    assert (r["prediction"], r["source"]) == (3.0, "user_mean")
