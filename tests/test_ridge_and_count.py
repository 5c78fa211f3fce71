"""Ridge half-steps and the bitmap pair count against plain computations."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corate.operators.als import score_pairs
from corate.operators.pair_count import corated_pair_count
from corate.operators.ridge import fold_in, residuals


def _data(spark, seed=1, rank=4):
    r = np.random.default_rng(seed)
    items = [(i, r.normal(size=rank).tolist()) for i in range(30)]
    rows = [(u, int(i), float(r.integers(1, 11)) / 2) for u in range(25) for i in r.choice(34, 1 + u % 9, replace=False)]
    return (spark.createDataFrame(items, "item BIGINT, item_factors ARRAY<DOUBLE>"),
            spark.createDataFrame(rows, "user BIGINT, item BIGINT, rating DOUBLE"), dict(items), rows)


@pytest.mark.parametrize("reg", [0.01, 2.0])
def test_fold_in_solves_each_users_equations(spark, reg):
    items, ratings, y, rows = _data(spark)
    got = {r.user: np.array(r.user_factors) for r in fold_in(ratings, items, "user", "item", 4, reg).collect()}
    for u in {r[0] for r in rows}:
        own = [(y[i], v) for w, i, v in rows if w == u and i in y]
        if not own:
            assert u not in got
            continue
        m, v = np.array([f for f, _ in own]), np.array([v for _, v in own])
        want = np.linalg.solve(m.T @ m + reg * len(own) * np.eye(4), m.T @ v)
        assert np.allclose(got[u], want, rtol=1e-9, atol=1e-10)
    solved = fold_in(ratings, items, "user", "item", 4, reg)
    assert residuals(ratings, solved, items, "user", "item", 4, reg).agg(F.max("residual")).first()[0] < 1e-10
    wrong = solved.withColumn("user_factors", F.transform("user_factors", lambda x: x + 0.1))
    assert residuals(ratings, wrong, items, "user", "item", 4, reg).agg(F.min("residual")).first()[0] > 1e-4


def test_folded_in_users_are_scored(spark):
    items, ratings, y, rows = _data(spark)
    users = fold_in(ratings, items, "user", "item", 4)
    x = {r.user: np.array(r.user_factors) for r in users.collect()}
    got = {(r.user, r.item): r.prediction for r in score_pairs(users, items, ratings).collect()}
    assert set(got) == {(u, i) for u, i, _ in rows if u in x and i in y}
    assert all(abs(p - x[u] @ np.array(y[i])) < 1e-9 for (u, i), p in got.items())


def test_fold_in_of_nothing_and_without_regularisation(spark):
    items, ratings, *_ = _data(spark)
    assert fold_in(ratings.where("false"), items, "user", "item", 4).collect() == []
    assert fold_in(ratings, items.where("false"), "user", "item", 4).collect() == []
    with pytest.raises(ValueError):
        fold_in(ratings, items, "user", "item", 4, 0.0)


@pytest.mark.parametrize("budget", [10**9, 50])
def test_pair_count_equals_the_pairs(spark, budget):
    r = random.Random(4)
    rows = {(u, r.randrange(-5, 300) * (1 + u % 3)) for u in range(60) for _ in range(r.choice([1, 3, 20]))}
    rows |= {(99, i) for i in range(200)}  # a user of several full words
    by_user = [[i for w, i in rows if w == u] for u in {u for u, _ in rows}]
    pairs = {(i, j) for own in by_user for i in own for j in own if i < j}
    train = spark.createDataFrame([(u, i, 1.0) for u, i in rows], "user BIGINT, item BIGINT, rating DOUBLE")
    assert corated_pair_count(train, budget).first().n_pairs == len(pairs)


def test_pair_count_of_nothing(spark):
    assert corated_pair_count(spark.createDataFrame([], "user BIGINT, item BIGINT, rating DOUBLE")).first().n_pairs == 0
