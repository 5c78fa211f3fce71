"""Sums that do not depend on the order of the rows, against rational arithmetic."""
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corate.functions.exact import ExactMoments, ExactSum, top_bit
from corate.operators import similarity
from corate.operators.exact_pairs import exact_pearson


def _frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def _sum(df, **how):
    s = ExactSum(F.col("x"), "total", **how)
    return s.finish(df.groupBy("g").agg(*s.aggregates())).collect()


def test_sum_is_the_rounded_exact_sum(spark):
    r = random.Random(1)
    rows = [(g, r.choice([-1, 1]) * r.random() * 10.0 ** r.randrange(-12, 10)) for g in range(40) for _ in range(200)]
    got = {x.g: x.total for x in _sum(_frame(spark, rows, "g INT, x DOUBLE"))}
    for g in range(40):
        want = float(sum(Fraction(x) for k, x in rows if k == g))
        assert abs(got[g] - want) <= 2 * math.ulp(want)


def test_sum_under_cancellation(spark):
    rows = [(0, 1e10), (0, 1e-15), (0, -1e10), (1, -1e10), (1, -3e-17), (1, 1e10), (2, 0.0), (2, -0.0), (3, None), (4, float("nan")), (4, 2.0)]
    got = {x.g: x.total for x in _sum(_frame(spark, rows, "g INT, x DOUBLE"))}
    assert abs(got[0] / 1e-15 - 1) < 1e-12 and abs(got[1] / -3e-17 - 1) < 1e-12
    assert got[2] == 0.0 and got[3] is None and got[4] == 2.0


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_same_bits_whatever_the_partitions(spark, parts):
    r = random.Random(2)
    rows = [(i % 5, r.random() * 5, r.random() * 5, r.random()) for i in range(4000)]
    df = _frame(spark, rows, "g INT, x DOUBLE, y DOUBLE, o DOUBLE")

    def bits(d):
        s, m = ExactSum(F.col("x"), "total"), ExactMoments(F.col("x"), F.col("y"), 3)
        a = d.groupBy("g").agg(F.count("*").alias("n"), *s.aggregates(), *m.aggregates())
        return {t.g: (t.total.hex(), t.sim.hex()) for t in m.finish(s.finish(a), "n").collect()}

    assert bits(df) == bits(df.orderBy("o").repartition(parts))


def _pearson(xs, ys):
    xs, ys, n = [Fraction(x) for x in xs], [Fraction(y) for y in ys], len(xs)
    num = n * sum(x * y for x, y in zip(xs, ys)) - sum(xs) * sum(ys)
    vx, vy = n * sum(x * x for x in xs) - sum(xs) ** 2, n * sum(y * y for y in ys) - sum(ys) ** 2
    if not num or not vx or not vy:
        return 0.0
    square = num * num / (vx * vy)
    root = Fraction(math.isqrt(square.numerator * square.denominator * 10**60), square.denominator * 10**30)
    return float(root if num > 0 else -root)


def test_pearson_equals_rational_arithmetic(spark):
    """Also for nearly constant series, where moments of doubles have no digit left."""
    r = random.Random(3)
    groups = []
    for g in range(60):
        n = r.choice([1, 2, 3, 10, 300])
        spread = 10.0 ** -r.randrange(0, 13)
        x = [2.5 + spread * r.random() for _ in range(n)]
        groups.append((x, r.choice([[3.0 + spread * r.random() for _ in x], [1.5] * n, x, [5 - v for v in x], [-v for v in x]])))
    rows = [(g, a, b) for g, (x, y) in enumerate(groups) for a, b in zip(x, y)]
    df = _frame(spark, rows, "g INT, x DOUBLE, y DOUBLE")
    m = ExactMoments(F.col("x"), F.col("y"), top_bit(5.0))
    got = {t.g: t.sim for t in m.finish(df.groupBy("g").agg(F.count("*").alias("n"), *m.aggregates()), "n").collect()}
    for g, (x, y) in enumerate(groups):
        assert abs(got[g] - _pearson(x, y)) <= 4e-15


def test_top_bit():
    assert [top_bit(v) for v in (None, 0.0, 0.5, 1.0, 5.25, -8.0)] == [0, 0, 0, 1, 3, 4]


def _pair_ratings(spark, n=1200):
    r = random.Random(5)
    rows = {(r.randrange(60), int(r.paretovariate(0.6)) % 50): r.choice([None, r.gauss(0, 37), r.gauss(0, 37)]) for _ in range(n)}
    return _frame(spark, [(u, i, x) for (u, i), x in (rows | {(u, 999): 7.25 for u in range(40)}).items()], "user BIGINT, item BIGINT, rating DOUBLE")


def test_pairs_summed_in_chunks_are_those_of_the_group(spark):
    train = _pair_ratings(spark)
    p, key = similarity._pair_rows(train, "user", "item", "rating", None, None, None, True, None, similarity.Pairs())
    cut, sums = ExactMoments.of(p, "v_1", "v_2", 8)
    want = sorted(map(tuple, sums.finish(similarity._pair_sums(cut, key, sums.aggregates()), "n_corated").select("item1", "item2", "n_corated", "sim").collect()))
    assert sum(x[3] != 0 for x in want) > 100 and any(x[2] > 1 and x[3] == 0 for x in want)
    for chunk, hot_rows in ((1 << 18, None), (3, 10), (300, None)):
        lists = similarity.later_members(train, "user", "item", "rating", hot_rows, None)
        rows = similarity.dealt_pairs(lists, in_order=True)[0].repartition(1).sortWithinPartitions("m1") if chunk == 3 else similarity.dealt_pairs(lists, in_order=True)[0]
        assert sorted(map(tuple, exact_pearson(rows, 8, chunk).collect())) == want
    assert sorted(map(tuple, similarity.item_similarity(train, exact_top=8).collect())) == want


def test_no_group_holds_the_sums_of_every_pair(spark):
    plan = similarity.item_similarity(_pair_ratings(spark, 100), exact_top=8, no_hot=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "sum(" not in plan
