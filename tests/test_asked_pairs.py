"""Similarities made in passes, against the one plan; what stays on disk."""
import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from corate.operators import asked_pairs, skew
from corate.operators.asked_pairs import later_lists, member_lists
from corate.operators.similarity import item_similarity
from corate.operators.skew import later_members
from corate.plans import pipelines as P
from corate.plans import queries
from corate.session import write_table

DDL = "user BIGINT, item BIGINT, rating DOUBLE"
COLS = ["user", "item", "rating", "prediction", "source", "n_neighbors"]


def _ratings(spark, offgrid=False):
    deal = random.Random(5)
    rows = [(u, i, float(deal.randint(1, 10)) / (19.97 if offgrid else 2)) for u in range(60) for i in deal.sample(range(50), 14)]
    rows += [(90, i, 1.0 + i % 4) for i in range(50)]
    rows += [(91, 3, None), (91, 7, 2.0), (91, None, 4.0), (91, 20, 3.0), (92, 20, None), (None, 3, 2.0), (91, 9, 1.0), (93, -4, 2.0), (90, -4, 3.0)]
    return spark.createDataFrame(rows, DDL)


def _prep(spark, offgrid=False):
    t = _ratings(spark, offgrid)
    genres = t.where("item is not null").select("item").distinct().withColumn("genre", F.concat(F.lit("g"), (F.col("item") % 3).cast("string")))
    return P.prepare(t, t.where("(user * 7 + item * 3) % 5 = 0 or user = 91 and item = 9 or item = 17").select("user", "item"), genres)


@pytest.fixture
def passes(monkeypatch):
    """Turns the passes on, with several of them, small chunks and short pieces."""
    def on(**more):
        monkeypatch.setattr(P, "PASSES_FROM", 0)
        for name, value in ({"PASS_PAIRS": 7000, "CHUNK": 64, "HOT_ASKED_PAIRS": 128, "PIECE": 4} | more).items():
            monkeypatch.setattr(asked_pairs, name, value)
    return on


def _rows(df):
    return sorted(map(str, df.collect()))


JOBS = {
    "pearson": lambda p, hot: P.item_based(p, hot_rows=hot),
    "sum_normalized": lambda p, hot: P.item_based(p, metric="sum_normalized", hot_rows=hot),
    "genre": lambda p, hot: P.item_based(p, k=3, fallback="genre", hot_rows=hot),
    "users": lambda p, hot: P.user_based(p, k=1, hot_rows=hot),
    "more users": lambda p, hot: P.user_based(p, k=4, loo="corrected", hot_rows=hot),
}


@pytest.mark.parametrize("job, hot", [*((j, skew.DEFAULT_HOT_ROWS) for j in JOBS), ("pearson", 20), ("users", 20)])
def test_passes_give_the_rows_of_one_plan(spark, passes, job, hot):
    prep = _prep(spark)
    P.centred_layout(prep)
    want = _rows(JOBS[job](prep, hot).predictions.select(COLS))
    passes()
    assert P.takes_passes(prep, "item" if "users" in job else "user")
    got = JOBS[job](prep, hot)
    assert "lists" not in "".join(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))
    assert _rows(got.predictions.select(COLS)) == want
    assert any(isinstance(t, str) for t in prep.tables)


@pytest.mark.parametrize("k", [None, 5])
def test_passes_off_the_grid(spark, passes, k):
    prep = _prep(spark, offgrid=True)
    assert prep.exact_top is not None
    want, pairs = _rows(P.item_based(prep, k=k).predictions.select(COLS)), _rows(P.item_pairs(prep))
    passes()
    assert _rows(P.item_based(prep, k=k).predictions.select(COLS)) == want
    assert _rows(P.item_pairs(prep, hot_rows=20)) == pairs
    assert any(isinstance(t, str) and "pairs" in t for t in prep.tables)


def test_top_items_in_passes(spark, passes, monkeypatch):
    prep = _prep(spark)
    monkeypatch.setattr(queries, "prepared", lambda *a: prep)
    want = _rows(queries.q_topk_items(spark, ""))
    passes()
    got = queries.q_topk_items(spark, "")
    assert _rows(got) == want
    # candidates and similarities are not joined by pair any more
    assert "_k1" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_lists_of_all_passes_are_the_lists_of_one(spark):
    t = _ratings(spark).dropDuplicates(["user", "item"])
    for hot in (None, 20):
        lists = member_lists(t, "user", "item", ["rating"], hot)
        dealt = [later_lists(lists, i, 3).select("m1", F.posexplode("m2s").alias("at", "m2"), "rating1", F.get("rating2s", F.col("at")).alias("y")) for i in range(3)]
        got = dealt[0].unionByName(dealt[1]).unionByName(dealt[2]).drop("at")
        one = later_members(t, "user", "item", "rating", None).select("m1", F.posexplode("m2s").alias("at", "m2"), "v1", F.get("v2s", F.col("at")).alias("y")).drop("at")
        assert _rows(got.toDF("m1", "m2", "x", "y")) == _rows(one.select("m1", "m2", F.col("v1").alias("x"), "y"))
        assert lists.pairs == one.count()
        firsts = [{r[0] for r in d.select("m1").distinct().collect()} for d in dealt]
        assert not firsts[0] & firsts[1] and not firsts[1] & firsts[2]


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def test_a_written_table_leaves_no_shuffle_on_disk(spark):
    """Shuffle files stayed until the driver collected the plan: at 6 GB the disk held all those of a job."""
    before = _shuffle_files(spark)
    kept = spark.range(10_000).withColumn("k", F.col("id") % 97).repartition(4, "k").groupBy("k").count()
    assert kept.count() == 97
    assert _shuffle_files(spark) - before
    before = _shuffle_files(spark)
    t = write_table(spark.range(10_000).withColumn("k", F.col("id") % 89).repartition(4, "k"), "freed")
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert t.groupBy("k").count().count() == 89
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_scores_are_those_of_the_columns(spark):
    import numpy as np

    t = _ratings(spark).where("user is not null and item is not null").dropDuplicates(["user", "item"])
    for metric, score in (("pearson", asked_pairs.pearson_score(2.0)), ("sum_normalized", asked_pairs.sum_normalized_score())):
        sims = {(r.item1, r.item2): r.sim for r in item_similarity(t, metric, None, shift=F.lit(2.0)).collect()}
        ratings = {(r.user, r.item): r.rating for r in t.collect()}
        users = sorted({u for u, _ in ratings})
        for (a, b), sim in list(sims.items())[:200]:
            both = [(ratings[u, a], ratings[u, b]) for u in users if (u, a) in ratings and (u, b) in ratings]
            x, y = (np.array([np.nan if p[i] is None else p[i] for p in both]) for i in (0, 1))
            got = score(x, y, ~np.isnan(x), ~np.isnan(y), np.array([0]), np.array([len(both)]))[0]
            assert got == sim
