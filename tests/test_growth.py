"""Steps that must not outgrow their input: what they write, shuffle and make."""
import os

from pyspark.sql import functions as F

from corate.operators import ridge
from corate.operators.pair_count import corated_pair_count
from corate.operators.split import dedup_last
from corate.plans import pipelines as P
from corate.plans import queries as Q
from corate.sources.readers import read_ratings_csv
from corate.sources.tables import write_csv_inputs

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_the_csv_files_asked_for_are_written(spark, scratch):
    write_csv_inputs(spark, SF, scratch, ("test",))
    assert os.listdir(scratch) == ["test"]


def test_rating_lines_are_deduplicated_without_a_sort(spark, scratch):
    for name, lines in (("a.csv", "u,i,r,t\n" + "1,1,1.0,0\n" * 300 + "1,1,2.0,0\n3,1,1.5,0\n"), ("b.csv", "1,1,4.5,0\n2,2,3.0,0\n" * 200 + "2,2,0.5,0\n")):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        found = dedup_last(read_ratings_csv(spark, scratch).rows)
        assert "SortAggregate" not in _plan(found)
        assert {(r.user, r.item): r.rating for r in found.collect()} == {(1, 1): 4.5, (2, 2): 0.5, (3, 1): 1.5}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_words_of_a_pair_count_meet_behind_one_exchange_by_item(spark):
    train = spark.createDataFrame([(u, i, 1.0) for u in range(5) for i in range(u, 90)], "user BIGINT, item BIGINT, rating DOUBLE")
    plan = _plan(corated_pair_count(train))
    assert "REPARTITION_BY_NUM" in plan and plan[: plan.index("REPARTITION_BY_NUM")].count("Exchange hashpartitioning") == 1


def test_half_step_is_the_same_dealt_or_combined(spark, monkeypatch):
    items = spark.createDataFrame([(i, [i / 8, 1.0, -i / 4]) for i in range(9)], "item BIGINT, item_factors ARRAY<DOUBLE>")
    ratings = spark.createDataFrame([(u, (u * i) % 10, (u + i) % 9 / 2) for u in range(1, 20) for i in range(4)], "user BIGINT, item BIGINT, rating DOUBLE")
    eq = lambda: ridge.normal_equations(ratings, items, "user", "item", "item_factors", 3)
    dealt = eq()
    assert "REPARTITION_BY_COL" in _plan(dealt)
    monkeypatch.setattr(ridge, "DEALT_RATINGS", 0)
    combined = eq()
    assert "REPARTITION_BY_COL" not in _plan(combined)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, combined.collect()))


def test_imputed_rows_do_not_make_the_output_file(spark, monkeypatch):
    made = []
    real = P.materialize
    monkeypatch.setattr(P, "materialize", lambda df, how="auto", hint="t": made.append(hint) or real(df, how, hint))
    p = Q.prepared(spark, SF)
    m = P.model_based(p, factors=Q.formula_factors(p.train))
    assert m.imputed.where(F.col("source") == "als").count() == 0 and "model-pred" not in made
    assert m.predictions.count() == m.predictions.count() > 0 and made.count("model-pred") == 1
