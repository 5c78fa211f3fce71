"""Layouts outlive executors and sessions: they are bucketed files in the
shared checkpoint folder, and nothing is cached."""

from corate.plans import pipelines as P
from corate.session import open_layout
from corate.sources.tables import benchmark_inputs

SF = "/root/testdata/sf0.001"


def _preds(prep):
    return sorted((r["user"], r["item"], r["prediction"], r["source"])
                  for r in P.item_based(prep).predictions.collect())


def _prepare(spark, **how):
    inp = benchmark_inputs(spark, SF)
    return P.prepare(inp.events, inp.test, inp.genres, **how)


def test_layout_is_read_from_files_without_an_exchange(spark):
    prep = _prepare(spark)
    assert prep.by_user and [t.key for t in prep.tables] == ["user", "user"]
    assert not prep.train.is_cached and not prep.truth.is_cached
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = prep.train.selectExpr("user", "item AS nbr")
        plans = [prep.train.alias("a").join(prep.train.alias("b"), "user"), prep.truth.join(r, "user"), prep.train.groupBy("user").count()]
        for df in plans:
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_another_session_opens_the_layout(spark):
    prep = _prepare(spark)
    before = sorted(map(tuple, prep.train.collect()))
    other = spark.newSession()
    spark.sql(f"DROP TABLE {prep.train._jdf.queryExecution().analyzed().collectLeaves().apply(0).catalogTable().get().identifier().table()}")
    again = open_layout(other, prep.tables[0])
    assert sorted(map(tuple, again.collect())) == before
    assert "Exchange" not in again.groupBy("user").count()._jdf.queryExecution().executedPlan().toString()


def test_closing_deletes_the_files(spark):
    prep = _prepare(spark)
    jvm, paths = spark._jvm, [t.path for t in prep.tables]
    there = lambda p: (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(q)
    assert all(map(there, paths))
    prep.close()
    assert not any(map(there, paths)) and not prep.tables


def test_dropping_cached_layouts_keeps_results(spark):
    """Without a shared folder the layouts are cached; lost blocks are rebuilt from the lineage."""
    prep = _prepare(spark, materialize_how="persist")
    assert prep.by_user and prep.train.is_cached
    before = _preds(prep)
    prep.train.unpersist(blocking=True)
    prep.truth.unpersist(blocking=True)
    assert _preds(prep) == before == _preds(_prepare(spark))
