"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from corate.plans import queries
from tools.check_oracle import _SPARK_TO_DUCK, TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_is_registered_with_oracle_or_listed():
    own = set(queries.queries())  # the text queries have tests of their own
    assert own <= set(E.queries())
    no_oracle = own - set(E.oracle_sql())
    assert no_oracle == {"als_predict", "model_based_predict", "model_based_eval"}
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    assert stypes == {d[0]: str(d[1]) for d in res.description}
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user", "item", "rating", "prediction", "source", "n_neighbors"]
