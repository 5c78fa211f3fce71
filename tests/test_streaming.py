"""Stream scoring gives the batch predictor's answers."""

import os

import pytest

from corate.plans import pipelines as P
from corate.streaming import item_based_scorer, score_stream, user_based_scorer
from tests import micro


@pytest.mark.parametrize("kind", ["item", "user"])
def test_stream_matches_batch(spark, scratch, kind):
    prep = micro.prepared(spark)
    src = os.path.join(scratch, "in")
    pairs = spark.createDataFrame([(3, 30, 3.0), (3, 40, None), (1, 10, 4.0)],
                                  "user BIGINT, item BIGINT, rating DOUBLE")
    pairs.coalesce(1).write.parquet(os.path.join(src, "b1"))
    stream = spark.readStream.schema(pairs.schema).parquet(os.path.join(src, "*"))
    scorer = item_based_scorer(prep) if kind == "item" else user_based_scorer(prep)
    out = os.path.join(scratch, "out")
    q = score_stream(stream, scorer, out, os.path.join(scratch, "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = {(r["user"], r["item"]): round(r["prediction"], 9)
           for r in spark.read.parquet(out).collect()}
    if kind == "item":
        want_df = P.item_based(prep, pairs=pairs).predictions
    else:
        want_df = P.user_based(prep, pairs=pairs).predictions
    want = {(r["user"], r["item"]): round(r["prediction"], 9) for r in want_df.collect()}
    assert got == want and len(got) == 3
