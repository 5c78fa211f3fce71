"""Command line: run one recommender on CSV files, write the prediction file,
print the error bands and the RMSE.

    python -m corate model-based RATINGS GENRES TEST OUT [--seed N]
    python -m corate item-based  RATINGS TEST OUT [--k 10] [--metric pearson]
    python -m corate user-based  RATINGS TEST OUT [--k 1] [--loo literal]
    python -m corate item-pairs  RATINGS TEST OUT

RATINGS: ``user,item,rating,<ignored>`` with a header; TEST: ``user,item``
with a header; GENRES: ``item,genre`` or ``item,"title",genre`` without a
header. Use ``spark-submit`` (or ``--master``) to run on a cluster; the
session's ``spark.checkpoint.dir`` should then name a shared folder.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from corate.constants import (
    ALS_ITERATIONS,
    ALS_LAMBDA,
    ALS_RANK,
    ERROR_BANDS,
    ITEM_NEIGHBOURS,
    USER_NEIGHBOURS,
)
from corate.plans import pipelines as P
from corate.session import ensure_checkpoint_dir, materialize
from corate.sources.readers import read_genres_csv, read_ratings_csv, read_test_csv
from corate.sources.sinks import write_metrics, write_predictions


def _report(metrics_row, seconds: float) -> None:
    for name, lo, hi in ERROR_BANDS:
        label = f">={lo:g} and <{hi:g}" if hi is not None else f">={lo:g}"
        print(f"{label}: {metrics_row[name]}")
    print(f"RMSE = {metrics_row['rmse']}")
    print(f"seconds: {seconds}")


def _rejected(rejects: dict, out: str) -> int:
    """Write each file's rejected rows to ``out/rejects/<file>`` and print their counts."""
    total = 0
    for name, rows in rejects.items():
        path = f"{out}/rejects/{name}"
        rows.write.mode("overwrite").json(path)
        n = rows.sparkSession.read.schema(rows.schema).json(path).count()
        print(f"rejected rows of {name}: {n}")
        total += n
    return total


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="corate")
    sub = ap.add_subparsers(dest="job", required=True)
    mb = sub.add_parser("model-based")
    mb.add_argument("ratings"); mb.add_argument("genres"); mb.add_argument("test"); mb.add_argument("out")
    mb.add_argument("--rank", type=int, default=ALS_RANK)
    mb.add_argument("--iterations", type=int, default=ALS_ITERATIONS)
    mb.add_argument("--reg", type=float, default=ALS_LAMBDA)
    mb.add_argument("--seed", type=int, default=42)
    mb.add_argument("--impute", choices=["genre", "item_mean"], default="genre")
    ib = sub.add_parser("item-based")
    ib.add_argument("ratings"); ib.add_argument("test"); ib.add_argument("out")
    ib.add_argument("--k", type=int, default=ITEM_NEIGHBOURS)
    ib.add_argument("--metric", choices=["pearson", "sum_normalized"], default="pearson")
    ib.add_argument("--genres", default=None, help="genre file: fall back to the same-genre mean first")
    ub = sub.add_parser("user-based")
    ub.add_argument("ratings"); ub.add_argument("test"); ub.add_argument("out")
    ub.add_argument("--k", type=int, default=USER_NEIGHBOURS)
    ub.add_argument("--loo", choices=["literal", "corrected"], default="literal")
    ip = sub.add_parser("item-pairs")
    ip.add_argument("ratings"); ip.add_argument("test"); ip.add_argument("out")
    for p in (mb, ib, ub, ip):
        p.add_argument("--master", default=None)
        p.add_argument("--single-file", action="store_true", help="one sorted CSV file, written by one task")
        p.add_argument("--on-bad-row", choices=("report", "fail"), default="report", help="rejected input rows: go on without them, or stop")
    a = ap.parse_args(argv)

    b = SparkSession.builder.appName(f"corate-{a.job}")
    if a.master:
        b = b.master(a.master)
    spark = b.getOrCreate()
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    t0 = time.time()
    genres_path = getattr(a, "genres", None)
    read = {"ratings": read_ratings_csv(spark, a.ratings), "test": read_test_csv(spark, a.test)}
    if genres_path:
        read["genres"] = read_genres_csv(spark, genres_path)
    if _rejected({k: v.rejects for k, v in read.items()}, a.out) and a.on_bad_row == "fail":
        print("stopped because of rejected rows (--on-bad-row report goes on without them)")
        return 2
    ratings, test = read["ratings"].rows, read["test"].rows
    genres = read["genres"].rows if genres_path else None
    prep = P.prepare(ratings, test, genres)

    if a.job == "item-pairs":
        pairs = P.item_pairs(prep)
        pairs.write.mode("overwrite").parquet(f"{a.out}/pairs")
        n = spark.read.parquet(f"{a.out}/pairs").count()
        print(f"co-rated item pairs: {n}")
        print(f"seconds: {time.time() - t0}")
        return 0
    if a.job == "model-based":
        r = P.model_based(prep, a.rank, a.iterations, a.reg, a.seed, a.impute)
        pred, metrics = r.predictions, r.metrics
    elif a.job == "item-based":
        r = P.item_based(prep, k=a.k, metric=a.metric, fallback="genre" if genres is not None else "user_mean")
        pred = materialize(r.predictions, "auto", "pred")
        metrics = P.evaluate(pred)
    else:
        r = P.user_based(prep, k=a.k, loo=a.loo)
        pred = materialize(r.predictions, "auto", "pred")
        metrics = P.evaluate(pred)
    write_predictions(pred, f"{a.out}/predictions", single_file=a.single_file)
    write_metrics(metrics, f"{a.out}/metrics")
    _report(metrics.first(), time.time() - t0)
    return 0


if __name__ == "__main__":
    sys.exit(main())
