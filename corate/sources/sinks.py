"""Prediction file and metrics report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.functions.columns import PREDICTION_HEADER


def prediction_rows(pred: DataFrame) -> DataFrame:
    """(UserId, MovieId, Pred_rating) ordered by user then item (numeric).

    ``orderBy`` range-partitions the output, so the sort stays parallel and
    the part files are in global order.
    """
    u, i, p = PREDICTION_HEADER
    return pred.select(
        F.col("user").alias(u), F.col("item").alias(i), F.col("prediction").alias(p)
    ).orderBy(u, i)


def write_predictions(
    pred: DataFrame,
    path: str,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write the sorted prediction file(s) with the header row.

    The default writes globally ordered parts, each with the header.
    ``single_file=True`` gives the one-file output, whatever the row count:
    the parts are sorted and written in parallel, without headers, and then
    joined byte by byte in part order behind one header.
    """
    rows = prediction_rows(pred)
    if not single_file:
        rows.write.mode(mode).option("header", True).csv(path)
        return
    rows.write.mode(mode).option("header", False).csv(path)
    join_parts(pred.sparkSession, path, ",".join(PREDICTION_HEADER) + "\n")


def join_parts(spark: SparkSession, path: str, header: str, name: str = "part-00000.csv", buffer: int = 1 << 20) -> None:
    """The part files of folder ``path`` as one file ``name`` that starts with ``header``.

    Bytes go from file to file in part order through a buffer of the driver's
    JVM; nothing is sorted, parsed or held. The parts go once the whole file
    is there, under a name that readers skip until then.
    """
    fs_package, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    folder = fs_package.Path(path)
    fs = folder.getFileSystem(conf)
    parts = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    joining, done = fs_package.Path(folder, "_joining"), fs_package.Path(folder, name)
    out = fs.create(joining, True)
    try:
        out.write(bytearray(header.encode()))
        for part in parts:
            source = fs.open(part)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, buffer, False)
            finally:
                source.close()
    finally:
        out.close()
    for part in parts:
        fs.delete(part, False)
    fs.rename(joining, done)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row evaluation report as JSON."""
    metrics.coalesce(1).write.mode(mode).json(path)
