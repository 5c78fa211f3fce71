"""Session helpers: a tuned local session for tests/bench, and lineage cuts.

On a cluster the session is created by the platform; the library only reads
its settings. ``spark.checkpoint.dir`` must name a shared folder there. We set
one ourselves only when it is unset (local tests and the bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "corate",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a local session with AQE on and the UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CORATE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the session names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint dir; create a scratch one only in local mode."""
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset on a cluster session; "
            "set it to a shared folder"
        )
    d = tempfile.mkdtemp(prefix="corate-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()


def table_path(spark: SparkSession, hint: str = "t") -> str:
    """A fresh folder under the session's shared checkpoint dir."""
    d = checkpoint_dir(spark)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is unset; no shared folder for tables")
    return f"{d.rstrip('/')}/corate-{hint}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is run within leaves no shuffle files on the executors' disks. Else
    they stay until the driver happens to collect the plan they belong to,
    which a small driver may not do before the end of the job."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_files(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write ``df`` as parquet to ``path``; no shuffle files stay behind."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        w.parquet(path)


def write_table(df: DataFrame, hint: str = "t", partition_by: list[str] | None = None, tables: list | None = None) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back.
    The folder is noted in ``tables``, if given.

    One job computes the frame once; readers get column pruning, filter
    pushdown and (with ``partition_by``) partition pruning, and lost executors
    re-read files instead of recomputing upstream shuffles.
    """
    path = table_path(df.sparkSession, hint)
    write_files(df, path, partition_by)
    if tables is not None:
        tables.append(path)
    # read back with the writer's schema (partition values are otherwise
    # re-inferred from folder names, e.g. a boolean comes back as a string)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Layout(NamedTuple):
    """A bucketed table in the shared checkpoint folder: enough to open it again in another session."""

    path: str
    key: str
    buckets: int
    columns: str   # DDL


def write_layout(df: DataFrame, key: str, buckets: int, hint: str = "layout") -> Layout:
    """``df`` written in ``buckets`` hash buckets of ``key``, one file each, sorted by ``key``.

    Frames laid out alike are co-partitioned: joins and aggregations on
    ``key`` between them need no exchange. The files are read again after lost
    executors and by other sessions; nothing is cached.
    """
    spark = df.sparkSession
    path, name = table_path(spark, hint), f"corate_{uuid.uuid4().hex[:16]}"
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)  # a task holds the one bucket it writes
    with shuffles_freed(spark):
        dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files stay
    return Layout(path, key, buckets, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields))


def _layout_name(layout: Layout) -> str:
    return "corate_" + layout.path.rstrip("/").rsplit("-", 1)[-1]


def open_layout(spark: SparkSession, layout: Layout) -> DataFrame:
    """The table of ``layout``, known to the planner as bucketed by its key."""
    name = _layout_name(layout)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({layout.columns}) USING parquet CLUSTERED BY (`{layout.key}`) "
              f"SORTED BY (`{layout.key}`) INTO {layout.buckets} BUCKETS LOCATION '{layout.path}'")
    return spark.table(name)


def drop_layout(spark: SparkSession, layout: Layout) -> None:
    """Forget the table of ``layout`` and delete its files."""
    spark.sql(f"DROP TABLE IF EXISTS {_layout_name(layout)}")
    delete_files(spark, layout.path)


def delete_files(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared checkpoint dir."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, how: str | None = "auto", hint: str = "t") -> DataFrame:
    """Cut or cache the lineage of a frame that is read more than once.

    ``table``: parquet written to the session's shared checkpoint folder and
    read back (see ``write_table``).
    ``checkpoint``: Spark's reliable RDD checkpoint into the same folder (it
    computes the frame twice unless the frame is also cached, so ``table`` is
    preferred).
    ``persist``: MEMORY_AND_DISK cache (lost blocks are recomputed).
    ``auto``: ``table`` when a checkpoint dir is configured, else ``persist``.
    ``None``/``"none"``: leave as is.
    """
    if how in (None, "none"):
        return df
    if how == "auto":
        how = "table" if checkpoint_dir(df.sparkSession) else "persist"
    if how == "table":
        return write_table(df, hint)
    if how == "checkpoint":
        if not checkpoint_dir(df.sparkSession):
            raise RuntimeError("checkpoint requested but spark.checkpoint.dir is unset")
        return df.persist(StorageLevel.MEMORY_AND_DISK).checkpoint(eager=True)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    raise ValueError(f"unknown materialize mode {how!r}")
