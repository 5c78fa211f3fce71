"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, table_path, write_table

#: ASCII white space: what separates words in the word-based operators.
SPACE_CLASS = r"\x20\x09-\x0D"

DOCUMENT_COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``columns`` (name=type) of ``df``; one that is absent reads as null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{c}`") if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()
    ])


def saved(df: DataFrame, hint: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Later jobs read files instead of recomputing, also after lost executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return write_table(df, hint)


def shared_path(spark: SparkSession, hint: str) -> str:
    """A fresh folder that driver and executors both see."""
    ensure_checkpoint_dir(spark)
    return table_path(spark, hint)


def internal(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its letter case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null reads as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def with_columns(batch: pa.RecordBatch, added: dict[str, pa.Array], keep: Iterable[str] | None = None) -> pa.RecordBatch:
    """``batch`` (or its columns ``keep``) with further columns at the end."""
    names = list(keep) if keep is not None else list(batch.schema.names)
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *added.values()], [*names, *added])


def schema_of(df: DataFrame, **more: str) -> T.StructType:
    """Schema of ``df`` with further columns, all nullable."""
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    added = T.StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in more.items())) if more else T.StructType()
    return T.StructType(fields + added.fields)


def shipped(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of ``value`` with the code it needs; ``pickle.loads(b.value)`` opens it in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process, shared by its tasks."""
    home = sys.modules.setdefault("corate_worker_caches", ModuleType("corate_worker_caches"))
    return home.__dict__.setdefault(name, {})
