"""Readers for the recommender's three inputs.

Ratings file: ``user,item,rating,<trailing column>``; the trailing column is
ignored. Test file: ``user,item[,...]``. Genre file: ``item,genre`` or
``item,"title, with commas",genre`` without a header; the genre string is
compared as one whole value.

Files are read as lines and parsed line by line (no quoted line breaks). The
header of a folder is its first line, found once; lines that equal it are
dropped wherever they stand, so parts without a header and parts joined with
their headers lose no data row. A line with a quote left open, with another
number of fields than the header, or with a value that does not parse is a
reject: it comes out with its text, file and line number, and fails nothing.
Blank lines are neither rows nor rejects.
"""

from __future__ import annotations

import csv
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corate.constants import PREDICTION_HEADER

#: ``header`` of the readers: the first line, unless it parses as data.
AUTO = "auto"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line", "quote": '"', "escape": '"'}


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame   # <field>_raw ..., line, reason (quote, fields, type), file, line_no


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, seq) of every line. ``seq`` = (file path, start of the file
    split, increasing id within the split): a total order that follows the
    files' own line order whatever way Spark packs the splits into partitions."""
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("id"),
        ).alias("seq"),
    )


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line that is not blank, files in path order; None if there is none.

    Asks one file after the other, so that usually the head of one is read.
    """
    lines = spark.read.text(path)
    full = F.trim("value") != ""
    for name in sorted(lines.inputFiles()):
        name = re.sub("^file:/+", "file:/", name)  # as the metadata column spells it
        row = lines.where((F.col("_metadata.file_path") == name) & full).select("value").first()
        if row is not None:
            return row[0]
    # no lines, or a store that spells the names in another way
    first = F.min_by("value", "seq").alias("value")
    return read_lines(spark, path).where(full).agg(first).first()[0]


def _split(line: str) -> list[str]:
    return next(csv.reader([line]), [])


def _is_data(line: str) -> bool:
    """Whether the first two fields are whole numbers."""
    return sum(bool(re.fullmatch(r"\s*[+-]?[0-9]+\s*", f)) for f in _split(line)[:2]) == 2


def numbered(rejects: DataFrame, lines: DataFrame) -> DataFrame:
    """``rejects`` (with ``seq``) with the file and the line number from 1 in place of ``seq``.

    Lines are counted per file split, one row each; the numbers of a file's
    splits are added up over these rows.
    """
    at = lambda c: F.col(f"seq.{c}")
    split = [at("file_path").alias("file"), at("file_block_start").alias("block")]
    blocks = lines.groupBy(*split).agg(F.count("*").alias("n"), F.min(at("id")).alias("least"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    named = rejects.select("*", *split, at("id").alias("id")).join(F.broadcast(blocks), ["file", "block"])
    return named.select(*[c for c in rejects.columns if c != "seq"], "file",
                        (F.col("before") + F.col("id") - F.col("least") + 1).alias("line_no"))


def in_order(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``rows`` with ``seq`` as one number, in the same order: the number of
    the file split, then the line within it. Sums and maxima by it need no
    sort, as they do by a path; the splits' table has one row each."""
    split = [F.col("seq.file_path").alias("_file"), F.col("seq.file_block_start").alias("_block")]
    nth = F.row_number().over(Window.orderBy("_file", "_block")).cast("bigint").alias("_nth")
    splits = lines.select(*split).distinct().select("_file", "_block", nth)
    row = F.col("seq.id").bitwiseAND(F.lit((1 << 33) - 1))  # the id's upper bits are the task's
    number = F.shiftleft("_nth", 33) + row
    named = rows.select("*", *split).join(F.broadcast(splits), ["_file", "_block"])
    return named.withColumn("seq", number).select(*rows.columns)


def _fields(lines: DataFrame, n: int) -> DataFrame:
    """(value, seq, f): the fields c0.. of each line, ``f._line`` set if they are not ``n``."""
    schema = ", ".join(f"c{i} STRING" for i in range(n)) + ", _line STRING"
    return lines.select("value", "seq", F.from_csv("value", schema, _OPTIONS).alias("f"))


def _open_quote() -> Column:
    return F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1


def _parse(lines: DataFrame, fields: DataFrame, n_wrong: Column, typed: dict[str, Column], raw: dict[str, Column]) -> Parsed:
    """Rows whose ``typed`` columns all parse; the rest as rejects with their ``raw`` fields."""
    reason = F.when(_open_quote(), "quote").when(n_wrong, "fields")
    missing = F.lit(False)
    for c in typed:
        missing = missing | F.col(c).isNull()
    out = fields.select("value", "seq", reason.alias("reason"), *[v.alias(k) for k, v in typed.items()], *[v.alias(k) for k, v in raw.items()])
    out = out.withColumn("reason", F.coalesce("reason", F.when(missing, "type")))
    rejects = out.where(F.col("reason").isNotNull()).select(*raw, F.col("value").alias("line"), "reason", "seq")
    return Parsed(out.where(F.col("reason").isNull()).select(*typed, "seq"), numbered(rejects, lines))


def _cast(c: str, t: str) -> Column:
    return F.expr(f"try_cast({c} AS {t})")


def _body(spark: SparkSession, path: str, header: str | None, without_last: bool) -> tuple[DataFrame, DataFrame, str | None]:
    """(all lines, lines that are neither blank nor the header, header).

    ``without_last``: lines are compared with the header but for their last
    field, as the trailing column is no part of the data.
    """
    lines = read_lines(spark, path)
    if header == AUTO:
        line = first_line(spark, path)
        header = None if line is None or _is_data(line) else line
    body = lines.where(F.trim("value") != "")
    if header is not None:
        same = lambda c: F.regexp_replace(c, ",[^,]*$", "") if without_last else c
        body = body.where(same(F.col("value")) != same(F.lit(header)))
    return lines, body, header


def read_ratings_csv(spark: SparkSession, path: str, header: str | None = AUTO) -> Parsed:
    """(user, item, rating, seq); ``seq`` is the file order, for last-wins dedup.

    ``header``: the header line, None for no header, or ``AUTO``. Lines have
    as many fields as the header, or four; at least three.
    """
    lines, body, header = _body(spark, path, header, True)
    n = max(3, len(_split(header))) if header else 4
    f = _fields(body, n)
    parsed = _parse(
        lines, f, F.col("f._line").isNotNull(),
        {"user": _cast("f.c0", "BIGINT"), "item": _cast("f.c1", "BIGINT"), "rating": _cast("f.c2", "DOUBLE")},
        {"user_raw": F.col("f.c0"), "item_raw": F.col("f.c1"), "rating_raw": F.col("f.c2")},
    )
    return Parsed(in_order(parsed.rows, lines), parsed.rejects)


def read_test_csv(spark: SparkSession, path: str, header: str | None = AUTO) -> Parsed:
    """Distinct (user, item) test pairs; further columns are ignored, but every
    line has as many as the header (without one: as the first line)."""
    lines, body, header = _body(spark, path, header, False)
    n = max(2, len(_split(header or first_line(spark, path) or ",")))
    f = _fields(body, n)
    parsed = _parse(
        lines, f, F.col("f._line").isNotNull(),
        {"user": _cast("f.c0", "BIGINT"), "item": _cast("f.c1", "BIGINT")},
        {"user_raw": F.col("f.c0"), "item_raw": F.col("f.c1")},
    )
    return Parsed(parsed.rows.select("user", "item").distinct(), parsed.rejects)


def read_genres_csv(spark: SparkSession, path: str) -> Parsed:
    """(item, genre), the last line of an item wins; accepts the two- and the
    three-column form per row. Quoted titles with commas stay one field, so
    the three-column file needs no hand editing."""
    lines, body, _ = _body(spark, path, None, False)
    three = _fields(body, 3)
    two = F.from_csv("value", "c0 STRING, c1 STRING, _line STRING", _OPTIONS).alias("g")
    f = three.select("value", "seq", "f", two)
    genre = F.when(F.col("f._line").isNull(), F.col("f.c2")).otherwise(F.col("g.c1"))
    parsed = _parse(
        lines, f, F.col("f._line").isNotNull() & F.col("g._line").isNotNull(),
        {"item": _cast("f.c0", "BIGINT"), "genre": genre},
        {"item_raw": F.col("f.c0"), "genre_raw": genre},
    )
    return Parsed(dedup_genres(parsed.rows), parsed.rejects)


def dedup_genres(genres: DataFrame, order_col: str = "seq") -> DataFrame:
    """One genre per item: the last in ``order_col``; without such a column
    the greatest genre string, so that the choice does not hang on the plan."""
    last = F.max_by("genre", order_col) if order_col in genres.columns else F.max("genre")
    return genres.groupBy("item").agg(last.alias("genre"))


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """A prediction file read back: (position, UserId, MovieId, Pred_rating).

    ``position`` counts the rows from 1 in file order (files by name, lines
    within a file), from the rows before each file (a table of one row per
    file) and the row number within it."""
    u, i, p = PREDICTION_HEADER
    rows = spark.read.option("header", True).schema(f"{u} BIGINT, {i} BIGINT, {p} DOUBLE").csv(path)
    rows = rows.select(
        u, i, p,
        F.col("_metadata.file_name").alias("_file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_line"),
    )
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    files = rows.groupBy("_file").agg(F.count("*").alias("_n")).select("_file", before.alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_file").orderBy("_line"))
    return rows.withColumn("_nth", nth).join(files, "_file").select(
        (F.coalesce("_before", F.lit(0)) + F.col("_nth")).alias("position"), u, i, p
    )


def read_parquet_ratings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        F.col("user").cast("bigint"), F.col("item").cast("bigint"), F.col("rating").cast("double")
    )
