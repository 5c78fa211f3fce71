"""Stand-in inputs built from the benchmark tables.

The recommender needs rating events, test pairs and item genres. The
benchmark directory holds TPC-H-like tables instead, so this module maps them
onto those three schemas and does nothing else; the recommender's own work
(last-wins dedup, hold-out split, similarities, ...) runs in ``operators``.

Fixed values of the mapping (see FIXTURES.md):

* rating event: ``lineitem JOIN orders ON l_orderkey = o_orderkey``;
  user = ``o_custkey``, item = ``l_partkey``,
  rating = ``ceil(l_quantity / 5) / 2`` (0.5 .. 5.0 for quantities 1 .. 50);
  event order = ``(l_orderkey, l_linenumber, l_quantity)``, the last wins.
* off-grid rating event: the same, with rating = ``l_extendedprice / 19997``
  and event order ``(l_orderkey, l_linenumber, l_extendedprice)``.
* genre: ``part``: item = ``p_partkey``, genre = ``p_brand``.
* test pairs (stand-in for the hold-out file): rating keys with
  ``(user*7 + item*13) % 10 = 0 OR item % 97 = 0 OR user % 211 = 0``,
  plus ``customer JOIN part ON c_custkey = p_partkey`` where
  ``c_custkey % 10 = 3`` (pairs that have no rating at all).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Inputs(NamedTuple):
    events: DataFrame   # user, item, rating, seq (struct) -- may repeat keys
    genres: DataFrame   # item, genre
    test: DataFrame     # user, item (distinct)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def half_stars(quantity: str) -> Column:
    return F.ceil(F.col(quantity) / F.lit(5.0)).cast("double") / F.lit(2.0)


def rating_events(spark: SparkSession, sf_dir: str, offgrid: bool = False) -> DataFrame:
    """(user, item, rating, seq). Orders grow with the ratings and are never
    broadcast, however small their file is."""
    value = "l_extendedprice" if offgrid else "l_quantity"
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", value)
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("user"),
        F.col("l_partkey").cast("bigint").alias("item"),
        (F.col(value) / F.lit(19997.0) if offgrid else half_stars(value)).alias("rating"),
        F.struct("l_orderkey", "l_linenumber", value).alias("seq"),
    )


def item_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("item"), F.col("p_brand").alias("genre")
    )


def test_pairs(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    u, i = F.col("user"), F.col("item")
    held = events.select("user", "item").filter(
        ((u * 7 + i * 13) % 10 == 0) | (i % 97 == 0) | (u % 211 == 0)
    )
    cust = _t(spark, sf_dir, "customer").select("c_custkey").filter(F.col("c_custkey") % 10 == 3)
    part = _t(spark, sf_dir, "part").select("p_partkey")
    unanswered = cust.join(part.hint("merge"), cust.c_custkey == part.p_partkey).select(
        F.col("c_custkey").cast("bigint").alias("user"),
        F.col("p_partkey").cast("bigint").alias("item"),
    )
    return held.unionByName(unanswered).distinct()


def benchmark_inputs(spark: SparkSession, sf_dir: str, offgrid: bool = False) -> Inputs:
    events = rating_events(spark, sf_dir, offgrid)
    return Inputs(events, item_genres(spark, sf_dir), test_pairs(spark, sf_dir, events))


class CsvInputs(NamedTuple):
    ratings: str
    test: str
    genres: str
    parts: str


#: Every line of these order keys is followed by the header once more in ``parts``.
HEADER_EVERY = 500


def write_csv_inputs(spark: SparkSession, sf_dir: str, folder: str, names: tuple[str, ...] = CsvInputs._fields) -> CsvInputs:
    """The inputs as files in the recommender's own formats, those of ``names``
    under ``folder``, with malformed lines between the good ones: one in the
    ratings for each ``events`` row's user (``x<user>``, no item), and, for each
    region, lines with a field too many, one too few and a quote left open;
    one in the test file for each supplier (``<key>,none``); one in the genres
    for each nation (its name for the item). Rating lines are in event order;
    the genre file has quoted titles with commas, and an earlier line for each
    item with another genre. ``parts`` holds the good rating lines in parts of
    which only the first starts with the header, which comes back within."""
    paths = CsvInputs(*(f"{folder}/{n}" for n in CsvInputs._fields))
    if "ratings" in names or "parts" in names:
        _write_ratings(spark, sf_dir, paths, names)
    if "test" in names:
        supp = _t(spark, sf_dir, "supplier").select(_text("s_suppkey").alias("userId"), F.lit("none").alias("movieId"))
        test = test_pairs(spark, sf_dir, rating_events(spark, sf_dir))
        pairs = test.select(_text("user").alias("userId"), _text("item").alias("movieId")).unionByName(supp)
        pairs.write.option("header", True).csv(paths.test)
    if "genres" in names:
        title = F.concat(F.lit("Part, The ("), _text("item"), F.lit(")"))
        named = item_genres(spark, sf_dir).select("item", _text("item").alias("first"), title.alias("title"), "genre", F.lit(1).alias("nth"))
        earlier = named.withColumn("nth", F.lit(0)).withColumn("genre", F.concat(F.lit("Z"), "genre"))
        nations = _t(spark, sf_dir, "nation").select(
            F.lit(None).cast("bigint").alias("item"), F.col("n_name").alias("first"), F.lit("Nation, A").alias("title"),
            F.lit("none").alias("genre"), F.lit(0).alias("nth"))
        rows = named.unionByName(earlier).unionByName(nations).orderBy("nth", "item")
        rows.select("first", "title", "genre").write.option("header", False).option("escape", '"').csv(paths.genres)
    return paths


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _line(*c: Column) -> Column:
    return F.concat_ws(",", *c)


def _write_ratings(spark: SparkSession, sf_dir: str, paths: CsvInputs, names: tuple[str, ...]) -> None:
    """The rating lines, sorted by order key, then event (lines of no event
    first). Events are sorted as numbers and become text behind the sort."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    good = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("l_orderkey").cast("bigint").alias("at"), F.lit(1).alias("event"), F.col("l_linenumber").cast("bigint").alias("line_nr"), F.col("l_quantity").cast("double").alias("quantity"),
        F.lit(0).alias("nth"), F.col("o_custkey").cast("bigint").alias("user"), F.col("l_partkey").cast("bigint").alias("item"), F.lit(None).cast("string").alias("line"))
    no = lambda kind: F.lit(None).cast(kind)

    def others(df: DataFrame, line: Column, nth: int) -> DataFrame:
        return df.select(F.col("at").cast("bigint").alias("at"), F.lit(0).alias("event"), no("bigint").alias("line_nr"), no("double").alias("quantity"),
                         F.lit(nth).alias("nth"), no("bigint").alias("user"), no("bigint").alias("item"), line.alias("line"))

    def write(lines: DataFrame, path: str) -> None:
        ordered = lines.orderBy("at", "event", "line_nr", "quantity", "nth")
        made = _line(_text("user"), _text("item"), _text(half_stars("quantity")), _text("at"))
        ordered.select(F.when(F.col("event") == 1, made).otherwise(F.col("line")).alias("value")).write.text(path)

    header = F.lit("userId,movieId,rating,timestamp")
    top = others(spark.range(1).select(F.lit(-1).alias("at")), header, 0)
    if "ratings" in names:
        clicks = _t(spark, sf_dir, "events").select(F.col("user_id").alias("at"), _text("user_id").alias("k"))
        bad = others(clicks, _line(F.concat(F.lit("x"), "k"), F.lit("none"), F.lit("3.5"), F.col("k")), 1)
        key = _t(spark, sf_dir, "region").select(F.col("r_regionkey").alias("at"), _text("r_regionkey").alias("k"))
        lines = good.unionByName(bad).unionByName(top)
        ragged = [_line(F.col("k"), F.lit("1,3.5,9,extra")), _line(F.col("k"), F.lit("1,2.5")), _line(F.concat(F.lit('"'), "k"), F.lit("1,3.0,4"))]
        for i, line in enumerate(ragged):
            lines = lines.unionByName(others(key, line, 2 + i))
        write(lines, paths.ratings)
    if "parts" in names:
        again = others(good.select("at").where(f"at % {HEADER_EVERY} = 0").distinct(), header, 0)
        write(good.unionByName(again).unionByName(top), paths.parts)
