"""Mixing sources to target weights by capped water-filling (built-in functions only).

Every source has a size (words of its texts) and a weight. A source's target is
``min(cap * size, level * weight)``; the level is the one at which the targets
add up to the total. That is what clamping sources at ``cap`` epochs and
sharing the excess by weight again and again ends in, and it needs no loop:
with the sources sorted by ``cap * size / weight``, the clamped ones are a
prefix of the order. A document is then taken ``floor(rate)`` whole times
(rate = target / size of its source), and a seeded part of the documents one
time more, chosen so that the words of the part come closest to the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE_CLASS, internal, saved


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+")
    edge = (F.element_at(parts, 1) == "").cast("bigint")
    last = F.when(F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("bigint")).otherwise(0)
    return F.size(parts).cast("bigint") - edge - last


def source_targets(sizes: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    ``weights`` repeat over the sources by code point, null last. One row per
    source; the windows run over that small table only. Sources of size zero
    get target zero. An empty table gives an empty table.
    """
    pos = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (pos % len(weights) + 1).cast("int")))
    limit = F.lit(cap) * F.col("source_size")
    order = W.orderBy((limit / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    ahead = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    filled = ranked.select(
        "*",
        (F.lit(cap) * F.coalesce(F.sum("source_size").over(ahead), F.lit(0))).alias("clamped"),
        F.coalesce(F.sum("weight").over(ahead), F.lit(0)).alias("weight_ahead"),
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("weights"),
    )
    # level if this source were the first that is not clamped
    level = (F.col("total") - F.col("clamped")) / (F.col("weights") - F.col("weight_ahead"))
    filled = filled.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= limit)
    final = F.min(F.when(F.col("free"), F.struct((limit / F.col("weight")).alias("r"), F.col("source").isNull().alias("n"), F.col("source").alias("s"), F.col("level").alias("level")))).over(everything)["level"]
    return filled.select(
        "source", "source_size", "weight",
        F.when(F.col("free"), final * F.col("weight")).otherwise(limit).cast("double").alias("target"),
    )


def unit(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) fixed by the seed and the columns (first 8 hex digits of an MD5)."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def source_rates(docs: DataFrame, cap: float, weights: tuple[int, ...], seed: int) -> DataFrame:
    """One row per source: (source, source_size, target, whole, last).

    Every document of the source is taken ``whole`` times; those whose
    (seeded number, doc_id, size) is not above ``last`` once more (null: none).
    """
    size = word_count(F.col("text"))
    light = docs.select("source", F.col("doc_id").alias("id"), size.alias("size"), unit(seed, F.col("doc_id"), F.col("text")).alias("u"))
    # repeated rows of a document count together and are taken alike
    light = saved(light.groupBy("source", "u", "id", "size").agg(F.count("*").alias("n")), "mix-sizes")
    per = light.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("rows"))
    per = saved(per, "mix-sources")
    goal = source_targets(per.select("source", "source_size"), cap, weights)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = saved(
        goal.alias("g").join(per.alias("p"), F.col("g.source").eqNullSafe(F.col("p.source")))
        .select("g.source", "g.source_size", "g.target", F.ceil(F.sqrt("p.rows")).alias("slices"))
        .withColumn("whole", F.floor(rate)).withColumn("rest", (rate - F.floor(rate)) * F.col("source_size")),
        "mix-goals",
    )
    of = goal.select(F.col("source").alias("of"), "slices", "rest")
    at = light.join(_small(of), F.col("source").eqNullSafe(F.col("of"))).where("rest > 0")
    at = at.select("source", "u", "id", "size", "rest", (F.col("size") * F.col("n")).alias("words"), F.floor(F.col("u") * F.col("slices")).alias("slice"))
    totals = at.groupBy("source", "slice").agg(F.sum("words").alias("words"))
    ahead = F.sum("words").over(W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select(F.col("source").alias("of"), F.col("slice").alias("nth"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    at = at.join(totals, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("nth")))
    inside = W.partitionBy("source", "slice").orderBy("u", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    middle = F.col("ahead") + F.coalesce(F.sum("words").over(inside), F.lit(0)) + F.col("words") / F.lit(2.0)
    last = at.withColumn("middle", middle).where("middle <= rest").groupBy("source").agg(F.max(F.struct("u", "id", "size")).alias("last"))
    return goal.alias("g").join(last.alias("l"), F.col("g.source").eqNullSafe(F.col("l.source")), "left").select(
        "g.source", "g.source_size", "g.target", "g.whole", "l.last")


def _small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it is a table of few rows by count."""
    return F.broadcast(df) if df.count() <= rows else df


def mix(docs: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3), seed: int = 10) -> DataFrame:
    """``docs`` with (size, source_size, target, copies): how often each row is taken.

    Needs columns doc_id, source, text; all others are carried along, and the
    added names get a trailing underscore where they clash. Null text has size
    0. Null source is a source of its own, last in the order. Null doc_ids are
    ordered before others. Rows alike in doc_id and text are taken alike. An
    empty table gives an empty result. A source's taken words differ from its
    target by at most half the words of one document (with its repeated rows).

    The documents themselves are not shuffled: (source, seeded number, doc_id,
    size) rows are. The seeded order of a source of n rows is cut into sqrt(n)
    slices, running sums are taken inside each slice and over the slices'
    totals, so no source meets in one task. The per-source result is broadcast
    if it has few rows and joined otherwise.
    """
    rates = saved(source_rates(docs, cap, weights, seed), "mix-rates")
    names = {n: internal(docs, n) for n in ("size", "source_size", "target", "copies")}
    size, u = word_count(F.col("text")), unit(seed, F.col("doc_id"), F.col("text"))
    right = rates.select(*[F.col(c).alias(f"__mix_{c}") for c in rates.columns])
    out = docs.withColumn("__mix_size", size).withColumn("__mix_u", u).join(
        _small(right), F.col("source").eqNullSafe(F.col("__mix_source")))
    at = F.struct(F.col("__mix_u").alias("u"), F.col("doc_id").alias("id"), F.col("__mix_size").alias("size"))
    copies = (F.col("__mix_whole") + F.coalesce((at <= F.col("__mix_last")).cast("bigint"), F.lit(0))).cast("bigint")
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col("__mix_size").alias(names["size"]),
        F.col("__mix_source_size").alias(names["source_size"]), F.col("__mix_target").alias(names["target"]), copies.alias(names["copies"]),
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it."""
    mixed = mix(docs, **options)
    copies = mixed.columns[-1]
    return mixed.select(F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int"))).alias("__mix_copy"), *[F.col(f"`{c}`") for c in docs.columns]).drop("__mix_copy")
