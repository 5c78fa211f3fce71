"""Quality rules with adaptive thresholds (built-in functions only).

Each text gets a few measures. Their distribution in every (lang, source)
group is kept as a mergeable quantile sketch: a histogram over log-linear
buckets (32 per power of two), so a quantile read from it is at most one
bucket, 1/32, off, and adding up the counts of two sketches is the sketch of
both inputs. Groups, tasks and days merge by that one sum, in any order, with
the same result. A group's threshold for a measure is an outer fence of its
quantiles, never below a least value (a group in which a measure is nearly
always zero has no spread to speak of); groups whose usual values are higher
get higher thresholds. A document is rejected if a measure passes its group's
threshold, after the two fixed base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE_CLASS, internal, saved

WINDOW = 5
#: Share of repeated words (percent) and words below which the base rules reject.
MAX_REPEAT_PERCENT, MIN_WORDS = 20, 10

#: measure -> (per-mille of what, least value of any group's threshold)
MEASURES = {
    "symbols": ("1000 * n_symbols div nullif(n_words, 0)", 50),
    "dup_lines": ("1000 * n_dup_lines div nullif(n_lines, 0)", 400),
    "repeats": ("1000 * n_repeat_words div nullif(n_words, 0)", 200),
    "word_length": ("1000 * word_chars div nullif(n_words, 0)", 9000),
}
#: Fence: upper quartile plus FENCE times the distance from the median to it (at least one bucket).
QUANTILES, FENCE = (0.5, 0.75), 6
SUB_BITS = 5


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    All stay in the row: no shuffle, no Python. ``n_repeat_words`` sorts the
    hashes of the five-word windows of one text with their positions, marks
    those found twice, and adds up what the marked windows cover. Null text
    reads as empty; every measure is then 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("__words", F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != ""))
    out = out.withColumn("__lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")))
    n = F.size("__words")
    # 64-bit hashes of the windows
    out = out.withColumn("__grams", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.get(F.col("__words"), i + (k - 1)) for k in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("__once", F.size(F.array_distinct("__grams")) == F.size("__grams"))
    out = out.withColumn("__at", F.when(F.col("__once"), F.array().cast("array<int>")).otherwise(_repeated("__grams")))
    cover = F.aggregate(
        F.col("__at"), F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["sum"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("sum"), p.alias("last")),
    )["sum"]
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n.cast("bigint").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        cover.cast("bigint").alias("n_repeat_words"),
    )


def _repeated(grams: str) -> Column:
    """Ascending positions whose hash occurs at another position too."""
    ordered = F.sort_array(F.transform(F.col(grams), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = F.transform(F.array(ordered), lambda s: F.filter(
        s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | (x["h"] == F.get(s, i - 1)["h"])))
    return F.sort_array(F.transform(F.get(marked, F.lit(0)), lambda x: x["i"]))


def bucket(value: Column) -> Column:
    """Log-linear bucket of a count: exact below 64, then 32 buckets per power of two."""
    cut = F.greatest(F.length(F.bin(value)) - (SUB_BITS + 1), F.lit(0))
    return (cut * (1 << SUB_BITS) + F.call_function("shiftright", value, cut)).cast("bigint")


def bucket_top(b: Column) -> Column:
    """Largest value of a bucket."""
    cut = F.greatest(F.floor(b / (1 << SUB_BITS)) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", b - cut * (1 << SUB_BITS) + 1, cut) - 1


def with_measures(docs: DataFrame) -> DataFrame:
    """``measures`` plus one per-mille column ``m_<name>`` for each of ``MEASURES`` (0 without words)."""
    out = measures(docs)
    for name, (what, _) in MEASURES.items():
        out = out.withColumn(f"m_{name}", F.coalesce(F.expr(what), F.lit(0)).cast("bigint"))
    return out


def sketch(measured: DataFrame) -> DataFrame:
    """Mergeable sketches: (lang, source, measure, bucket, n).

    The sketch of a union is the sum of ``n`` over the sketches by the four
    keys. Rows that fail the base rules or have no words are left out.
    """
    good = measured.where(~base_failed())
    rows = good.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), bucket(F.col(f"m_{name}")).alias("bucket")) for name in MEASURES
    ])).alias("x")).select("lang", "source", "x.*")
    return rows.groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, t_<measure>...): each group's fences, read from its sketches."""
    key = ["lang", "source", "measure"]
    upto = F.sum("n").over(W.partitionBy(*key).orderBy("bucket"))
    total = F.sum("n").over(W.partitionBy(*key))
    at = sketches.withColumn("upto", upto).withColumn("total", total)
    q = [F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("total")), F.col("bucket"))) for p in QUANTILES]
    fences = at.groupBy(*key).agg(q[0].alias("mid"), q[1].alias("high"))
    mid, high = bucket_top(F.col("mid")), bucket_top(F.col("high"))
    step = F.greatest(high - mid, bucket_top(F.col("high") + 1) - high)
    fences = fences.withColumn("fence", high + FENCE * step)
    margin = F.create_map(*[F.lit(x) for name, (_, least) in MEASURES.items() for x in (name, least)])
    fences = fences.withColumn("fence", F.greatest(F.col("fence"), margin[F.col("measure")]))
    return fences.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == name, F.col("fence"))).alias(f"t_{name}") for name in MEASURES
    ])


def judge(docs: DataFrame, few_groups: int = 100_000) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, the group's fences and ``kept``.

    Needs columns text, lang, source; others are carried along, and those
    named like an added column are renamed with a trailing underscore. Null
    lang or source forms a group of its own. Null or blank texts fail the base
    rules. Repeated rows are judged alike. An empty table gives an empty
    result. The measured documents are written once; the sketches are summed
    per task before the shuffle, so a hot group is a few hundred rows per
    task, and the fences (a row per group) are broadcast if their counted rows
    are few and joined otherwise.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
             *[f"{p}_{m}" for m in MEASURES for p in "mt"], "base_failed", "kept"]
    taken = {c.lower() for c in added}
    docs = docs.select(*[F.col(f"`{c}`").alias(c + "_" if c.lower() in taken else c) for c in docs.columns])
    measured = saved(with_measures(docs), "quality-measures")
    fences = saved(thresholds(sketch(measured)), "quality-fences")
    small = fences.count() <= few_groups
    right = fences.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    out = measured.join(
        F.broadcast(right) if small else right,
        F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left",
    ).drop("__lang", "__source")
    inside = [F.coalesce(F.col(f"m_{m}") <= F.col(f"t_{m}"), F.lit(True)) for m in MEASURES]
    verdict = ~F.col("base_failed")
    for ok in inside:
        verdict = verdict & ok
    return out.withColumn("base_failed", base_failed()).withColumn("kept", verdict)
