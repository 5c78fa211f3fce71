"""Divergence between the sources of a language, from count-level bitmaps.

The terms kept in a language get ids; every (source, count) stores the bitset
of the ids that occur that often in that source. For a pair of sources, AND
and popcount of two bitsets give the joint cell: the number of terms that
occur a times here and b times there. The divergence of the pair is the sum of
the cells times f(a, b). Cells with a zero count follow by complement: they
are the bitset sizes less the cells found, so that only bitsets of counts
above zero are stored.

With F(a, b) = f of the levels, n(a, b) the cells above zero, g(a) and h(b)
the bitset sizes and V the kept terms,

    sum = sum n(a,b) (F(a,b) - F(a,0) - F(0,b) + F(0,0))
        + sum g(a) (F(a,0) - F(0,0)) + sum h(b) (F(0,b) - F(0,0)) + V F(0,0).

Ids follow the order of the terms' largest counts. Terms that occur at most
``PACKED`` times in every source share words of 64 ids (they have few levels,
so few ANDs a word); a term above that has a word of its own, as its levels
would hardly ever meet.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, saved, text_bytes

MIN_DOCS, TOP, PACKED = 3, 200, 8
#: Fixed value: a level is 1 + floor(SCALE * (count + 1) / (all counts + terms)).
SCALE = 1_000_000_000
#: Terms counted in a Python task before they are handed on, bytes of text split at once.
_FLUSH, _PIECE = 300_000, 1 << 20
#: Groups up to this number are broadcast (some 100 bytes each); beyond, they are joined by shuffle.
MAX_BROADCAST = 100_000
#: Letters, lower case; what is no letter separates. Bytes above 0x7F belong to letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of ``text``, a bounded piece at a time, cut between terms."""
    text = text.translate(_FOLD)
    at = 0
    while at < len(text):
        end = len(text) if at + _PIECE >= len(text) else text.rfind(b" ", at, at + _PIECE) + 1 or len(text)
        if end <= at:
            end = len(text)
        yield text[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) sums over parts of ``docs``; a row with null term and n 0 for each group.

    Every task adds up its own documents first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, Counter] = {}
        in_docs: dict[tuple, Counter] = {}

        def flush() -> pa.RecordBatch:
            cols: list[list] = [[], [], [], [], []]
            for (lang, source), counts in n.items():
                cols[0] += [lang] * (len(counts) + 1)
                cols[1] += [source] * (len(counts) + 1)
                cols[2] += [None, *counts]
                cols[3] += [0, *counts.values()]
                cols[4] += [0, *map(in_docs[lang, source].__getitem__, counts)]
            n.clear(), in_docs.clear()
            term = pa.array(cols[2], type=pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), term,
                                               pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                                              ["lang", "source", "term", "n", "docs"])

        held = 0  # terms in the counters
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                counts, seen = n.setdefault((lang, source), Counter()), in_docs.setdefault((lang, source), Counter())
                before, own = len(counts), set()
                for terms in _pieces(text):
                    counts.update(terms)
                    own.update(terms)
                seen.update(own)
                held += len(counts) - before
                if held > _FLUSH:
                    yield flush()
                    held = 0
        if n:
            yield flush()

    text = F.call_function("make_valid_utf8", F.coalesce(F.col("text"), F.lit("")))
    own = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], text.alias("text"))
    return own.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def _level(n: str, total: str) -> str:
    """Level of a count, exact at any size; ``total`` is N + V."""
    return f"1 + ({SCALE}BD * (cast({n} as decimal(20,0)) + 1)) div greatest({total}, 1BD)"


def _f(p: str, q: str) -> str:
    """Levels are at most SCALE + 1: the square fits a bigint."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


class Audit:
    """Term counts, groups and bitsets of ``docs``, written once; ``pairs`` and ``terms`` read them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, packed: int = PACKED):
        docs = pick(docs, lang="string", source="string", text="string")
        counts = saved(count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "audit-counts")
        found = counts.where("term is not null")
        terms = found.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.max("n").alias("top"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        order = ("lang", "top", "term")
        terms = terms.repartitionByRange(*order).sortWithinPartitions(*order)
        # neighbours in this order have neighbouring ids; written, as ids hold for one run only
        self.lang_terms = saved(terms.select("lang", "term", "all", "top", F.monotonically_increasing_id().alias("id")), "audit-terms")
        self.kept = saved(found.select("lang", "source", "term", "n").join(self.lang_terms, ["lang", "term"]), "audit-kept")
        langs = self.lang_terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum(F.col("all").cast("decimal(20,0)")).alias("lang_n"))
        own = self.kept.groupBy("lang", "source").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("own_n"))
        groups = counts.where("term is null").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.selectExpr("lang", "source", "coalesce(v, 0) as v",
                                   "cast(coalesce(own_n, 0) + coalesce(v, 0) as decimal(20,0)) as total",
                                   "cast(coalesce(lang_n, 0) + coalesce(v, 0) as decimal(20,0)) as lang_total")
        groups = saved(groups.withColumn("z", F.expr(_level("0", "total"))), "audit-groups")
        self.groups = F.broadcast(groups) if groups.count() <= MAX_BROADCAST else groups
        alone = F.col("top") > packed
        word = F.when(alone, -1 - F.col("id")).otherwise(F.shiftright("id", 6))
        bit = F.when(alone, F.lit(0)).otherwise(F.col("id") % 64).cast("int")
        sets = self.kept.select("lang", "source", "n", word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bit"))
        sets = sets.groupBy("lang", "word", "source", "n").agg(F.bit_or("bit").alias("bits"))
        #: (lang, word, source, n, bits, p, z): the terms of a word with count n, their level and the level of count zero.
        self.bitsets = saved(sets.join(self.groups, ["lang", "source"]).select("lang", "word", "source", "n", "bits", F.expr(_level("n", "total")).alias("p"), "z"), "audit-bitsets")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) of every ordered pair of sources of a language."""
        a = self.bitsets.select("lang", "word", *[F.col(c).alias(f"a_{c}") for c in ("source", "bits", "p", "z")])
        b = self.bitsets.select("lang", "word", *[F.col(c).alias(f"b_{c}") for c in ("source", "bits", "p", "z")])
        joint = a.join(b, ["lang", "word"]).where("a_source < b_source and a_bits & b_bits <> 0")
        joint = joint.withColumn("cells", F.bit_count(F.col("a_bits").bitwiseAND(F.col("b_bits"))))

        def cell(a: str, b: str) -> str:
            return f"cast(cells * ({_f(f'{a}_p', f'{b}_p')} - {_f(f'{a}_p', f'{b}_z')} - {_f(f'{a}_z', f'{b}_p')} + {_f(f'{a}_z', f'{b}_z')}) as decimal(20,0))"

        joint = joint.groupBy("lang", "a_source", "b_source").agg(F.expr(f"sum({cell('a', 'b')})").alias("ab"), F.expr(f"sum({cell('b', 'a')})").alias("ba"))
        joint = joint.select("lang", F.expr("stack(2, a_source, b_source, ab, b_source, a_source, ba) as (source, item, value)"))

        sizes = self.bitsets.groupBy("lang", "source", "p", "z").agg(F.sum(F.bit_count("bits")).alias("size"))
        other = self.groups.select("lang", F.col("source").alias("item"), F.col("z").alias("q"))
        single = sizes.join(other, "lang").where("source <> item")
        single = single.groupBy("lang", "source", "item").agg(
            F.expr(f"sum(cast(size * ({_f('p', 'q')} - {_f('z', 'q')}) as decimal(20,0)))").alias("ab"),
            F.expr(f"sum(cast(size * ({_f('q', 'p')} - {_f('q', 'z')}) as decimal(20,0)))").alias("ba"))
        single = single.select("lang", F.expr("stack(2, source, item, ab, item, source, ba) as (source, item, value)"))

        zero = self.groups.select("lang", "source", "v", "z").join(other, "lang").where("source <> item")
        zero = zero.select("lang", "source", "item", F.expr(f"cast(v * {_f('z', 'q')} as decimal(30,0))").alias("value"))
        every = zero.union(joint).union(single)
        return every.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))

    def terms(self, top: int = TOP) -> DataFrame:
        """(lang, source, item, value, rank) of the terms a source has more of than its language, the first ``top``."""
        rows = self.kept.join(self.groups, ["lang", "source"]).select(
            "lang", "source", F.col("term").alias("item"), F.expr(_level("n", "total")).alias("p"), F.expr(_level("all", "lang_total")).alias("q"))
        rows = rows.where("p > q").select("lang", "source", "item", F.expr(_f("p", "q")).alias("value"))
        return ranked(rows).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, packed: int = PACKED) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of every pair of sources, and the terms of each source.

    Reads text, lang and source; null or absent reads as ''. Every group that
    occurs takes part, also without terms; a language without kept terms has
    pairs of value 0 and no terms. Equal values are ranked by item, in UTF-8
    order. Repeated rows count as often as they are there. Bytes that are no
    UTF-8 read as U+FFFD. An empty table gives an empty result. A text is
    split a piece at a time. Sums are exact.
    """
    found = Audit(docs, min_docs, packed)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked(found.pairs()).withColumn("part", F.lit("pair")).select(columns).union(
        found.terms(top).withColumn("part", F.lit("term")).select(columns))
