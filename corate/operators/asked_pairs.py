"""Similarities of the pairs that test pairs ask for, in passes over the first members.

Test pairs and training ratings of a group (a user, or an item) are one list
of members, each rated or asked for. Two rated members of a list are a
co-rating row; an asked and a rated one are a candidate. Both are dealt by
their lesser member as in ``skew.dealt_pairs`` and meet in one task, which sums
the rows of asked pairs only and sends each candidate its similarity where
that is not 0. Neither similarities nor candidates are shuffled by pair.

A pass deals the lists of some first members, as many as make ``PASS_PAIRS``
pairs, and writes what it found; its shuffle files go before the next pass. So
disk holds the lists of a pass, however many pairs there are in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.functions.columns import CENTRED_ZERO
from corate.operators.exact_pairs import _limbs, _product, correlation
from corate.operators.skew import DEFAULT_HOT_ROWS, attach_buckets, deal_lists
from corate.session import delete_files, table_path, write_files, write_table

#: Pairs of a pass: what its shuffle holds on disk.
PASS_PAIRS = 500_000_000
#: Pairs that a task works on at once, and of one first member beyond which it is dealt by its pairs.
CHUNK = 1 << 20
HOT_ASKED_PAIRS = 2 * CHUNK
#: Elements of a list that a row takes to Python.
PIECE = 512

Score = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class MemberLists(NamedTuple):
    """The members of each group in ascending order with their columns, once per list column."""

    ordinary: DataFrame      # group, ids, columns
    hot: DataFrame | None    # group, member, columns, _nb, _b: members of groups dealt in buckets
    names: tuple[str, ...]   # group, member, columns
    pairs: int               # pairs of members in all
    longest: int             # members of the longest list


def member_lists(rows: DataFrame, group: str, member: str, columns: list[str], hot_rows: int | None = DEFAULT_HOT_ROWS, tables: list | None = None) -> MemberLists:
    """The lists of ``rows``, written once (noted in ``tables``); groups above ``hot_rows`` are dealt in buckets."""
    d = rows.select(group, member, *columns).where(F.col(group).isNotNull() & F.col(member).isNotNull())
    salted = None if hot_rows is None else attach_buckets(d, group, hot_rows, None)
    held = F.sort_array(F.collect_list(F.struct(member, *columns))).alias("_held")
    found = (d if salted is None else salted.where("_nb = 1")).groupBy(group).agg(held).where(F.size("_held") > 1)
    ordinary = write_table(found.select(group, *[F.col("_held").getField(c).alias(f"_{c}") for c in (member, *columns)]), "lists", tables=tables)
    n = F.size(f"_{member}").cast("bigint")
    r = ordinary.agg(F.sum(n * (n - 1) / 2).alias("pairs"), F.max(n).alias("longest")).first()
    pairs, longest, hot = int(r["pairs"] or 0), int(r["longest"] or 0), None
    if salted is not None:
        hot = salted.where("_nb > 1").withColumn("_b", F.pmod(F.xxhash64(member), F.col("_nb")).cast("int"))
        n = hot.groupBy(group).agg(F.count("*").alias("n"))
        r = n.agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs"), F.max("n").alias("longest")).first()
        pairs, longest = pairs + int(r["pairs"]), max(longest, int(r["longest"]))
    return MemberLists(ordinary, hot, (group, member, *columns), pairs, longest)


def later_lists(lists: MemberLists, at_pass: int = 0, passes: int = 1) -> DataFrame:
    """(m1, group, <column>1, m2s, <column>2s): as ``skew.later_members``, of the first members of a pass."""
    group, member, *columns = lists.names
    mine = F.pmod(F.xxhash64("m1", F.lit("pass")), F.lit(passes)) == at_pass
    held = [member, *columns]
    after = lambda at: [F.slice(f"_{c}", at + 1, F.size(f"_{member}")).alias("m2s" if c == member else f"{c}2s") for c in held]
    at = F.col("_at") + 1
    each = lists.ordinary.select("*", F.posexplode(f"_{member}").alias("_at", "m1")).where(mine & (at < F.size(f"_{member}")))
    out = each.select("m1", group, *[F.get(f"_{c}", F.col("_at")).alias(f"{c}1") for c in columns], *after(at))
    if lists.hot is None:
        return out
    fan = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    left = lists.hot.withColumn("m1", F.col(member)).where(mine)
    left = left.select(group, F.col("_b").alias("_b1"), fan.alias("_b2"), "m1", *[F.col(c).alias(f"{c}1") for c in columns])
    bucket = lists.hot.groupBy(group, "_nb", "_b").agg(F.sort_array(F.collect_list(F.struct(*held))).alias("_held"))
    right = bucket.select(group, fan.alias("_b1"), F.col("_b").alias("_b2"), *[F.col("_held").getField(c).alias(f"_{c}") for c in held])
    keys = [group, "_b1", "_b2"]
    n = int(out.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = left.repartition(n, *keys).join(right.repartition(n, *keys), keys)
    met = met.withColumn("_at", F.size(F.filter(f"_{member}", lambda x: x <= F.col("m1")))).where(F.col("_at") < F.size(f"_{member}"))
    return out.unionByName(met.select("m1", group, *[f"{c}1" for c in columns], *after(F.col("_at"))))


def in_passes(lists: MemberLists, work: Callable[[DataFrame, int], DataFrame], hint: str, tables: list | None = None) -> DataFrame:
    """What ``work`` makes of the lists of each pass and the number of its pairs,
    written to a folder and read back. No shuffle outlives its pass."""
    spark, passes = lists.ordinary.sparkSession, max(1, -(-lists.pairs // PASS_PAIRS))
    folder, paths = table_path(spark, hint), []
    for i in range(passes):
        done = work(later_lists(lists, i, passes), lists.pairs // passes)
        paths.append(f"{folder}/{i}")
        write_files(done, paths[-1])
    if tables is not None:
        tables.append(folder)
    return spark.read.schema(done.schema).parquet(*paths)


# --- scores: x and y of rows in order of their pairs, whether there is an x and a y,
# --- where each pair begins, its number of rows -> similarity of each pair

def _sums(start: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    return [np.add.reduceat(v, start) for v in values]


def _ratio(some: np.ndarray, num: np.ndarray, den: np.ndarray) -> np.ndarray:
    some = some & (den != 0)
    return np.where(some, num, 0.0) / np.where(some, den, 1.0)


def pearson_score(shift: float) -> Score:
    """As ``columns.pearson_from_moments``, of ratings less ``shift``."""
    def score(x, y, hx, hy, start, n):
        x, y, both = np.where(hx, x - shift, 0.0), np.where(hy, y - shift, 0.0), hx & hy
        sx, sy, sxy, sxx, syy, some = _sums(start, x, y, np.where(both, x * y, 0.0), x * x, y * y, both.astype(np.int64))
        nd = n.astype(np.float64)
        noise = 2 * 2.0**-52 * (nd + 4.0)
        num, vx, vy = nd * sxy - sx * sy, nd * sxx - sx * sx, nd * syy - sy * sy
        real = (some > 0) & (vx > noise * nd * sxx) & (vy > noise * nd * syy) & (np.abs(num) > noise * nd * np.sqrt(sxx * syy))
        return _ratio(real, num, np.sqrt(np.where(real, vx, 1.0)) * np.sqrt(np.where(real, vy, 1.0)))
    return score


def exact_score(top: int) -> Score:
    """As ``exact_pairs``: from sums of whole numbers."""
    def score(x, y, hx, hy, start, n):
        a, b = _limbs(np.where(hx, x, 0.0), top), _limbs(np.where(hy, y, 0.0), top)
        values = [*a, *b, *_product(a, b), *_product(a, a), *_product(b, b), (hx & hy).astype(np.int64)]
        return correlation(n, np.array(_sums(start, *values)))
    return score


def sum_normalized_score() -> Score:
    """As ``columns.sum_normalized``."""
    def score(x, y, hx, hy, start, n):
        x, y = np.where(hx, x, 0.0), np.where(hy, y, 0.0)
        sx, sy, sxy = _sums(start, x, y, np.where(hx & hy, x * y, 0.0))
        return _ratio(sxy != 0, sxy, sx * sy)
    return score


def centred_score() -> Score:
    """As ``columns.centred_pearson``, of deviations."""
    def score(x, y, hx, hy, start, n):
        x, y = np.where(hx, x, 0.0), np.where(hy, y, 0.0)
        sab, saa, sbb = _sums(start, np.where(hx & hy, x * y, 0.0), x * x, y * y)
        den = np.sqrt(saa) * np.sqrt(sbb)
        return _ratio(np.abs(sab) > CENTRED_ZERO * den, sab, den)
    return score


class Rows(NamedTuple):
    """Lists of some first members, in their order, and the lists' elements one after the other."""

    m1: np.ndarray
    b: np.ndarray
    group: np.ndarray
    v1: np.ndarray
    has1: np.ndarray
    ask1: np.ndarray
    size: np.ndarray
    m2: np.ndarray
    v2: np.ndarray
    has2: np.ndarray
    ask2: np.ndarray

    def cut(self, a: int, b: int) -> Rows:
        ends = np.cumsum(self.size)
        lo, hi = (int(ends[i - 1]) if i else 0 for i in (a, b))
        return Rows(*[c[a:b] for c in self[:7]], *[c[lo:hi] for c in self[7:]])


def _rows(batch: pa.RecordBatch) -> Rows:
    c = dict(zip(batch.schema.names, batch.columns))
    plain = lambda x: x.to_numpy(zero_copy_only=False)
    v2 = c["v2s"].flatten()
    return Rows(plain(c["m1"]), plain(c["_b"]), plain(c["group"]), plain(c["v1"]), plain(c["v1"].is_valid()), plain(c["ask1"]),
                np.diff(plain(c["m2s"].offsets)), plain(c["m2s"].flatten()), plain(v2), plain(v2.is_valid()), plain(c["ask2s"].flatten()))


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[Rows]:
    """The rows, some ``chunk`` pairs at a time, all those of a first member (and part of it) together."""
    kept: list[Rows] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(_rows(batch))
        n += len(kept[-1].m2)
        if n < chunk:
            continue
        rows = Rows(*map(np.concatenate, zip(*kept)))
        ends = np.flatnonzero((rows.m1[1:] != rows.m1[:-1]) | (rows.b[1:] != rows.b[:-1])) + 1
        if len(ends):
            yield rows.cut(0, int(ends[-1]))
            rows = rows.cut(int(ends[-1]), len(rows.m1))
        kept, n = [rows], len(rows.m2)
    if kept:
        yield Rows(*map(np.concatenate, zip(*kept)))


def asked_of(rows: Rows, score: Score, least: int) -> tuple[np.ndarray, ...] | None:
    """(group, asked, nbr, sim, rating of nbr) of the candidates in ``rows`` whose similarity is not 0."""
    at = np.repeat(np.arange(len(rows.m1)), rows.size)
    first = np.cumsum(np.concatenate([[False], rows.m1[1:] != rows.m1[:-1]]))[at]  # number of the first member
    ask1 = rows.ask1[at]
    asks, rated = np.flatnonzero(ask1 != rows.ask2), np.flatnonzero(~(ask1 | rows.ask2))
    bits = max(10, int(len(at)).bit_length() + 2)
    mark = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ rows.m2.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mark = ((mark ^ (mark >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)

    def met(some: np.ndarray, others: np.ndarray) -> np.ndarray:
        seen = np.zeros(1 << bits, bool)
        seen[mark[others]] = True
        return some[seen[mark[some]]]

    # rows of pairs that nobody asks for, and candidates without a row, go before anything is sorted
    rated = met(rated, asks)
    asks = met(asks, rated)
    if not len(rated) or not len(asks):
        return None
    rated = rated[np.lexsort((rows.m2[rated], first[rated]))]
    a, b = first[rated], rows.m2[rated]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    n = np.diff(np.append(start, len(rated)))
    if least > 1:
        many = n >= least
        rated, start, n = rated[np.repeat(many, n)], start[many], n[many]
        start = np.cumsum(n) - n
        if not len(n):
            return None
    sim = score(rows.v1[at[rated]], rows.v2[rated], rows.has1[at[rated]], rows.has2[rated], start, n)
    pair = rated[start][sim != 0]
    sim = sim[sim != 0]
    if not len(pair):
        return None
    ids = np.unique(rows.m2[pair])
    code = first[pair] * len(ids) + np.searchsorted(ids, rows.m2[pair])
    there = np.minimum(np.searchsorted(ids, rows.m2[asks]), len(ids) - 1)
    asks, there = asks[ids[there] == rows.m2[asks]], there[ids[there] == rows.m2[asks]]
    wanted = first[asks] * len(ids) + there
    where = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
    found = code[where] == wanted
    asks, where = asks[found], where[found]
    one, row = ask1[asks], at[asks]
    value, has = np.where(one, rows.v2[asks], rows.v1[row]), np.where(one, rows.has2[asks], rows.has1[row])
    return (rows.group[row], np.where(one, rows.m1[row], rows.m2[asks]), np.where(one, rows.m2[asks], rows.m1[row]), sim[where], np.ma.masked_array(value, ~has))


def asked_similarities(
    train: DataFrame, truth: DataFrame, group: str, member: str, value: str, score: Score, least: int = 1, most: int | None = None,
    hot_rows: int | None = DEFAULT_HOT_ROWS, tables: list | None = None,
) -> DataFrame:
    """(group, member, nbr, sim, v): for each test pair (group, member) of
    ``truth`` the members of the group in ``train`` whose similarity is not 0.

    ``train`` is unique on (group, member), ``truth`` too, and they share no
    key; ids are whole numbers. ``v``: the neighbour's ``value`` in the group.
    ``score``: the similarity of two members from their rows, of which 0 comes
    of fewer than ``least``. ``most``: bound of the pairs of a first member."""
    asked = truth.select(group, member, F.lit(None).cast("double").alias("v"), F.lit(True).alias("ask"))
    rated = train.select(group, member, F.col(value).cast("double").alias("v"), F.lit(False).alias("ask"))
    scratch: list[str] = []
    lists = member_lists(rated.unionByName(asked), group, member, ["v", "ask"], hot_rows, scratch)
    listed = ("m2s", "v2s", "ask2s")
    chunk, spark = CHUNK, train.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, chunk):
            found = asked_of(rows, score, least)
            if found is not None and len(found[0]):
                *exact, v = found
                yield pa.RecordBatch.from_arrays([*map(pa.array, exact), pa.array(v.data, mask=v.mask)], [group, member, "nbr", "sim", "v"])

    def work(later: DataFrame, pairs: int) -> DataFrame:
        dealt, key = deal_lists(later.withColumnRenamed(group, "group"), pairs, most, listed, HOT_ASKED_PAIRS)
        if "_b" not in dealt.columns:
            dealt = dealt.withColumn("_b", F.lit(0))
        dealt = dealt.sortWithinPartitions("m1", "_b")
        if lists.longest > PIECE:
            at = F.col("_piece") * PIECE + 1
            dealt = dealt.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.size("m2s") - 1) / F.lit(PIECE)).cast("int"))))
            dealt = dealt.select(*[F.slice(c, at, F.lit(PIECE)).alias(c) if c in listed else c for c in dealt.columns if c != "_piece"])
        rows = dealt.select("m1", "_b", "group", "v1", "ask1", *listed)
        return rows.mapInArrow(run, f"`{group}` bigint, `{member}` bigint, nbr bigint, sim double, v double")

    try:
        return in_passes(lists, work, "asked", tables)
    finally:
        for path in scratch:
            delete_files(spark, path)


def ranked(truth: DataFrame, train: DataFrame, found: DataFrame, group: str, member: str, fields: dict[str, str], k: int | None) -> DataFrame:
    """As ``neighbors.top_k`` of all candidates of ``truth``: (user, item, nbr,
    <fields>, sim, nbr_rank), from those with a similarity, ``found``, and each
    group's members in order of their ids, which are first among the others.
    ``fields``: the names of columns of ``train`` that a neighbour has. With
    ``k`` None all candidates, without a rank and with the first of the fields
    only, null where the similarity is 0.

    Candidates are not shuffled: the lists are laid out by group."""
    names = ["nbr", *fields.values()]
    held = train.select(group, F.col(member).alias("nbr"), *[F.col(c).alias(n) for c, n in fields.items()])
    held = held.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("_held"))
    held = held.select(group, *[F.col("_held").getField(c).alias(f"_{c}") for c in names])
    near = F.struct((-F.col("sim")).alias("order"), "nbr", "sim", "v")
    near = found.groupBy(group, member).agg(F.collect_list(near).alias("_near"))
    asked = truth.select("user", "item").join(near.hint("merge"), ["user", "item"], "left")
    kind = f"array<struct<order: double, nbr: {train.schema[member].dataType.simpleString()}, sim: double, v: double>>"
    asked = asked.withColumn("_near", F.coalesce("_near", F.array().cast(kind)))
    rest = F.array_except("_nbr", F.col("_near").getField("nbr"))
    if k is not None:
        rest = F.slice(rest, 1, k)
    zero = F.lit(0.0)
    rest = F.transform(rest, lambda x: F.struct(zero.alias("order"), x.alias("nbr"), zero.alias("sim"), F.lit(None).cast("double").alias("v")))
    top = F.concat("_near", rest)
    if k is not None:
        top = F.slice(F.sort_array(top), 1, k)
    every = asked.join(held.hint("merge"), group).select("user", "item", *[f"_{c}" for c in names], F.posexplode(top).alias("_at", "_n"))
    if k is None:
        return every.select("user", "item", "_n.nbr", F.col("_n.v").alias(names[1]), "_n.sim")
    # a member without an id is the first of its list
    at = F.coalesce(F.array_position("_nbr", F.col("_n.nbr")), F.lit(1)).cast("int") - 1
    return every.select("user", "item", "_n.nbr", *[F.get(f"_{c}", at).alias(c) for c in names[1:]], "_n.sim", (F.col("_at") + 1).cast("bigint").alias("nbr_rank"))
