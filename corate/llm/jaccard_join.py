"""Exact Jaccard join of documents' word n-gram sets, with skips from relations between sets.

A document's set has its distinct word shingles as 64-bit hashes. Elements are
put into one order, commonest last; two sets of n and m elements whose Jaccard
similarity reaches the threshold share at least o = ceil(P (n + m) / (100 + P))
elements, hence one among the first n - o + 1 of one and m - o + 1 of the
other. An inverted index over such prefixes gives the candidates. Two kinds of
skips keep it short (after Wang et al., "Leveraging Set Relations in Exact Set
Similarity Join", 2017):

* Index lists are dealt into blocks by the size of the set and the position of
  the element in it. A probe from position i of a set of n elements joins with
  the blocks only in which some size and position can still reach o.
* Answers of similar sets are nearly the same. The sets of a list are first
  compared with pivots of the list; of a set only its differences to a pivot
  are kept. Two sets with one pivot c are compared by these differences alone,

      |x & y| = |c| - |(c - x) | (c - y)| + |(x - c) & (y - c)|,

  and a pair whose sets are already in one component through their pivots is
  not looked at again, so that a group of near copies costs a few rows a set
  instead of all its pairs.

Every set carries a 512-bit parity map of its elements; the number of bits in
which two maps differ is at most the number of elements in which the sets
differ, so the join drops hopeless candidates before any set is fetched. No
step loses a pair: the skips are bounds, and what passes is checked on whole
sets (or on differences, which comes to the same).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, saved, shipped, text_bytes
from .graph import components

SHINGLE, PERCENT, MAP_BITS, ROUNDS, PIVOTS = 4, 85, 512, 2, 8
#: Sets of more elements are held against longer parity maps before they are fetched.
LARGE, LARGE_MAP_BITS = 512, 8192
#: Entries of the table of common shingles that every task gets (9 bytes each), and hashes counted at once.
COMMON, _CHUNK = 1 << 20, 1 << 21
#: Pairs and names of sets up to this number are broadcast (some 24 bytes each); beyond, the sets are shuffled.
MAX_BROADCAST = 1 << 20
#: Bits of the filter for the second reading of the texts (16 MB at any input size).
FILTER_BITS = 1 << 27


def hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; with fewer words, of all words as one; no words: none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    k = min(shingle, len(words))
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[i:i + k])) for i in range(len(words) - k + 1)), dtype=np.uint64, count=len(words) - k + 1))


def _digest(found: np.ndarray) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(found.astype("<u8").tobytes()), dtype="<i8")


def parity_map(found: np.ndarray, bits: int = MAP_BITS) -> np.ndarray:
    """Parities of the elements that hash to each of ``bits`` places, as int64 words."""
    odd = np.bincount((found >> np.uint64(40)).astype(np.int64) % bits, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def common_shingles(docs: DataFrame, shingle: int = SHINGLE, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the commonest shingles, sorted, and their frequency classes.

    Only the order of elements rests on it, no result. Tasks count the
    documents of each shingle and hand on what they met twice; of these the
    highest classes that fit into ``most`` entries are taken.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def count() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], ["h", "n"])

        for batch in batches:
            for text in text_bytes(batch.column(0)):
                held.append(hashes(text, shingle))
                size += len(held[-1])
                if size > _CHUNK:
                    yield count()
                    size = 0
        if held:
            yield count()

    counted = docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    counted = saved(counted.select("h", F.least(F.floor(4 * F.log2("n")), F.lit(250)).cast("int").alias("c")), "jaccard-common")
    left, least = most, 256
    for c, n in sorted(((r[0], r[1]) for r in counted.groupBy("c").count().collect()), reverse=True):
        if n > left:
            break
        left, least = left - n, c
    got = counted.where(F.col("c") >= least).toArrow()
    h, c = got.column("h").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.argsort(h)
    return h[order], c[order].astype(np.uint8)


def describe(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, t, n, d1, d2, bits, prefix) of every row: size, 128-bit digest, parity map and prefix of its set."""
    table = shipped(docs.sparkSession, common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, classes = pickle.loads(table.value)
        for batch in batches:
            size, digests, maps, prefixes = [], [], [], []
            for text in text_bytes(batch.column(2)):
                found = hashes(text, shingle)
                size.append(len(found))
                digests.append(_digest(found))
                maps.append(parity_map(found))
                length = len(found) + percent * len(found) // -100 + 1 if len(found) else 0
                if len(keys) and len(found):
                    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                    order = np.lexsort((found, np.where(keys[at] == found, classes[at], 0)))
                    found = found[order]
                prefixes.append(found[:length].view(np.int64))
            digest = np.concatenate(digests) if digests else np.zeros(0, np.int64)
            ends = np.cumsum([0, *map(len, prefixes)], dtype=np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            words = MAP_BITS // 64
            bits = pa.ListArray.from_arrays(np.arange(len(size) + 1, dtype=np.int32) * words, np.concatenate(maps) if maps else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(digest[::2]), pa.array(digest[1::2]), bits, pa.ListArray.from_arrays(ends, flat)],
                ["doc_id", "t", "n", "d1", "d2", "bits", "prefix"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    return rows.mapInArrow(run, "doc_id bigint, t bigint, n bigint, d1 bigint, d2 bigint, bits array<bigint>, prefix array<bigint>")


def _least(n: str, m: str, percent: int) -> str:
    """Elements that sets of sizes n and m share at least if they are similar."""
    return f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"


def _differ(x: str, y: str) -> str:
    """Places in which two parity maps differ."""
    return " + ".join(f"bit_count({x}_bits[{i}] ^ {y}_bits[{i}])" for i in range(MAP_BITS // 64))


def _reach(x: str, y: str, percent: int) -> Column:
    """Whether sets met at positions x_i, y_i can be similar, by sizes and positions."""
    least = _least(f"{x}_n", f"{y}_n", percent)
    return F.expr(f"100 * least({x}_n, {y}_n) >= {percent} * greatest({x}_n, {y}_n) and {x}_i <= {x}_n - {least} and {y}_i <= {y}_n - {least}")


def _fetch(docs: DataFrame, wanted: DataFrame, shingle: int, map_bits: int = 0) -> DataFrame:
    """(id, elements): whole sets of the classes ``wanted`` (id, t, d1, d2), from one more reading of the texts;
    with ``map_bits`` parity maps of so many bits in their place.

    A bit filter of the text hashes spares most texts the work. It has one
    size whatever the input; when it fills up, more texts are hashed than
    needed, and the join still takes the right ones.
    """
    place = F.pmod("t", F.lit(FILTER_BITS)) + 1  # the bitmap functions count from 1
    parts = wanted.select(place.alias("p")).groupBy(F.call_function("bitmap_bucket_number", "p").alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("p"))).alias("bits"))
    filled = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for bucket, bits in parts.collect():  # at most 4096 rows of 4 KB
        at = (bucket - 1) * len(bits)
        filled[at:at + len(bits)] = np.frombuffer(bits, dtype=np.uint8)[:len(filled) - at]
    filled = shipped(docs.sparkSession, filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has, seen = pickle.loads(filled.value), set()
        for batch in batches:
            p = batch.column(0).to_numpy()
            new = []
            for i in np.flatnonzero(has[p >> 3] >> (p & 7) & 1).tolist():
                text = next(text_bytes(batch.column(1).slice(i, 1)))
                own = xxhash.xxh3_128_digest(text)
                if own not in seen:  # copies in the same task go out once
                    seen = seen if len(seen) < 100_000 else set()
                    seen.add(own)
                    found = hashes(text, shingle)
                    d = _digest(found)
                    new.append((d[0], d[1], (parity_map(found, map_bits) if map_bits else found).tobytes()))
                if len(new) == 256 or new and len(new[-1][2]) > 1 << 20:
                    yield pa.RecordBatch.from_pylist([dict(zip(("d1", "d2", "elements"), r)) for r in new], schema)
                    new.clear()
            if new:
                yield pa.RecordBatch.from_pylist([dict(zip(("d1", "d2", "elements"), r)) for r in new], schema)

    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("elements", pa.binary())])
    sets = docs.select(F.pmod(F.xxhash64("text"), F.lit(FILTER_BITS)).alias("p"), "text").mapInArrow(run, "d1 bigint, d2 bigint, elements binary")
    named = wanted.select("id", "d1", "d2")
    named = F.broadcast(named) if named.count() <= MAX_BROADCAST else named
    return sets.join(named, ["d1", "d2"]).dropDuplicates(["id"]).select("id", "elements")


_DIFFERENCES = "a bigint, b bigint, shared bigint, a_n bigint, b_n bigint, missing binary, added binary"


def _compare(pairs: DataFrame, sets: DataFrame, differences: bool = False) -> DataFrame:
    """(a, b, shared, a_n, b_n) of the pairs (a, b) by whole sets; with ``differences`` also a - b and b - a."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = x[at] == y
                shared = int(both.sum())
                gone = np.ones(len(x), dtype=bool)
                gone[at[both]] = False
                for column, value in zip(out, (shared, len(x), len(y), x[gone].tobytes() if differences else None, y[~both].tobytes() if differences else None)):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                                             ["a", "b", "shared", "a_n", "b_n", "missing", "added"])

    return _joined(pairs, sets).mapInArrow(run, _DIFFERENCES)


def _joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, a_set, b_set). Narrow pairs go to the sets; a is the side that may be in many pairs (pivots): it joins last."""
    pairs = pairs.select("a", "b")
    small = F.broadcast if pairs.count() <= MAX_BROADCAST else (lambda df: df)
    rows = sets.select(F.col("id").alias("b"), F.col("elements").alias("b_set")).join(small(pairs), "b")
    pivots = sets.join(small(pairs.select(F.col("a").alias("id")).distinct()), "id", "left_semi")
    return rows.join(pivots.select(F.col("id").alias("a"), F.col("elements").alias("a_set")), "a").select("a", "b", "a_set", "b_set")


def _map_distance(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """(a, b, differ): places in which the parity maps of a and b differ."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = [int(np.bitwise_count(np.frombuffer(x.as_buffer(), np.uint64) ^ np.frombuffer(y.as_buffer(), np.uint64)).sum())
                      for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(differ, pa.int64())], ["a", "b", "differ"])

    return _joined(pairs, maps).mapInArrow(run, "a bigint, b bigint, differ bigint")


def _derive(pairs: DataFrame) -> DataFrame:
    """(a, b, shared, a_n, b_n) of pairs with one pivot, from their differences to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column(2).to_pylist()
            sets = [[np.frombuffer(v, dtype=np.uint64) for v in batch.column(i).to_pylist()] for i in range(3, 7)]
            a_n, b_n, shared = [], [], []
            for n, x_gone, x_new, y_gone, y_new in zip(c, *sets):
                a_n.append(n - len(x_gone) + len(x_new))
                b_n.append(n - len(y_gone) + len(y_new))
                shared.append(n - len(np.union1d(x_gone, y_gone)) + len(np.intersect1d(x_new, y_new, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, pa.int64()) for v in (shared, a_n, b_n)]],
                                             ["a", "b", "shared", "a_n", "b_n"])

    return pairs.select("a", "b", "pivot_n", "a_missing", "a_added", "b_missing", "b_added").mapInArrow(run, "a bigint, b bigint, shared bigint, a_n bigint, b_n bigint")


class Join:
    """Index and links of the sets of ``docs`` (doc_id, text).

    ``rows`` has the description of every row, ``classes`` one row per
    different set (id, first doc_id). All tables are written once to the
    shared folder.
    """

    def __init__(self, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, common: int = COMMON):
        self.percent = percent
        docs = pick(docs, doc_id="bigint", text="string")
        self.rows = saved(describe(docs, common_shingles(docs, shingle, common), shingle, percent), "jaccard-rows")
        classes = self.rows.where("n > 0").groupBy("d1", "d2").agg(
            F.min("doc_id").alias("first"), F.min("t").alias("t"), F.any_value("n").alias("n"), F.any_value("bits").alias("bits"), F.any_value("prefix").alias("prefix"))
        self.classes = saved(classes.withColumn("id", F.monotonically_increasing_id()), "jaccard-classes")
        postings = self.classes.select("id", "n", F.posexplode("prefix").alias("i", "key"))
        shared = postings.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
        #: (key, id, n, i, c): the index lists of elements in the prefixes of c > 1 sets.
        self.entries = saved(postings.join(shared, "key"), "jaccard-index")
        self.docs, self.shingle = docs, shingle

    def sets(self, ids: DataFrame) -> DataFrame:
        """(id, elements) of the classes ``ids``."""
        return saved(_fetch(self.docs, self.classes.select("id", "t", "d1", "d2").join(ids, "id", "left_semi"), self.shingle), "jaccard-sets")

    def similar(self, compared: DataFrame) -> DataFrame:
        return compared.where(f"100 * shared >= {self.percent} * (a_n + b_n - shared)")

    def _narrowed(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b, a_n, b_n) without those of large sets whose longer parity maps differ too much."""
        large = pairs.where(f"least(a_n, b_n) > {LARGE}")
        ids = large.select(F.col("a").alias("id")).union(large.select("b")).distinct()
        wanted = self.classes.select("id", "t", "d1", "d2").join(ids, "id", "left_semi")
        maps = saved(_fetch(self.docs, wanted, self.shingle, LARGE_MAP_BITS), "jaccard-maps")
        far = _map_distance(large, maps).join(large, ["a", "b"])
        far = far.where(f"differ > a_n + b_n - 2 * {_least('a_n', 'b_n', self.percent)}").select("a", "b")
        return saved(pairs.join(far, ["a", "b"], "left_anti"), "jaccard-narrowed")

    def _with_maps(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, a_n, b, b_n) whose parity maps allow similarity, and the share of places ``apart``."""
        for c in ("b", "a"):
            pairs = pairs.join(self.classes.select(F.col("id").alias(c), F.col("bits").alias(f"{c}_bits")), c)
        differ = F.expr(_differ("a", "b"))
        pairs = pairs.where(differ <= F.expr(f"a_n + b_n - 2 * {_least('a_n', 'b_n', self.percent)}"))
        return pairs.select("a", "b", "a_n", "b_n", (differ / (F.col("a_n") + F.col("b_n"))).alias("apart"))

    def _pivot_pairs(self) -> DataFrame:
        """(a, b, a_n, b_n, apart): a is a pivot of a list of b, and they may be similar.

        All sets of a list of up to ``PIVOTS`` are its pivots, and about that
        many, drawn by a hash, of a longer one. A pair comes out once.
        """
        is_pivot = F.pmod(F.xxhash64("id", "key"), F.col("c")) < PIVOTS
        mine = self.entries.select("key", *[F.col(c).alias(f"e_{c}") for c in ("id", "n", "i")], is_pivot.alias("e_pivot"))
        pivot = self.entries.where(is_pivot).select("key", *[F.col(c).alias(f"p_{c}") for c in ("id", "n", "i")])
        met = mine.join(pivot, "key").where("e_id <> p_id and (not e_pivot or p_id < e_id)").where(_reach("e", "p", self.percent))
        met = met.select(F.col("p_id").alias("a"), F.col("p_n").alias("a_n"), F.col("e_id").alias("b"), F.col("e_n").alias("b_n"))
        return self._with_maps(met.distinct())

    def _block_pairs(self, entries: DataFrame, every: bool) -> DataFrame:
        """(a, b, a_n, b_n) of all pairs that a list of ``entries`` and its bounds allow; pairs in one component only if ``every``.

        The larger set probes (ties: the larger id). Blocks are named by
        element, size class and position class, both on a log scale.
        """
        p, q = self.percent, 100 + self.percent
        entries = entries.join(self.classes.select("id", "bits"), "id")
        size = f"cast(floor(ln({{0}}) / ln({100 / p})) as int)"
        place = "cast(floor(log2({0} + 1) / 3) as int)"
        index = entries.where(f"i <= n - {_least('n', 'n', p)}").select(
            "key", F.expr(size.format("n")).alias("size"), F.expr(place.format("i")).alias("place"),
            *[F.col(c).alias(f"y_{c}") for c in ("id", "n", "i", "bits", "root")])
        # sizes m of class s: at most ``hi`` and at least ``lo``, a little wide; positions that reach the least overlap
        hi, lo = f"least(n, cast(ceil(pow({100 / p}, s + 1)) as bigint) + 1)", f"greatest(({p} * n + 99) div 100, cast(floor(pow({100 / p}, s)) as bigint) - 1)"
        probe = entries.withColumn("s", F.explode(F.expr(f"sequence({size.format(f'(({p} * n + 99) div 100)')}, {size.format('n')})")))
        probe = probe.withColumn("furthest", F.expr(f"(100 * {hi} - {p} * n) div {q}")).where(f"furthest >= 0 and i <= (100 * n - {p} * {lo}) div {q}")
        probe = probe.withColumn("place", F.explode(F.expr(f"sequence(0, {place.format('furthest')})"))).select(
            "key", F.col("s").alias("size"), "place", *[F.col(c).alias(f"x_{c}") for c in ("id", "n", "i", "bits", "root")])
        met = probe.join(index, ["key", "size", "place"]).where("x_n > y_n or x_n = y_n and x_id > y_id")
        if not every:
            met = met.where("x_root <> y_root")
        met = met.where(_reach("x", "y", p)).where(f"{_differ('x', 'y')} <= x_n + y_n - 2 * {_least('x_n', 'y_n', p)}")
        return met.select(F.col("x_id").alias("a"), F.col("y_id").alias("b"), F.col("x_n").alias("a_n"), F.col("y_n").alias("b_n")).distinct()

    def links(self, every: bool = False, rounds: int = ROUNDS) -> DataFrame:
        """(a, b, shared, a_n, b_n): similar pairs of classes.

        By default enough of them to connect all that are similar; with
        ``every`` all pairs, however many there are.

        In the first round every set is compared with one pivot, that of most
        sets; in the others with the nearest pivot of each other component
        that it may be similar to. Pairs with pivots that the rounds leave,
        and all pairs of lists that have others than those with pivots,
        follow, so nothing is lost.
        """
        ids = lambda pairs: pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        columns = ("a", "b", "shared", "a_n", "b_n")
        open_ = self._narrowed(saved(self._pivot_pairs(), "jaccard-pivots")).select("a", "b", "apart") if rounds else None
        sets = self.sets(ids(open_)) if rounds else None
        compared, found, roots = None, None, None
        for turn in range(rounds + 1 if rounds else 0):
            if turn:
                named = [roots.toDF(c, f"{c}_root") for c in ("a", "b")]
                open_ = open_.select("a", "b", "apart").join(named[0], "a", "left").join(named[1], "b", "left")
                open_ = open_.where("coalesce(a_root, a) <> coalesce(b_root, b)").select("a", "b", "apart", F.coalesce("a_root", "a").alias("a_root"))
                open_ = saved(open_.join(compared.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-open")
            if turn == rounds:
                break
            if turn:
                new = open_.groupBy("b", "a_root").agg(F.min_by("a", F.struct("apart", "a")).alias("a"))
            else:
                new = open_.join(open_.groupBy("a").agg(F.count("*").alias("size")), "a").groupBy("b").agg(F.max_by("a", F.struct("size", "a")).alias("a"))
            new = new.select("a", "b")
            new = saved(_compare(new, sets, True), "jaccard-compared")
            compared = new if compared is None else compared.union(new)
            found = self.similar(compared).select(*columns)
            roots = saved(components(found), "jaccard-roots")
        at = self.entries.withColumn("root", F.col("id"))
        if rounds and not every:
            at = self.entries.where(f"c > {PIVOTS}").join(roots, F.col("id") == F.col("node"), "left")
            at = saved(at.select(*self.entries.columns, F.coalesce("root", "id").alias("root")), "jaccard-rooted")
            mixed = at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
            at = at.join(mixed, "key")
        pairs = self._narrowed(saved(self._block_pairs(at, every), "jaccard-blocks")).select("a", "b")
        if rounds and not every:
            pairs = pairs.union(open_.select("a", "b")).distinct()
        pairs = saved(pairs, "jaccard-pairs")
        if not rounds:
            return self.similar(_compare(pairs, self.sets(ids(pairs)))).select(*columns)
        # the differences to the pivot a set shares most with
        best = compared.groupBy("b").agg(F.max_by(F.struct("a", "a_n", "missing", "added"), F.struct("shared", "a")).alias("h"))
        home = saved(best.select("b", F.col("h.a").alias("pivot"), F.col("h.a_n").alias("pivot_n"), "h.missing", "h.added"), "jaccard-homes")
        light = home.select("b", "pivot")
        paired = pairs.join(light.toDF("a", "a_pivot"), "a", "left").join(light.toDF("b", "b_pivot"), "b", "left")
        paired = saved(paired.select("a", "b", F.expr("coalesce(a_pivot = b_pivot, false) as derived")), "jaccard-paired")
        derived = paired.where("derived").join(home.toDF("a", "pivot", "pivot_n", "a_missing", "a_added"), "a").join(
            home.select("b", F.col("missing").alias("b_missing"), F.col("added").alias("b_added")), "b")
        whole = paired.where("not derived").select("a", "b")
        missing = ids(whole).join(sets, "id", "left_anti")
        rest = _derive(derived).union(_compare(whole, sets.union(self.sets(missing))).select(*columns))
        return self.similar(rest) if every else self.similar(rest).union(found)

    def grouped(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) of every row."""
        roots = components(self.links())
        at = self.classes.join(roots, F.col("id") == F.col("node"), "left").select("d1", "d2", "first", F.coalesce("root", "id").alias("root"))
        least = at.groupBy("root").agg(F.min("first").alias("component_id"))
        named = at.join(least, "root").select("d1", "d2", "component_id")
        rows = self.rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("d1")).alias("d1"), F.when(F.col("n") > 0, F.col("d2")).alias("d2"))
        out = rows.join(named, ["d1", "d2"], "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, common: int = COMMON) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Needs doc_id and text; other columns are not read. Rows are linked if
    100 * shared >= percent * united of their shingle sets; a component's id
    is its smallest doc_id, null if it has none. A row without words (null,
    empty or blank text) has no shingles and is linked with nothing, not even
    with a row of the same doc_id. Repeated rows come out as often as they go
    in, in one component. An empty table gives an empty result. A text of any
    length is one set.
    """
    return Join(docs, shingle, percent, common).grouped()
