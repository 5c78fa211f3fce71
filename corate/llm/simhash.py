"""SimHash near-duplicates by the generalised pigeonhole principle.

Texts get 64-bit SimHash fingerprints. To find all fingerprints at most ``d``
bits apart, the 64 bit positions are grouped into ``m`` partitions, correlated
bits together. If thresholds t_1..t_m add up to ``d - m + 1``, two fingerprints
within ``d`` bits differ in at most t_i bits of some partition i. Each
fingerprint gets thresholds of its own by dynamic programming over estimated
candidate counts (-1 leaves a partition out), probes all values within t_i of
its own in partition i, and every candidate is verified on all 64 bits.
(Qin et al., "GPH: Similarity Search in Hamming Space", 2018.)
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import internal, saved, schema_of, text_bytes, with_columns
from .graph import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Histogram bits per partition: the estimates are tables of 2**CELL_BITS cells each.
CELL_BITS = 12
_BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash over word shingles; no words: 0. Majority of more than half the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    k = min(shingle, len(words))
    start, end = start[: len(words) - k + 1].tolist(), end[k - 1:].tolist()
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(start), _BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(start[at:at + _BLOCK], end[at:at + _BLOCK])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = (2 * counts > len(start)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with its SimHash as a bigint column ``name``. Null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(batch.schema.get_field_index("text")))
            out = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield with_columns(batch, {name: pa.array(out, type=pa.int64())})

    return docs.mapInArrow(run, schema_of(docs, **{name: "bigint"}))


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits how often both are set.

    Each task adds up its 64 x 64 counts; 4096 sums come to the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            x = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            for at in range(0, len(x), _BLOCK):
                both += x[at:at + _BLOCK].T @ x[at:at + _BLOCK]
            n += len(x)
        if n:
            cell = np.append(np.arange(4096), -1)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.append(both.ravel(), n).astype(np.int64))], ["cell", "n"])

    sums = {r[0]: r[1] for r in fps.select("fp").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect()}
    return sums.get(-1, 0), np.array([sums.get(i, 0) for i in range(4096)], dtype=float).reshape(64, 64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bit positions in ``parts`` groups of nearly equal size, correlated ones together.

    Greedy: a group starts with the strongest pair left and takes the bit with
    the largest sum of absolute correlations to it until it is full.
    """
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(64)), []
    for i in range(parts):
        size = 64 // parts + (i < 64 % parts)
        sub = corr[np.ix_(left, left)]
        a, b = divmod(int(sub.argmax()), len(left))
        group = [left[a]] if size == 1 or a == b else [left[a], left[b]]
        while len(group) < size:
            rest = [x for x in left if x not in group]
            group.append(rest[int(corr[np.ix_(rest, group)].sum(axis=1).argmax())])
        left = [x for x in left if x not in group]
        groups.append(sorted(group))
    return groups


def allocate(cost: np.ndarray, total: int) -> np.ndarray:
    """Thresholds (n, m) of least summed cost that add up to ``total``.

    ``cost[k, i, t + 1]`` is what threshold t of partition i costs row k, for t
    from -1 up. Dynamic programming over partitions and the sum so far.
    """
    n, m, levels = cost.shape
    span = m + total  # sums of (t + 1)
    best = np.full((n, span + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((n, m, span + 1), dtype=np.int8)
    for i in range(m):
        nxt = np.full_like(best, np.inf)
        for s in range(span + 1):
            for t in range(min(levels - 1, s) + 1):
                c = best[:, s - t] + cost[:, i, t]
                better = c < nxt[:, s]
                nxt[better, s] = c[better]
                choice[better, i, s] = t
        best = nxt
    out, at = np.zeros((n, m), dtype=np.int64), np.full(n, span)
    for i in range(m - 1, -1, -1):
        t = choice[np.arange(n), i, at]
        out[:, i], at = t - 1, at - t
    return out


def _near(counts: np.ndarray, bits: int, most: int) -> list[np.ndarray]:
    """For each cell, the counts in cells exactly 0, 1, ... ``most`` bits away."""
    cells = np.arange(len(counts))
    out = []
    for e in range(most + 1):
        sums = np.zeros(len(counts))
        for pick in combinations(range(bits), e):
            sums += counts[cells ^ sum(1 << b for b in pick)]
        out.append(sums)
    return out


class Plan:
    """Partitions and candidate estimates; a few hundred KB that go to every task."""

    def __init__(self, n: int, both: np.ndarray, max_bits: int = MAX_BITS, parts: int | None = None):
        self.max_bits = max_bits
        self.parts = parts or self.choose(n, max_bits)
        self.groups = group_bits(n, both, self.parts)
        self.estimates: list[np.ndarray] = []

    @staticmethod
    def choose(n: int, max_bits: int) -> int:
        """Number of partitions with the least estimated probes and candidates at even occupancy."""
        def work(m: int) -> float:
            sizes = np.array([64 // m + (i < 64 % m) for i in range(m)])
            cost = np.array([[[_ball(b, t) * (1 + n / 2.0**b) if t >= 0 else 0.0 for t in range(-1, max_bits + 1)] for b in sizes]])
            t = allocate(cost, max_bits - m + 1)[0]
            return sum(cost[0, i, x + 1] for i, x in enumerate(t)) + m
        return min(range(1, max_bits + 2), key=work)

    def values(self, fps: np.ndarray, i: int) -> np.ndarray:
        """The bits of partition i of each fingerprint, gathered into a number."""
        out = np.zeros(len(fps), dtype=np.int64)
        for j, b in enumerate(self.groups[i]):
            out |= ((fps >> b) & 1) << j
        return out

    def learn(self, fps: DataFrame) -> None:
        """Fill the estimates from histograms over the low bits of each partition's values."""
        width = [min(CELL_BITS, len(g)) for g in self.groups]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(1 << w, dtype=np.int64) for w in width]
            for batch in batches:
                x = batch.column(0).to_numpy(zero_copy_only=False)
                for i, w in enumerate(width):
                    total[i] += np.bincount(self.values(x, i) & ((1 << w) - 1), minlength=1 << w)
            for i, t in enumerate(total):
                at = np.nonzero(t)[0]
                yield pa.RecordBatch.from_arrays([pa.array((i << CELL_BITS) + at), pa.array(t[at])], ["cell", "n"])

        rows = fps.select("fp").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect()
        hist = [np.zeros(1 << w) for w in width]
        for cell, n in rows:
            hist[cell >> CELL_BITS][cell & ((1 << CELL_BITS) - 1)] = n
        for i, g in enumerate(self.groups):
            w, rest = width[i], len(g) - width[i]
            near = _near(hist[i], w, min(self.max_bits, w))
            cost = np.zeros((self.max_bits + 2, 1 << w))
            for t in range(self.max_bits + 1):
                expected = sum(near[e] * _ball(rest, t - e) / 2.0**rest for e in range(min(t, w) + 1))
                cost[t + 1] = _ball(len(g), t) + expected
            self.estimates.append(cost.astype(np.float32))

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        cost = np.stack([
            est[:, self.values(fps, i) & (est.shape[1] - 1)].T for i, est in enumerate(self.estimates)], axis=1)
        return allocate(cost.astype(float), self.max_bits - self.parts + 1)

    def key(self, i: int, values: np.ndarray) -> np.ndarray:
        """Partition and value in one number; values wider than 56 bits are mixed (the verification is on whole fingerprints)."""
        if len(self.groups[i]) > 56:
            values = (values * np.int64(-7046029254386353131)) >> 8 & ((1 << 56) - 1)
        return values | (i << 56)

    def index(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, row) of the entries under which each fingerprint is found."""
        keys = np.concatenate([self.key(i, self.values(fps, i)) for i in range(self.parts)])
        return keys, np.tile(np.arange(len(fps)), self.parts)

    def probes(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, row) of everything each fingerprint looks up."""
        t = self.thresholds(fps)
        keys, rows = [], []
        for i, g in enumerate(self.groups):
            values = self.values(fps, i)
            for e in range(int(t[:, i].max(initial=-1)) + 1):
                who = np.nonzero(t[:, i] >= e)[0]
                for pick in combinations(range(len(g)), e):
                    keys.append(self.key(i, values[who] ^ sum(1 << b for b in pick)))
                    rows.append(who)
        return (np.concatenate(keys), np.concatenate(rows)) if keys else (np.zeros(0, np.int64),) * 2


def _ball(bits: int, radius: int) -> int:
    return sum(comb(bits, e) for e in range(min(bits, radius) + 1)) if radius >= 0 else 0


def _entries(fps: DataFrame, what: str, plan: Plan, columns: list[str]) -> DataFrame:
    """(key, *columns) rows of ``plan.index`` or ``plan.probes`` for each fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = part.column(0).to_numpy(zero_copy_only=False)
                keys, rows = getattr(plan, what)(x)
                taken = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(keys), *taken.columns], ["key", *columns])

    return fps.select(*columns).mapInArrow(run, "key bigint, " + ", ".join(f"{c} bigint" for c in columns))


def links(fps: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """Links (a, b) that connect all fingerprints at most ``max_bits`` apart.

    ``fps`` has distinct ``fp`` and their row counts ``n``. Dense groups do not
    yield all their pairs: every fingerprint is first linked to the commonest
    one it shares a partition value with (if near enough), and of the rest only
    links between different such centres are kept. Candidates are compared
    inside the join, so rows come out for true links only; the adaptive
    planner splits a hot key over tasks.
    """
    n, both = bit_statistics(fps)
    if n < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    plan = Plan(n, both, max_bits, parts)
    plan.learn(fps)
    near = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= max_bits
    entries = _entries(fps, "index", plan, ["fp", "n"])
    centre = entries.groupBy("key").agg(F.max(F.struct("n", "fp")).alias("c"), F.count("*").alias("size")).where("size > 1")
    centre = centre.select("key", F.col("c.n").alias("cn"), F.col("c.fp").alias("centre"))
    star = entries.join(centre, "key").where(near("fp", "centre")).groupBy("fp").agg(F.max(F.struct("cn", "centre")).alias("c"))
    star = star.select(F.col("fp").alias("of"), F.col("c.centre").alias("centre"))
    at = saved(fps.join(star, F.col("fp") == F.col("of"), "left").select("fp", F.coalesce("centre", "fp").alias("centre")), "simhash-centres")
    data = _entries(at, "index", plan, ["fp", "centre"]).toDF("key", "y", "cy")
    probe = _entries(at, "probes", plan, ["fp", "centre"]).toDF("pkey", "x", "cx")
    found = probe.join(data, (F.col("pkey") == F.col("key")) & (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & near("x", "y"))
    return found.select(F.col("cx").alias("a"), F.col("cy").alias("b")).distinct().union(
        at.where("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b")))


def fingerprint_classes(rows: DataFrame, fp: str, doc_id: str, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """(fp, root, component_id) of every fingerprint.

    ``root`` names the component by a fingerprint, ``component_id`` is its
    smallest doc_id (null if it has none).
    """
    fps = saved(rows.groupBy(F.col(fp).alias("fp")).agg(F.count("*").alias("n"), F.min(doc_id).alias("first")), "simhash-fps")
    roots = components(links(fps, max_bits, parts))
    at = saved(fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = at.groupBy("root").agg(F.min("first").alias("component_id"))
    return at.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Needs columns doc_id and text. Null and blank texts have fingerprint 0 and
    are linked like any other. Rows with a null doc_id take part; a component
    of such rows only has a null component_id. Repeated rows come out as often
    as they go in. An empty table gives an empty result.
    """
    rows = saved(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle).select("doc_id", "fp"), "simhash-rows")
    classes = fingerprint_classes(rows, "fp", "doc_id", max_bits, parts)
    return rows.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """One row of each near-duplicate component of ``docs``, all columns as they are.

    The row with the smallest doc_id stays (null last; of rows that share it,
    one). The documents are written once with their fingerprints and shuffled
    once by row number when the rows that stay are picked.
    """
    fp, uid = internal(docs, "__fp"), internal(docs, "__uid")
    rows = saved(with_fingerprint(docs, fp, shingle).withColumn(uid, F.monotonically_increasing_id()), "simhash-docs")
    light = rows.select(F.col(fp).alias("__f"), F.col(uid).alias("__u"), F.col("doc_id").alias("__d"))
    classes = fingerprint_classes(light, "__f", "__d", max_bits, parts)
    first = F.min(F.struct(F.col("__d").isNull().alias("none"), F.col("__d").alias("d"), F.col("__u").alias("u")))
    best = light.groupBy("__f").agg(first.alias("first")).join(classes, F.col("__f") == F.col("fp"))
    stay = best.groupBy("root").agg(F.min("first").alias("first"))
    stay = saved(stay.select(F.col("first.u").alias("__stay")), "simhash-stay")
    return rows.join(stay.hint("merge"), F.col(uid) == F.col("__stay"), "left_semi").drop(fp, uid)
