"""Exact Pearson correlation of dealt co-rating rows, summed in numpy by each task.

The rows of a task come in order of their first member and are taken a chunk
at a time. On sparse data most pairs have one row: their correlation is 0 and
nothing is summed for them. The sums of ``functions.exact.ExactMoments`` are
made for the others, as whole numbers, so results are the same however rows
are dealt. A first member that goes on in the next chunk keeps its sums until
it ends: a task holds a chunk and the pairs of one first member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.functions.exact import LIMB

#: Co-rating rows that a task sums at once.
CHUNK = 1 << 18
_MASK = (1 << LIMB) - 1


def _limbs(x: np.ndarray, top: int) -> list[np.ndarray]:
    """As ``exact.limbs`` with two limbs; a value that is missing counts as 0."""
    rest = np.abs(np.nan_to_num(x)) * 2.0 ** (LIMB - top)
    high = np.floor(rest)
    low = np.floor((rest - high) * 2.0**LIMB)
    return [np.where(x < 0, -limb, limb).astype(np.int64) for limb in (low, high)]


def _product(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    low, mid, high = a[0] * b[0], a[0] * b[1] + a[1] * b[0], a[1] * b[1]
    return [low & _MASK, (low >> LIMB) + (mid & _MASK), (mid >> LIMB) + (high & _MASK), high >> LIMB]


def _carried(digits: list[np.ndarray]) -> list[np.ndarray]:
    carry, out = np.zeros_like(digits[0]), []
    for x in digits:
        x = carry + x
        carry = x >> LIMB
        out.append(x & _MASK)
    return [*out, carry]


def _as_double(digits: list[np.ndarray]) -> np.ndarray:
    def size(d: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(d[0]))
        for x in reversed(d):
            out = out * 2.0**LIMB + x
        return out

    d = _carried(digits)
    return np.where(d[-1] < 0, -size(_carried([-x for x in d])), size(d))


def correlation(n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """As ``ExactMoments.finish``, from the 16 sums of each pair (sums by pair)
    and the number of its rows with both values: without any, the sum of products is null."""
    x, y = _carried(list(sums[0:2])), _carried(list(sums[2:4]))

    def centred(both: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        limbs = [n * p for p in _carried(list(both))]
        for d in range(5):
            for i in range(3):
                if 0 <= d - i < 3:
                    limbs[d] = limbs[d] - a[i] * b[d - i]
        return _as_double(limbs)

    num, vx, vy = centred(sums[4:8], x, y), centred(sums[8:12], x, x), centred(sums[12:16], y, y)
    some = (n > 1) & (sums[16] > 0) & (num != 0) & (vx > 0) & (vy > 0)
    return np.where(some, num, 0.0) / np.where(some, np.sqrt(np.abs(vx)) * np.sqrt(np.abs(vy)), 1.0)


def _groups(m1: np.ndarray, m2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by pair, where each pair begins in it)."""
    order = np.lexsort((m2, m1))
    a, b = m1[order], m2[order]
    return order, np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))


def pair_correlations(chunks: Iterator[tuple[np.ndarray, ...]], top: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(m1, m2, n, correlation) of each pair of the rows (m1, m2, x, y, both values are there), in order of m1."""
    held: tuple[np.ndarray, ...] | None = None  # m1, m2, n, sums of the first member that may go on

    def out(m1: np.ndarray, m2: np.ndarray, n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, ...]:
        return m1, m2, n, correlation(n, sums)

    for m1, m2, x, y, both in chunks:
        order, start = _groups(m1, m2)
        n = np.diff(np.append(start, len(order)))
        one, two = m1[order[start]], m2[order[start]]
        if held is not None and held[0][0] != one[0]:
            yield out(*held)
            held = None
        alone = (n == 1) & (one != m1[-1]) & (one != m1[0])
        yield one[alone], two[alone], n[alone], np.zeros(int(alone.sum()))
        one, two, rows = one[~alone], two[~alone], order[np.repeat(~alone, n)]
        n = n[~alone]
        a, b = _limbs(x[rows], top), _limbs(y[rows], top)
        first = np.cumsum(n) - n
        sums = np.array([np.add.reduceat(v, first) for v in [*a, *b, *_product(a, b), *_product(a, a), *_product(b, b), both[rows].astype(np.int64)]])
        if held is not None:
            one, two, n, sums = (np.concatenate([h, v], axis=-1) for h, v in zip(held, (one, two, n, sums)))
            order, start = _groups(one, two)
            one, two, n = one[order[start]], two[order[start]], np.add.reduceat(n[order], start)
            sums = np.add.reduceat(sums[:, order], start, axis=1)
        last = one == m1[-1]
        yield out(one[~last], two[~last], n[~last], sums[:, ~last])
        held = one[last], two[last], n[last], sums[:, last]
    if held is not None:
        yield out(*held)


def exact_pearson(rows: DataFrame, top: int, chunk: int = CHUNK) -> DataFrame:
    """(m1, m2, n_corated, sim) of the rows (m1, m2, v_1, v_2), where a pair's
    rows are in one partition and partitions are in order of m1."""
    kind = {c: rows.schema[c].dataType.simpleString() for c in ("m1", "m2")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks() -> Iterator[tuple[np.ndarray, ...]]:
            kept, n = [], 0
            for batch in batches:
                if batch.num_rows:
                    both = pc.and_(batch.column(2).is_valid(), batch.column(3).is_valid())
                    kept.append([c.to_numpy(zero_copy_only=False) for c in (*batch.columns, both)])
                n += batch.num_rows
                if n >= chunk:
                    yield tuple(map(np.concatenate, zip(*kept)))
                    kept, n = [], 0
            if n:
                yield tuple(map(np.concatenate, zip(*kept)))

        for found in pair_correlations(chunks(), top):
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["m1", "m2", "n_corated", "sim"])

    values = [F.col(c).cast("double").alias(c) for c in ("v_1", "v_2")]
    return rows.select("m1", "m2", *values).mapInArrow(run, f"m1 {kind['m1']}, m2 {kind['m2']}, n_corated bigint, sim double")
