"""A mergeable bit filter of the pairs a job will look up.

The similarity jobs build co-rated pairs by a self-join and look up few of
them. ``build`` hashes the needed pairs into a blocked Bloom filter by
aggregation (bits are OR-ed map-side, so hot pairs cost nothing extra);
``probe`` drops the co-rating rows of other pairs before they are aggregated
and shuffled. A false positive is a pair aggregated in vain; the lookup is an
exact join and never sees it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A block is 32768 bits (4 KB); a pair sets ``HASHES`` bits of one block.
BLOCK_BITS, HASHES = 1 << 15, 2
BITS_PER_PAIR = 16
#: Filters up to this size are broadcast: the driver holds one several times
#: over. Beyond it, bits per pair shrink to ``LEAST_BITS``; beyond that, there
#: is no filter and every pair is aggregated.
MAX_BYTES = 16 << 20
LEAST_BITS = 2


class PairFilter(NamedTuple):
    blocks: DataFrame   # block, words: array<bigint>
    n_blocks: int


def n_blocks(n_pairs: int, max_bytes: int = MAX_BYTES, least_bits: int = LEAST_BITS) -> int | None:
    """Blocks for ``n_pairs``, or None where a filter of ``max_bytes`` would pass most pairs."""
    most = max_bytes * 8 // BLOCK_BITS
    if n_pairs * least_bits > most * BLOCK_BITS:
        return None
    return max(1, min(most, -(-n_pairs * BITS_PER_PAIR // BLOCK_BITS)))


def _hashes(lo: str, hi: str, blocks: int) -> tuple[Column, list[Column]]:
    """(block, bits within it) of a pair, whichever way round."""
    h = F.xxhash64(F.least(lo, hi), F.greatest(lo, hi))
    again = F.xxhash64(h)
    return F.pmod(h, F.lit(blocks)), [F.shiftright(again, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)]


def build(pairs: DataFrame, a: str, b: str, max_bytes: int = MAX_BYTES, least_bits: int = LEAST_BITS) -> PairFilter | None:
    """Filter of the unordered pairs (a, b), repeats allowed; None if it would be too large."""
    n = pairs.agg(F.approx_count_distinct(F.xxhash64(F.least(a, b), F.greatest(a, b)))).first()[0]
    blocks = n_blocks(n, max_bytes, least_bits)
    if blocks is None:
        return None
    block, bits = _hashes(a, b, blocks)
    at = pairs.select(block.alias("block"), F.explode(F.array(*bits)).alias("bit"))
    word = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int"))
    words = at.groupBy("block", F.shiftright("bit", 6).cast("int").alias("w")).agg(F.bit_or(word).alias("bits"))
    rows = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))  # 512 words at most
    every = F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))
    return PairFilter(rows.select("block", F.transform(every, lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("bigint"))).alias("words")), blocks)


def probe(rows: DataFrame, found: PairFilter, a: str, b: str) -> DataFrame:
    """``rows`` whose pair (a, b) may be in the filter: all that are, and few others."""
    block, bits = _hashes(a, b, found.n_blocks)
    ok = F.lit(True)
    for bit in bits:
        word = F.get(F.col("_words"), F.shiftright(bit, 6).cast("int"))
        ok = ok & (F.getbit(word, (bit % 64).cast("int")) == 1)
    blocks = found.blocks.select(F.col("block").alias("_block"), F.col("words").alias("_words"))
    return rows.withColumn("_at", block).join(F.broadcast(blocks), F.col("_at") == F.col("_block")).where(ok).drop("_at", "_block", "_words")
