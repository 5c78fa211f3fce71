"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of documents of about ``SHARD_WORDS`` words, indexed as one
sequence of word numbers. Words that no benchmark text has, and the ends of
documents, are separators: each is a symbol of its own, so no phrase spans
one and suffix sorting ends there. The index is the Burrows-Wheeler transform
in a wavelet matrix with rank blocks, and a sample of suffix positions. All
phrases of the benchmark are searched backwards at once, their occurrences
located by stepping back to a sampled position, and merged to spans.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import internal, schema_of, shipped, text_bytes, with_columns

WINDOW = 13
#: Contaminated: at least one word in ONE_IN is hit.
ONE_IN = 20
SHARD_WORDS = 1 << 20
#: Every so many words of a run between separators, a suffix position is kept.
SAMPLE_EVERY = 16
#: Text bytes of the benchmark searched in one pass over the documents; more are searched in further passes.
BLOCK_BYTES = 2 << 20

#: Lower-case A-Z; digits, letters and all bytes of other scripts are words, the rest separates.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Phrases:
    """Search phrases of a block of benchmark items, as word numbers from 1 up."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if ids:
                for i in range(max(1, len(ids) - window + 1)):
                    found[tuple(ids[i:i + window])].add(item)
        phrases = sorted(found)
        self.items = [sorted(found[p], key=lambda x: (x is not None, x)) for p in phrases]
        self.length = np.array([len(p) for p in phrases], dtype=np.int64)
        self.table = np.zeros((len(phrases), window), dtype=np.int32)  # last word first
        for i, p in enumerate(phrases):
            self.table[i, :len(p)] = p[::-1]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes still tied are sorted again."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    ordered = rank[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    # a suffix's rank: the first row of the suffixes it ties with
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = starts
    span = 1
    last = np.concatenate([first[1:], [True]])
    rows = np.nonzero(~(first & last))[0]
    while len(rows):
        at = order[rows]
        after = at + span
        tail = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + tail
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[rows] = at  # tied suffixes fill adjoining rows, and keys ascend with rows
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(new, rows, 0))
        alone = new & np.concatenate([new[1:], [True]])
        rows = rows[~alone]
        span *= 2
    return order


class Bits:
    """A bit sequence with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.upto[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """Wavelet matrix: access and rank of symbols below 2**levels."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.rows, self.zeros = levels, [], []
        for b in range(levels - 1, -1, -1):
            bits = (symbols >> b) & 1 == 1
            self.rows.append(Bits(bits))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
            self.zeros.append(int(len(bits) - bits.sum()))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low = np.zeros_like(at)
        for k, (row, zeros) in enumerate(zip(self.rows, self.zeros)):
            one = (symbol >> (self.levels - 1 - k)) & 1 == 1
            r_at, r_low = row.rank(at).astype(np.int64), row.rank(low).astype(np.int64)
            at, low = np.where(one, zeros + r_at, at - r_at), np.where(one, zeros + r_low, low - r_low)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for row, zeros in zip(self.rows, self.zeros):
            one = row.get(at)
            r = row.rank(at).astype(np.int64)
            at = np.where(one, zeros + r, at - r)
            out = out * 2 + one
        return out


class FMIndex:
    """FM-index of a sequence of word numbers; 0 separates."""

    def __init__(self, ids: np.ndarray, vocabulary: int):
        ids = np.concatenate([ids, [0]])
        here = np.arange(len(ids))
        breaks = np.nonzero(ids == 0)[0]
        # the k-th separator is symbol k, words come after all of them
        symbols = ids + (len(breaks) - 1)
        symbols[breaks] = np.arange(len(breaks))
        order = suffix_order(symbols)
        self.before = Wavelet(ids[order - 1], max(1, int(vocabulary).bit_length()))
        self.count = np.bincount(ids, minlength=vocabulary + 1)
        self.first = np.cumsum(self.count) - self.count  # first row of the suffixes that start with a word
        # sampled: every separator, the word after it, and every SAMPLE_EVERY-th word after that
        since = here - np.maximum.accumulate(np.where(ids == 0, here, -1)) - 1
        kept = ((since % SAMPLE_EVERY == 0) | (ids == 0))[order]
        self.kept, self.sample = Bits(kept), order[kept]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high): the rows of each phrase that occurs."""
        who, word = np.arange(len(phrases.length)), phrases.table[:, 0]
        low = self.first[word]
        high = low + self.count[word]
        done = []
        for step in range(1, phrases.table.shape[1] + 1):
            alive = high > low
            ended = alive & (phrases.length[who] == step)
            done.append((who[ended], low[ended], high[ended]))
            going = alive & ~ended
            who, low, high = who[going], low[going], high[going]
            if not len(who):
                break
            word = phrases.table[who, step]
            low, high = (self.first[word] + self.before.rank(word, x) for x in (low, high))
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by steps back to a sampled one."""
        out = np.empty(len(rows), dtype=np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            kept = self.kept.get(rows)
            out[left[kept]] = self.sample[self.kept.rank(rows[kept])] + steps
            left, rows = left[~kept], rows[~kept]
            word = self.before.access(rows)
            rows = self.first[word] + self.before.rank(word, rows)
            steps += 1
        return out


def occurrences(ids: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(position, phrase) of every occurrence in a sequence of word numbers."""
    index = FMIndex(ids, len(phrases.vocabulary))
    who, low, high = index.search(phrases)
    many = high - low
    rows = np.arange(many.sum()) + np.repeat(low - (np.cumsum(many) - many), many)
    return index.locate(rows), np.repeat(who, many)


def _merge(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of spans as ascending disjoint spans; touching ones are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(start.tolist(), end.tolist())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search_shards(texts: Iterator[bytes], phrases: Phrases) -> Iterator[tuple[int, list[tuple[int, int]], list]]:
    """(words, hit spans, items) of each text; indexes shards of about ``SHARD_WORDS`` words."""
    get = phrases.vocabulary.get

    def shard(docs: list[np.ndarray]) -> Iterator[tuple[int, list[tuple[int, int]], list]]:
        sizes = np.array([len(d) for d in docs])
        starts = np.cumsum(sizes + 1) - sizes - 1
        ids = np.zeros(int(sizes.sum()) + len(docs), dtype=np.int64)
        for at, d in zip(starts.tolist(), docs):
            ids[at:at + len(d)] = d
        where, phrase = occurrences(ids, phrases) if len(phrases.length) else (np.zeros(0, np.int64),) * 2
        doc = np.searchsorted(starts, where, side="right") - 1
        by = np.argsort(doc, kind="stable")
        where, phrase, doc = where[by], phrase[by], doc[by]
        cut = np.searchsorted(doc, np.arange(len(docs) + 1))
        for k, n in enumerate(sizes.tolist()):
            if cut[k] == cut[k + 1]:
                yield n, [], []
                continue
            p, at = phrase[cut[k]:cut[k + 1]], where[cut[k]:cut[k + 1]] - starts[k]
            items = {i for x in np.unique(p).tolist() for i in phrases.items[x]}
            yield n, _merge(at, at + phrases.length[p]), sorted(i for i in items if i is not None)

    docs, total = [], 0
    for text in texts:
        words = words_of(text)
        docs.append(np.array([get(w, 0) for w in words], dtype=np.int32))
        total += len(words) + 1
        if total >= SHARD_WORDS:
            yield from shard(docs)
            docs, total = [], 0
    if docs:
        yield from shard(docs)


_FOUND = {"words": "bigint", "spans": "array<struct<start:bigint,end:bigint>>", "items": "array<bigint>"}


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its word count, hit word spans and items; and the names of these columns.

    Needs columns text, and item_id and text of ``benchmark``. A phrase is
    ``window`` consecutive words of an item, or a shorter item whole. Null
    texts have no words. Items with a null item_id hit words but are not
    listed; repeated items count once. The documents are not shuffled. The
    phrases go to the tasks in blocks of about ``block_bytes`` of benchmark
    text, one pass over the documents for each.
    """
    spark = docs.sparkSession
    names = {c: internal(docs, f"__{c}") for c in _FOUND}
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    pieces = benchmark.select(F.col("item_id").cast("bigint"), "text").withColumn("b", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    columns, schema = list(docs.columns), schema_of(docs, **{names[c]: kind for c, kind in _FOUND.items()})
    out = docs
    for block in range(blocks):
        rows = pieces.where(F.col("b") == block).collect()  # a block of bounded size
        shared = shipped(spark, Phrases([(r[0], (r[1] or "").encode()) for r in rows], window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, more=bool(block)) -> Iterator[pa.RecordBatch]:
            phrases = pickle.loads(shared.value)
            for batch in batches:
                texts = text_bytes(batch.column(batch.schema.get_field_index("text")))
                words, spans, items = map(list, zip(*search_shards(texts, phrases))) if batch.num_rows else ([], [], [])
                if more:
                    old = [batch.column(batch.schema.get_field_index(names[c])).to_pylist() for c in ("spans", "items")]
                    for k, (s, i) in enumerate(zip(*old)):
                        if s:
                            both = [(x["start"], x["end"]) for x in s] + spans[k]
                            spans[k] = _merge(*np.array(both).T)
                        items[k] = sorted({*i, *items[k]})
                yield with_columns(batch, {
                    names["words"]: pa.array(words, pa.int64()),
                    names["spans"]: pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    names["items"]: pa.array(items, pa.list_(pa.int64())),
                }, columns)

        out = out.mapInArrow(run, schema)
    return out, names


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """``docs`` with (n_words, n_hit, spans, items, contaminated), underscored where names clash."""
    found, at = find(docs, benchmark, window)
    n_hit = F.aggregate(at["spans"], F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    new = {c: internal(docs, c) for c in ("n_words", "n_hit", "spans", "items", "contaminated")}
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(at["words"]).alias(new["n_words"]), n_hit.alias(new["n_hit"]),
        F.col(at["spans"]).alias(new["spans"]), F.col(at["items"]).alias(new["items"]),
        ((n_hit > 0) & (one_in * n_hit >= F.col(at["words"]))).alias(new["contaminated"]),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns as they are."""
    judged = hits(docs, benchmark, window, one_in)
    return judged.where(~F.col(judged.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])
