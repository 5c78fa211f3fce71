"""Token ids in binary shards with a minimal perfect hash index.

A store is a folder of shard files. Shards follow each other by ascending
doc_id; each file holds, little-endian:

    64 bytes   header: magic, id width in bytes, documents, null keys, keys,
               hash levels, shard number, ids
    ids        the raw id payload, document after document
    offsets    documents + 1 numbers: where each document's ids start
    keys       doc_id of each document that has one, in order
    index      a minimal perfect hash over the distinct doc_ids (bit arrays by
               level), and for each of its slots a 32-bit fingerprint of the
               key and the key's first document

A key is hashed level by level until its bit is set; the bit's rank is its
slot. The fingerprint tells keys that are not in the shard (but for one in
2**32). A lookup touches a handful of numbers, whatever the shard's size.
(Limasset et al., "Fast and scalable minimal perfect hashing", 2017.)

The files are written and read by Spark's own writers and readers, so a store
can be in any folder that Spark reaches, and a repeated task leaves one copy.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import saved, shared_path, worker_cache

END_ID = 1
#: Text bytes per shard; a task holds one shard in memory.
SHARD_BYTES = 4 << 20
#: Distinct words that a worker keeps encoded (some 140 MB), and text bytes it splits at a time.
CACHE_WORDS, CHUNK = 1_000_000, 1 << 20
GAMMA = 2.0
_MAGIC, _HEADER = b"IDSHARD1", "<8sIIIIIIQ"
_HEADER_BYTES = 64


class WordEncoder:
    """Texts to id bytes, each distinct word encoded once.

    Two properties of the tokenizer are used if it has them, found by probes:
    white space separates and is dropped (words can be encoded alone), and
    ASCII punctuation after an ASCII letter or digit is a piece of its own,
    letters' case aside (``The,`` is ``the`` and ``,``). Otherwise whole texts
    or whole words are encoded. Encoded words are kept, up to about ``words``
    of them.
    """

    ENDS = b".,;:!?$%&*#|"
    #: Stands between pieces that are encoded in one call.
    MARK = "\x01"

    def __init__(self, tokenizer_json: str, words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.width = 2 if max(self.tokenizer.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4
        self.limit, self.words = words, {}
        ids = lambda *parts: [i for p in parts for i in self._encode([p])[0]]
        ends = self.ENDS.decode()
        self.by_word = ids("ab cd\n\tef,") == ids("ab", "cd", "ef,") and ids(" ") == []
        self.by_piece = self.by_word and ids("ABc") == ids("abc") and all(
            ids(f"{w}{e}{f}") == ids(w, e + f) for w in ("abc", "ab7", "\u00e9l") for e in ends for f in ("", *ends))
        mark = ids(self.MARK)
        self.mark = mark[0] if len(mark) == 1 and self.by_word and ids(f"a {self.MARK} b") == ids("a", self.MARK, "b") else None
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # texts that may hold a special token, whose case matters, or the mark: their words are encoded alone
        self.alone = sorted({x[:2].encode() for x in specials if x} | {self.MARK.encode()})
        # tokens that end a word, if the vocabulary marks them
        suffix = json.loads(tokenizer_json)["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix and self.by_piece:
            self.ends = np.zeros(1 << 16 if self.width == 2 else 1 + max(self.tokenizer.get_vocab().values()), dtype=bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, dtype=f"<u{self.width}").tobytes()

    def _joined(self, pieces: list[bytes], into: dict[bytes, bytes], between: str, last_of_word: bool) -> list[bytes]:
        """Pieces encoded in one call and cut apart again; those left over if the cuts don't fit."""
        left: list[bytes] = []
        w = self.width
        groups = [pieces[at:at + 1000] for at in range(0, len(pieces), 1000)]
        for group in groups:  # a call each: encodings are large objects
            ids = np.array(self._encode([between.join([p.decode() for p in group])])[0], dtype=f"<u{w}")
            at = np.nonzero(self.ends[ids] if last_of_word else ids == self.mark)[0]
            starts, stops = ([0, *(at[:-1] + 1)], at + 1) if last_of_word else ([0, *(at + 1)], [*at, len(ids)])
            if len(stops) != len(group) or last_of_word and (not len(at) or at[-1] + 1 != len(ids)):
                left += group
                continue
            data = ids.tobytes()
            into.update(zip(group, [data[a * w:b * w] for a, b in zip(map(int, starts), map(int, stops))]))
        return left

    def _learn(self, new: list[bytes], into: dict[bytes, bytes]) -> None:
        """Encode ``new`` pieces, many in one call where the tokenizer allows."""
        if self.ends is not None:
            # letters only are one word of the vocabulary, so its word-end tokens separate them
            letters = [p for p in new if p.decode().isalpha()]
            rest = set(new).difference(letters)
            new = [*rest, *self._joined(letters, into, " ", True)]
        if self.mark is not None:
            new = self._joined(new, into, f" {self.MARK} ", False)
        for at in range(0, len(new), 1000):
            part = new[at:at + 1000]
            into.update(zip(part, map(self._bytes, self._encode([p.decode() for p in part]))))

    def _one_by_one(self, words: list[bytes]) -> bytes:
        distinct = list(set(words))
        found = dict(zip(distinct, map(self._bytes, self._encode([w.decode() for w in distinct]))))
        return b"".join(map(found.__getitem__, words))

    def _meet(self, new: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not in the cache; they are put there while it has room."""
        cache, found = self.words, {}
        wanted, pairs = new, []
        if self.by_piece:
            wanted = set()
            for w in new:
                core = w.rstrip(self.ENDS)
                if len(core) == len(w) or not core[-1:].isalnum():
                    wanted.add(w)
                else:
                    pairs.append((w, core, w[len(core):]))
            wanted.update(p for _, *parts in pairs for p in parts if p not in cache)
        self._learn(list(wanted), found)
        for w, core, end in pairs:
            found[w] = (found[core] if core in found else cache[core]) + (found[end] if end in found else cache[end])
        if len(cache) < self.limit:  # a full cache is left as it is: what was met first holds the common words
            cache.update(found)
        return found

    def __call__(self, column: pa.Array) -> list[bytes]:
        """The id bytes of each text; null reads as empty."""
        texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
        if not self.by_word:
            return [self._bytes(self._encode([t.decode()])[0]) for t in texts]
        out, at = [], 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and size < CHUNK:
                size += len(texts[to])
                to += 1
            # one look-up a word; what is missing in the chunk is encoded together
            get, part, new = self.words.get, [], set()
            for text in texts[at:to]:
                if any(x in text for x in self.alone):
                    part.append(([], [self._one_by_one(text.split())]))
                    continue
                words = (text.lower() if self.by_piece else text).split()
                ids = list(map(get, words))
                if None in ids:
                    new.update([w for w, i in zip(words, ids) if i is None])
                part.append((words, ids))
            found = self._meet(new)
            for words, ids in part:
                out.append(b"".join([found[w] if i is None else i for w, i in zip(words, ids)] if None in ids else ids))
            at = to
        return out


def worker_encoder(tokenizer_json: str) -> WordEncoder:
    """The encoder of this worker process, one at a time: a tokenizer takes half a
    second and some 50 MB to make, which the process does not get back."""
    held, key = worker_cache("token encoder"), zlib.crc32(tokenizer_json.encode())
    if key not in held:
        held.clear()
        held[key] = WordEncoder(tokenizer_json)
    return held[key]


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Splitmix64 of unsigned keys; one-to-one for each seed."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct unsigned 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # 64-bit words of set bits
        ranks, total = [], 0
        for words in levels:
            upto = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            ranks.append(total + np.concatenate([[0], upto[:-1]]).astype(np.int64))
            total += int(upto[-1]) if len(upto) else 0
        self.ranks, self.size = ranks, total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            words = max(1, -(-int(GAMMA * len(keys)) // 64))
            at = _mix(keys, len(levels)) % np.uint64(words * 64)
            times = np.bincount(at.astype(np.int64), minlength=words * 64)
            levels.append(np.packbits(times == 1, bitorder="little").view("<u8"))
            keys = keys[times[at.astype(np.int64)] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some keys that were not built in (others get any slot)."""
        out, left = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for i, words in enumerate(self.levels):
            if not len(left):
                break
            at = _mix(keys[left], i) % np.uint64(len(words) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[left[hit]] = self.ranks[i][word[hit]] + below
            left = left[~hit]
        return out


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1000) >> np.uint64(32)).astype("<u4")


def pack_shard(number: int, keys: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One shard file's bytes; ``keys`` ascending, nulls first."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], dtype="<i8")
    distinct, first = np.unique(known, return_index=True)
    index = PerfectHash.build(distinct.view(np.uint64))
    slots = index.slots(distinct.view(np.uint64))
    prints, firsts = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slots], firsts[slots] = _fingerprints(distinct.view(np.uint64)), first + nulls
    offsets = np.concatenate([[0], np.cumsum([len(x) // width for x in ids])]).astype("<u8")
    header = struct.pack(_HEADER, _MAGIC, width, len(keys), nulls, len(distinct), len(index.levels), number, int(offsets[-1]))
    payload = b"".join(ids)
    return b"".join([
        header.ljust(_HEADER_BYTES, b"\0"), payload, b"\0" * (-len(payload) % 8), offsets.tobytes(), known.tobytes(),
        np.array([len(x) for x in index.levels], dtype="<u8").tobytes(), *[x.astype("<u8").tobytes() for x in index.levels],
        prints.tobytes(), firsts.tobytes(),
    ])


class Shard:
    """A shard file's bytes, opened for keyed access."""

    def __init__(self, data: bytes):
        magic, self.width, self.docs, self.nulls, keys, levels, self.number, self.n_ids = struct.unpack_from(_HEADER, data)
        if magic != _MAGIC:
            raise ValueError("not a shard file")
        at = _HEADER_BYTES

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.ids = take(f"<u{self.width}", self.n_ids)
        at += -self.ids.nbytes % 8
        self.offsets = take("<u8", self.docs + 1).astype(np.int64)
        self.keys = take("<i8", self.docs - self.nulls)
        self.index = PerfectHash([take("<u8", n) for n in take("<u8", levels).tolist()])
        self.prints, self.firsts = take("<u4", keys), take("<u4", keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first document of each key, through the hash index; -1 if it is not here."""
        keys = np.ascontiguousarray(keys, dtype="<i8").view(np.uint64)
        slots = self.index.slots(keys)
        ok = slots >= 0
        ok[ok] = self.prints[slots[ok]] == _fingerprints(keys[ok])
        out = np.full(len(keys), -1, dtype=np.int64)
        out[ok] = self.firsts[slots[ok]]
        return out

    def document(self, nth: int) -> np.ndarray:
        return self.ids[self.offsets[nth]: self.offsets[nth + 1]]


def write_store(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write them as a store at ``path``.

    Each document's ids are followed by ``end_id``; null and empty texts have
    that id only. Documents are in ascending doc_id order, null doc_ids first;
    rows that share a doc_id follow each other in an order fixed by their
    texts. One shuffle deals the texts by ranges of doc_id into shards of about
    ``shard_bytes`` of text; a doc_id of many different texts may span shards.
    An empty table writes a store without shards.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    rows = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.col("h"))
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", F.octet_length("text"))
    shared = spark.sparkContext.broadcast(tokenizer_json)  # a vocabulary file, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, keys, ids = None, [], []
        for batch in batches:
            encode = encode or worker_encoder(shared.value)
            end = np.array([end_id], dtype=f"<u{encode.width}").tobytes()
            for at in range(0, batch.num_rows, 256):  # a few rows at a time: copies of a whole batch of texts are large
                part = batch.slice(at, 256)
                keys += part.column(0).to_pylist()
                ids += [x + end for x in encode(part.column(1))]
        if keys:
            data = pack_shard(TaskContext.get().partitionId(), keys, ids, encode.width)
            yield pa.RecordBatch.from_arrays([pa.array([data], type=pa.binary())], ["data"])

    # a binary value cast to string keeps its bytes; the writer adds one line end after the file's data
    rows.mapInArrow(run, "data binary").select(F.col("data").cast("string")).write.text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("content")


def read_store(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(shard, nth, doc_id, local_start, n_tokens, ids or ids_crc32) of every document.

    Every key goes through the shard's hash index; what it finds is what is
    returned. ``digest`` gives the CRC-32 of the ids as unsigned 32-bit
    numbers in place of the ids.
    """
    last = "ids_crc32 bigint" if digest else "ids array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                shard = Shard(data.as_py())
                first = shard.find(shard.keys)
                if (first < 0).any():
                    raise ValueError("a key is missing from its shard's index")
                # a key's later documents follow its first one
                n = len(shard.keys)
                later = np.arange(n) - np.searchsorted(shard.keys, shard.keys)
                nth = np.concatenate([np.arange(shard.nulls), first + later]).astype(np.int64)
                start, size = shard.offsets[nth], shard.offsets[nth + 1] - shard.offsets[nth]
                wide = shard.ids.astype("<u4")
                for at in range(0, len(nth), 10_000 if digest else 100):
                    cut = slice(at, at + (10_000 if digest else 100))
                    spans = list(zip(start[cut].tolist(), size[cut].tolist()))
                    out = [zlib.crc32(wide[a:a + k]) for a, k in spans] if digest else [wide[a:a + k].astype(np.int64) for a, k in spans]
                    ids = [None if i < shard.nulls else int(shard.keys[i - shard.nulls]) for i in range(len(nth))[cut]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(ids), shard.number, np.int64)), pa.array(nth[cut]), pa.array(ids, pa.int64()),
                        pa.array(start[cut]), pa.array(size[cut]), pa.array(out, pa.int64() if digest else pa.list_(pa.int64())),
                    ], ["shard", "nth", "doc_id", "local_start", "n_tokens", last.split()[0]])

    return _files(spark, path).mapInArrow(run, f"shard bigint, nth bigint, doc_id bigint, local_start bigint, n_tokens bigint, {last}")


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) of each document whose doc_id is in ``keys``, once per stored document.

    Keys are dealt to the shards whose range holds them (a table of one row
    per shard) and meet the shard's file; null keys find nothing.
    """
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(s.number, int(s.keys[0]), int(s.keys[-1])) for s in (Shard(x.as_py()) for x in batch.column(0)) if len(s.keys)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*got) if got else ([], [], []))], ["shard", "low", "high"])

    bounds = saved(_files(spark, path).mapInArrow(ranges, "shard bigint, low bigint, high bigint"), "store-ranges")
    wanted = keys.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    dealt = wanted.join(F.broadcast(bounds), (F.col("doc_id") >= F.col("low")) & (F.col("doc_id") <= F.col("high")))
    dealt = dealt.groupBy("shard").agg(F.sort_array(F.collect_list("doc_id")).alias("wanted"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array([Shard(x.as_py()).number], pa.int64()), pa.array([x.as_py()], pa.binary())], ["shard", "content"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, want in zip(batch.column(0), batch.column(1)):
                shard, ids, out = Shard(data.as_py()), [], []
                want = np.array(want.as_py(), dtype=np.int64)
                for key, nth in zip(want.tolist(), shard.find(want).tolist()):
                    while 0 <= nth < shard.docs and shard.keys[nth - shard.nulls] == key:
                        ids.append(key)
                        out.append(shard.document(nth).astype(np.int64))
                        nth += 1
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "ids"])

    files = _files(spark, path).mapInArrow(number, "shard bigint, content binary")
    return files.join(dealt, "shard").select("content", "wanted").mapInArrow(find, "doc_id bigint, ids array<bigint>")


def store_digest(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` as a store, read it back: (doc_id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all documents before, over all shards.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "store")
    with open(tokenizer_path, encoding="utf-8") as f:
        write_store(docs, path, f.read())
    rows = saved(read_store(spark, path, digest=True), "store-rows")
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = F.coalesce(F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", before.alias("before"))
    return rows.join(shards, "shard").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
