"""Near-duplicate lines by a segment-partition edit join.

Two lines match if at most ``edits`` insertions, deletions or substitutions
turn one into the other. Cut a line into ``edits + 1`` segments: a matching
line must hold one of them unchanged, near the same place. So each distinct
line is indexed under its segments (length, segment number, text), and looks
up the few of its own substrings that can be a segment of a line of its length
or up to ``edits`` shorter (multi-match-aware selection). Pairs that share a
segment and whose letter parities allow a match are verified by a banded
bit-parallel edit distance. (Li et al., "Pass-Join", 2011; Hyyrö, 2003.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import internal, saved, text_bytes
from .graph import components

EDITS = 1
#: Lines of fewer code points match only equal lines; 1: none do.
MIN_CHARS = 1
FEW = 100_000


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of the even cut of a line into edits + 1 segments; the last ones are longer."""
    parts = edits + 1
    size, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = size + (i >= parts - longer)
        out.append((at, n))
        at += n
    return out


def probes(length: int, edits: int) -> Iterator[tuple[int, int, int, int]]:
    """(indexed length, segment, start, size) of the substrings that a line looks up."""
    for shorter in range(min(edits, length - 1) + 1):
        # a line of at most ``edits`` characters has empty segments, which every line near its length holds
        for i, (at, n) in enumerate(segments(length - shorter, edits)):
            # i edits at most before the segment, edits - i at most after it
            low = max(at - i, at + shorter - (edits - i), 0)
            high = min(at + i, at + shorter + (edits - i), length - n)
            for start in range(low, high + 1):
                yield length - shorter, i, start, n


def within(a: str, b: str, most: int) -> int | None:
    """Edit distance of a and b if it is at most ``most``, else None.

    Bit-parallel over the 2 * most + 1 cells of a column near the diagonal.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return None
    if a == b:
        return 0
    if not most:
        return None
    # equal ends don't matter
    lead = 0
    while lead < len(a) and a[lead] == b[lead]:
        lead += 1
    a, b = a[lead:], b[lead:]
    tail = 0
    while tail < len(a) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not a:
        return len(b)
    width = 2 * most + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for j, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (j + most)  # row j of the window that starts most rows above
    # column i covers rows i - most .. i + most of a; rows before its start count as -1 steps
    up, down = full & ~((1 << most) - 1), 0
    last = len(a)
    score = min(most, last)
    for i, c in enumerate(b):
        match = (where.get(c, 0) >> i) & full
        d0 = ((((match & up) + up) ^ up) | match | down) & full
        hp = (down | ~(d0 | up)) & full
        hn = d0 & up
        bottom = i + most  # row of the window's last cell
        if bottom < last:
            score += not d0 >> (width - 1) & 1
        else:
            bit = width - 2 - (bottom - last)
            if bit < 0:
                break
            score += (hp >> bit & 1) - (hn >> bit & 1)
        diag = d0 >> 1
        up, down = (hn | ~(diag | hp)) & full, diag & hp
    return score if score <= most else None


def _parities(lines: list[str]) -> np.ndarray:
    """Bit per letter class: whether a line has it an odd number of times. An edit flips two at most."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    which = np.repeat(np.arange(len(lines)) * 64, [len(x) for x in lines])
    odd = np.bincount(which + ((points * 2654435761 >> 12) & 63), minlength=64 * len(lines)) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _keys(docs: DataFrame, edits: int, min_chars: int, looked_up: bool) -> DataFrame:
    """(key, id, parity) of the segments of each line, or of the substrings it looks up.

    A line that several documents of a batch have comes out once. Lines
    shorter than ``min_chars`` are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[int, list[tuple[int, int, int, int]]] = {}
        digest, md5 = xxhash.xxh64_intdigest, hashlib.md5

        def out(lines: list[bytes]) -> pa.RecordBatch:
            texts = [x.decode() for x in lines]
            long = [k for k, x in enumerate(texts) if len(x) >= min_chars]
            texts = [texts[k] for k in long]
            ids = [md5(lines[k]).digest() for k in long]
            parity = _parities(texts)
            keys, rows = [], []
            for k, line in enumerate(texts):
                n = len(line)
                plan = plans.get(n)
                if plan is None:
                    plan = list(probes(n, edits)) if looked_up else [(n, i, a, z) for i, (a, z) in enumerate(segments(n, edits))]
                    if len(plans) < 20_000:
                        plans[n] = plan
                keys += [digest(line[a:a + z].encode(), size * 64 + i) for size, i, a, z in plan]
                rows += [k] * len(plan)
            taken = pa.array(rows, pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.array(ids, pa.binary()).take(taken), pa.array(parity, pa.int64()).take(taken),
            ], ["key", "id", "parity"])

        for batch in batches:
            seen: set[bytes] = set()
            lines: list[bytes] = []
            size = 0
            for text in text_bytes(batch.column(0)):
                for line in text.split(b"\n"):
                    if len(line) >= min_chars and line not in seen and line.strip():
                        seen.add(line)
                        lines.append(line)
                        size += len(line)
                if size > 1 << 21:
                    yield out(lines)
                    lines, size = [], 0
            if lines:
                yield out(lines)

    return docs.select("text").mapInArrow(run, "key bigint, id binary, parity bigint")


def match_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b): ids (MD5) of all pairs of different lines of ``docs`` that are at most ``edits`` apart, a < b.

    A line that many tasks have is one row per task in the exchange by key, and
    one per key after it. The adaptive planner splits a hot key of the join.
    """
    least = max(min_chars, 1)

    def once(keys: DataFrame, key: str, ident: str, parity: str) -> DataFrame:
        keys = keys.toDF(key, ident, parity)
        return keys.groupBy(key, ident, parity).agg(F.lit(1).alias("one")).drop("one")

    index = once(_keys(docs, edits, least, False), "key", "x", "px")
    look = once(_keys(docs, edits, least, True), "pkey", "y", "py")
    pairs = look.join(index, (F.col("key") == F.col("pkey")) & (F.col("x") != F.col("y"))
                      & (F.bit_count(F.col("px").bitwiseXOR(F.col("py"))) <= 2 * edits))
    pairs = saved(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "line-pairs")
    wanted = saved(pairs.select(F.explode(F.array("a", "b")).alias("want")).distinct(), "line-wanted")
    # only the texts of candidates move; their ids are broadcast if few by count
    some = wanted.count() <= FEW
    lines = _lines(docs).select(F.unhex(F.md5("line")).alias("id"), "line")
    texts = lines.join(F.broadcast(wanted) if some else wanted, F.col("id") == F.col("want"), "left_semi")
    texts = saved(texts.distinct(), "line-texts")
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [within(x, y, edits) is not None for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(verify, "a binary, b binary")


def _lines(docs: DataFrame, *columns: str) -> DataFrame:
    """One row per line that has more than white space."""
    out = docs.select(*columns, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("no", "line"))
    return out.where(F.translate("line", " \t\x0b\x0c\r", "") != "")


def duplicate_lines(docs: DataFrame, uid: str, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(uid, no, first, links) of every line with a word in it.

    ``first``: no line of its class comes before it, by doc_id (null last),
    ``uid`` and line number. A class is what equal lines and matches connect.
    ``links``: other distinct lines that match the line.
    """
    ident = F.unhex(F.md5("line"))
    links = saved(match_lines(docs, edits, min_chars), "line-links")
    roots = saved(components(links), "line-roots")
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    known = saved(roots.join(degree, "node"), "line-known")
    at = _lines(docs, "doc_id", uid).select("doc_id", F.col(uid).alias("uid"), "no", ident.alias("id"))
    few = known.count() <= FEW
    at = at.join(F.broadcast(known) if few else known, F.col("id") == F.col("node"), "left")
    at = saved(at.select("doc_id", "uid", "no", F.coalesce("root", "id").alias("class"), F.coalesce("links", F.lit(0)).alias("links")), "line-places")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("d"), F.col("uid").alias("u"), F.col("no").alias("no"))
    first = at.groupBy("class").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("class").alias("of"), F.col("least.u").alias("u"), F.col("least.no").alias("fno"))
    out = at.join(first, F.col("class") == F.col("of"), "left")
    return out.select("uid", "no", (F.col("of").isNull() | ((F.col("uid") == F.col("u")) & (F.col("no") == F.col("fno")))).alias("first"), "links")


def deduplicate_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, text: bool = True) -> DataFrame:
    """``docs`` with repeated lines taken out, and (n_lines, n_removed, n_links).

    Needs columns doc_id and text. The first line of each class stays where it
    is, later ones go; blank lines and lines without a class stay. ``n_lines``
    counts lines with a word in them, ``n_links`` the matches of its lines.
    Null texts stay null; repeated rows lose the lines of the first of them;
    null doc_ids come last. Added names get underscores where they clash. With
    ``text=False`` only doc_id and the counts come out and no text is joined.
    """
    uid = internal(docs, "__uid")
    names = {c: internal(docs, c) for c in ("n_lines", "n_removed", "n_links")}
    rows = docs.withColumn(uid, F.monotonically_increasing_id())
    rows = saved(rows if text else rows.select("doc_id", "text", uid), "line-docs")
    places = duplicate_lines(rows, uid, edits, min_chars)
    per = places.groupBy("uid").agg(
        F.count("*").alias("n"), F.sum("links").alias("l"), F.collect_list(F.when(~F.col("first"), F.col("no"))).alias("gone"))
    per = per.select(F.col("uid").alias("__u"), "n", "l", "gone")
    base = rows if text else rows.select("doc_id", uid)
    out = base.join(per, F.col(uid) == F.col("__u"), "left")
    counts = [F.coalesce("n", F.lit(0)).cast("bigint").alias(names["n_lines"]),
              F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias(names["n_removed"]),
              F.coalesce("l", F.lit(0)).cast("bigint").alias(names["n_links"])]
    if not text:
        return out.select("doc_id", *[F.greatest(c, F.lit(0)).alias(n) for c, n in zip(counts, names.values())])
    kept = F.when(F.coalesce(F.size("gone"), F.lit(0)) <= 0, F.col("text")).otherwise(F.array_join(
        F.transform(F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                             lambda s: ~F.array_contains("gone", s["i"])), lambda s: s["x"]), "\n"))
    return out.select(*[kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                      *[F.greatest(c, F.lit(0)).alias(n) for c, n in zip(counts, names.values())])
