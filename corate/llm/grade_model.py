"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's score is the sum of the weights of its hashed features (words,
word shapes, repetition, length), shared by all grades. Ordered thresholds
turn it into P(grade >= k) = sigmoid(score - threshold_k). The expected grade
and the tail probability of the top grade come from these.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import internal, saved, schema_of, shipped, text_bytes, with_columns

#: Rated documents the model is fitted on at most, picked by a seeded hash of their doc_ids.
MAX_RATED = 8_000
BUCKETS = 1 << 20
CACHE_WORDS = 500_000

#: Character classes of word shapes: a lower-case or other letters, A upper-case, 0 digits, # the rest.
_SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else ord("#") for b in range(256))


def _shape(word: bytes) -> bytes:
    """Classes of a word's characters, runs once."""
    s = word.translate(_SHAPE)
    return bytes(c for i, c in enumerate(s) if not i or s[i - 1] != c)


class Features:
    """Texts to distinct hashed features."""

    def __init__(self, buckets: int = BUCKETS, cache_words: int = CACHE_WORDS):
        self.buckets, self.limit, self.cache = buckets, cache_words, {}

    def _hash(self, kind: bytes, value: bytes) -> int:
        return zlib.crc32(value, zlib.crc32(kind)) % self.buckets

    def __call__(self, text: bytes) -> np.ndarray:
        words, cache = text.split(), self.cache
        distinct = set(words)
        new = [w for w in distinct if w not in cache]
        if len(cache) + len(new) > self.limit:
            cache.clear()
            new = distinct
        for w in new:
            core = w.lower().strip(b".,;:!?\"'()")
            cache[w] = (self._hash(b"word", core), _shape(w))
        shapes: dict[bytes, int] = {}
        out = set()
        for w in distinct:
            h, s = cache[w]
            out.add(h)
            shapes[s] = shapes.get(s, 0) + 1
        if distinct:
            # shares of shapes, of repeated words, and the length, in coarse steps
            out.update(self._hash(b"shape", s + b"%d" % (8 * n // len(distinct))) for s, n in shapes.items())
            out.add(self._hash(b"repeat", b"%d %d" % (10 * (len(words) - len(distinct)) // len(words), len(words).bit_length())))
        out.add(self._hash(b"length", b"%d" % len(words).bit_length()))
        return np.array(sorted(out), dtype=np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Cumulative-link model with sparse weights, fitted by FTRL-proximal steps."""

    def __init__(self, grades: int, buckets: int = BUCKETS):
        self.grades = grades
        self.weights = np.zeros(buckets, dtype=np.float32)
        self.thresholds = np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(grades - 1)

    def fit(self, rows: list[np.ndarray], grades: list[int], epochs: int = 8, alpha: float = 0.5, l1: float = 8.0, l2: float = 1.0, seed: int = 3) -> OrdinalModel:
        z, n = np.zeros(len(self.weights)), np.zeros(len(self.weights))
        order = np.random.default_rng(seed)
        theta, gsum = self.thresholds, np.full(len(self.thresholds), 1.0)

        def solved(idx: np.ndarray) -> np.ndarray:
            zi = z[idx]
            return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((1 + np.sqrt(n[idx])) / alpha + l2))

        for _ in range(epochs):
            for k in order.permutation(len(rows)):
                idx, y = rows[k], grades[k]
                w = solved(idx)
                score = w.sum()
                # likelihood of grade y: P(>= y) - P(>= y + 1)
                upper = sigmoid(score - theta[y - 1]) if y else 1.0
                lower = sigmoid(score - theta[y]) if y < self.grades - 1 else 0.0
                p = max(upper - lower, 1e-9)
                du = upper * (1 - upper) if y else 0.0
                dl = lower * (1 - lower) if y < self.grades - 1 else 0.0
                g = -np.clip((du - dl) / p, -4, 4)
                step = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / alpha
                z[idx] += g - step * w
                n[idx] += g * g
                for t, gt in ((y - 1, du / p), (y, -dl / p)):
                    if 0 <= t < len(theta):
                        gt = np.clip(gt, -4, 4)
                        gsum[t] += gt * gt
                        theta[t] -= 0.1 * gt / np.sqrt(gsum[t])
                theta[:] = np.maximum.accumulate(theta)
        self.weights[:] = solved(np.arange(len(z)))
        return self

    def tails(self, idx: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. grades - 1."""
        return sigmoid(float(self.weights[idx].sum()) - self.thresholds)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 low quality, 2 good. Null labels are left out; of several, the lowest counts."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).dropna().groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, max_rated: int = MAX_RATED, buckets: int = BUCKETS, seed: int = 3) -> OrdinalModel:
    """Model of (doc_id, grade) ``ratings`` on the texts of ``docs``.

    Of the rated doc_ids, the ``max_rated`` with the smallest seeded hashes are
    used; their features, a bounded amount, come to the driver. Rated rows
    without a document and null texts add nothing. Without ratings all weights
    are zero.
    """
    picked = ratings.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).orderBy("h", "doc_id").limit(max_rated)
    picked = saved(picked.select(F.col("doc_id").alias("rated"), "grade"), "rated")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("rated")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets)
        for batch in batches:
            found = [features(t).astype("<i4").tobytes() for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["doc_id", "grade", "features"])

    got = rows.select("doc_id", "text", F.col("grade").cast("int").alias("grade")).mapInArrow(run, "doc_id bigint, grade int, features binary").collect()
    got.sort(key=lambda r: (r[0], r[2]))
    return OrdinalModel(grades, buckets).fit([np.frombuffer(r[2], "<i4").astype(np.int64) for r in got], [r[1] for r in got], seed=seed)


def score(docs: DataFrame, model: OrdinalModel, at_least: float = 0.5) -> DataFrame:
    """``docs`` with (expected_grade, p_top, kept), underscored where names clash.

    ``kept``: the tail probability of the top grade is ``at_least``. Null texts
    are scored as empty ones. No shuffle.
    """
    names = {c: internal(docs, c) for c in ("expected_grade", "p_top", "kept")}
    shared = shipped(docs.sparkSession, (model.grades, {int(i): float(model.weights[i]) for i in np.nonzero(model.weights)[0]}, model.thresholds, len(model.weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, weights, thresholds, buckets = pickle.loads(shared.value)
        own = OrdinalModel(grades, buckets)
        own.weights[list(weights)] = list(weights.values())
        own.thresholds = thresholds
        features = Features(buckets)
        for batch in batches:
            tails = [own.tails(features(t)) for t in text_bytes(batch.column(batch.schema.get_field_index("text")))]
            top = [round(float(t[-1]), 6) for t in tails]
            yield with_columns(batch, {
                names["expected_grade"]: pa.array([round(float(t.sum()), 6) for t in tails], pa.float64()),
                names["p_top"]: pa.array(top, pa.float64()), names["kept"]: pa.array([p >= at_least for p in top], pa.bool_()),
            })

    return docs.mapInArrow(run, schema_of(docs, **dict(zip(names.values(), ("double", "double", "boolean")))))
