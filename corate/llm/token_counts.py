"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces need, in the plain way, a new search from
each piece's end. Here the vocabulary is a trie with failure links: where a
match cannot go on, the link leads to the state that remains after the pieces
before it are popped, and the number of these pieces is stored with the link.
One pass over a word's characters then adds up the counts; no piece is built.
(Song et al., "Fast WordPiece Tokenization", 2021.)
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import internal, schema_of, shipped, text_bytes, with_columns

#: Distinct words a task keeps counted before it starts afresh.
CACHE_WORDS = 500_000
WORD_START = "▁"


class Automaton:
    """Counts greedy longest-match pieces of a word.

    ``first`` are the pieces a word can start with, ``rest`` those that can
    follow. A word that cannot be cut that way is one unknown token.
    """

    def __init__(self, first: Iterable[str], rest: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]  # state 0 starts a word, state 1 goes on after a piece
        whole = {}
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                at = root
                for c in piece:
                    if c not in self.next[at]:
                        self.next[at][c] = len(self.next)
                        self.next.append({})
                    at = self.next[at][c]
                if at != root:
                    whole[at] = True
        n = len(self.next)
        self.link: list[int] = [-1] * n
        self.popped: list[int] = [0] * n
        level = [0, 1]
        while level:  # links lead to shorter strings, so level by level
            below = []
            for u in level:
                for c, v in self.next[u].items():
                    below.append(v)
                    if v in whole:
                        self.link[v], self.popped[v] = 1, 1
                        continue
                    z, count = self.link[u], self.popped[u]
                    while z >= 0 and c not in self.next[z]:
                        count += self.popped[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[v], self.popped[v] = self.next[z][c], count
            level = below

    def count(self, word: str) -> int:
        """Number of pieces; -1 for an unknown word."""
        nxt, link, popped = self.next, self.link, self.popped
        at = n = 0
        for c in word:
            while (to := nxt[at].get(c, -1)) < 0:
                if link[at] < 0:
                    return -1
                n += popped[at]
                at = link[at]
            at = to
        while at != 1:
            if link[at] < 0:
                return -1
            n += popped[at]
            at = link[at]
        return n


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that start a word (marked by U+2581) and pieces that go on, of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
    return [p for p in pieces if p.startswith(WORD_START)], [p for p in pieces if not p.startswith(WORD_START)]


def count_tokens(docs: DataFrame, automaton: Automaton, mark: str = WORD_START, cache_words: int = CACHE_WORDS) -> DataFrame:
    """``docs`` with (n_words, n_tokens, n_unknown), underscored where names clash.

    Words are separated by ASCII white space; ``mark`` is put before each. An
    unknown word counts as one token. Null and blank texts count zero. No
    shuffle. A task counts each distinct word once and forgets all of them
    when it has seen ``cache_words``; results do not depend on that.
    """
    names = {c: internal(docs, c) for c in ("n_words", "n_tokens", "n_unknown")}
    shared = shipped(docs.sparkSession, automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, cache = pickle.loads(shared.value), {}
        for batch in batches:
            rows = []
            for text in text_bytes(batch.column(batch.schema.get_field_index("text"))):
                words = text.split()
                new = [w for w in set(words) if w not in cache]
                if len(cache) + len(new) > cache_words:
                    cache.clear()
                    new = list(set(words))
                for w in new:
                    cache[w] = machine.count(mark + w.decode())
                got = np.fromiter(map(cache.__getitem__, words), dtype=np.int64, count=len(words))
                rows.append((len(words), int(np.abs(got).sum()), int((got < 0).sum())))
            columns = list(zip(*rows)) or [[], [], []]
            yield with_columns(batch, {n: pa.array(c, pa.int64()) for n, c in zip(names.values(), columns)})

    return docs.mapInArrow(run, schema_of(docs, **{n: "bigint" for n in names.values()})).select(
        *[F.col(f"`{c}`") for c in [*docs.columns, *names.values()]])
