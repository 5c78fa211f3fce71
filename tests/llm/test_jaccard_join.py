"""Jaccard join against brute force: documents, dense groups of near copies, edge cases."""
import random
import re
from collections import Counter
from itertools import combinations

import pytest

from corate.llm import jaccard_join
from corate.llm.jaccard_join import Join, similar_documents

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=4):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def linked(x, y, percent=85):
    both = len(x & y)
    return bool(both) and 100 * both >= percent * (len(x) + len(y) - both)


def brute(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    groups = {}
    for i, s in enumerate(sets):
        groups.setdefault(s, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for s, g in groups.items():
        for i in g[1:] if s else []:
            root[find(i)] = find(g[0])
    for (x, g), (y, h) in combinations(groups.items(), 2):
        if x and y and find(g[0]) != find(h[0]) and linked(x, y, percent):
            root[find(g[0])] = find(h[0])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed=3, bases=4, copies=40, words=120):
    """Groups of texts at all distances around the threshold, sharing passages with one another."""
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    out = []
    for b in range(bases):
        base = [f"b{b}w{r.randrange(400)}" for _ in range(words)]
        for c in range(copies):
            w = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 4, 5])):
                w[r.randrange(len(w))] = f"x{b}_{c}_{r.randrange(10**6)}"
            if r.random() < 0.3:
                w = w[:-r.randrange(1, 12)]
            if r.random() < 0.3:
                w += passage
            out.append(" ".join(w))
    r.shuffle(out)
    return list(enumerate(out))


def test_join_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter(tuple(r) for r in similar_documents(docs).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("percent", [60, 85])
def test_join_of_dense_groups(spark, make, percent):
    rows = near_copies()
    got = Counter(tuple(r) for r in similar_documents(make(rows), percent=percent).collect())
    assert got == brute(rows, percent=percent)


@pytest.mark.parametrize("rounds,common", [(0, 0), (2, 1 << 20)])
def test_every_link_is_found(spark, make, monkeypatch, rounds, common):
    """With ``every`` all similar pairs come out, with their overlaps, by whole sets or by differences to a pivot."""
    monkeypatch.setattr(jaccard_join, "LARGE", 50)
    rows = near_copies(seed=5, bases=3, copies=25)
    join = Join(make(rows), common=common)
    ids = {r.id: r.first for r in join.classes.collect()}
    got = [(min(ids[r.a], ids[r.b]), max(ids[r.a], ids[r.b]), r.shared) for r in join.links(every=True, rounds=rounds).collect()]
    sets = {}
    for d, t in rows:
        sets.setdefault(shingles(t), d)
    want = {(min(d, e), max(d, e), len(x & y)) for (x, d), (y, e) in combinations(sets.items(), 2) if linked(x, y)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_pivots_spare_pairs(spark, make):
    """A group of near copies costs rows in proportion to its size, not to its pairs."""
    base = [f"w{i}" for i in range(200)]
    rows = [(c, " ".join(base[:i] + [f"x{c}"] + base[i + 1:])) for c, i in enumerate(range(5, 195))]
    join = Join(make(rows))
    n, n_links = join.classes.count(), join.links().count()
    assert n == 190 and n_links < 30 * n < n * (n - 1) // 2
    assert {r.component_id for r in join.grouped().collect()} == {0}


def test_join_edges(spark, make, odd_rows):
    rows = [r[:2] for r in odd_rows] + [(20, "a b c"), (21, "A  B\tC"), (22, "a b"), (23, "a b c d"), (24, "a b c d e"), (25, "x y"), (20, "")]
    got = Counter(tuple(r) for r in similar_documents(make(rows)).collect())
    assert got == brute(rows)


def test_join_of_an_empty_table(spark, make):
    out = similar_documents(make([]))
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.collect() == []


def test_invalid_bytes_are_words(spark):
    docs = spark.sql("SELECT id AS doc_id, cast(X'61FF2062' AS string) AS text FROM range(2)")
    assert sorted(tuple(r) for r in similar_documents(docs).collect()) == [(0, 1, 0), (1, 1, 0)]


def test_parity_maps_bound_the_difference():
    r = random.Random(1)
    x = jaccard_join.hashes(" ".join(str(r.randrange(50)) for _ in range(300)).encode())
    y = jaccard_join.hashes(" ".join(str(r.randrange(50)) for _ in range(300)).encode())
    maps = jaccard_join.parity_map(x) ^ jaccard_join.parity_map(y)
    assert sum(int(v & (1 << 64) - 1).bit_count() for v in maps.tolist()) <= len(set(x.tolist()) ^ set(y.tolist()))
