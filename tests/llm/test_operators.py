"""Each operator against brute force, on edge cases, empty tables and clashing columns."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from corate.llm import (decontaminate, grade_model, line_dedup, lm_score, mixing, pii, quality_rules, simhash,
                        token_counts, token_store)
from corate.llm.graph import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZERS = "/opt/tokenizers"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("parts", [None, 2, 3, 5])
def test_simhash_matches_brute_force(docs, rows, parts):
    got = Counter(tuple(r) for r in simhash.near_duplicates(docs, parts=parts).collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    want = brute_components([d for d, _ in rows], fps)
    assert got == Counter((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, want))


def test_simhash_links_dense_groups(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(-2**62, 2**62, 6)
    fps = sorted({int(c) ^ sum(1 << int(b) for b in rng.choice(63, k, replace=False)) for c in centres for k in (0, 1, 2, 3) for _ in range(40)})
    df = spark.createDataFrame([(f, 1) for f in fps], "fp bigint, n bigint")
    roots = {r.node: r.root for r in components(simhash.links(df)).collect()}
    mask = (1 << 64) - 1
    want = brute_components(fps, [f & mask for f in fps])
    groups = defaultdict(set)
    for f, w in zip(fps, want):
        groups[w].add(roots.get(f, f))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_threshold_allocation_is_optimal():
    rng = np.random.default_rng(2)
    cost = rng.random((20, 3, 6)).cumsum(axis=2)
    got = simhash.allocate(cost, 2)
    from itertools import product
    for k in range(20):
        best = min(sum(cost[k, i, t + 1] for i, t in enumerate(ts)) for ts in product(range(-1, 5), repeat=3) if sum(ts) == 2)
        assert sum(got[k]) == 2 and abs(sum(cost[k, i, t + 1] for i, t in enumerate(got[k])) - best) < 1e-9


def test_simhash_edges(make, odd_rows, spark):
    df = make(odd_rows)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(odd_rows)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    assert kept.count() == len({r.component_id for r in got})
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.deduplicate(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 10] + [(100, 3), (5, 5), (None, 4)] + [(200, x) for x in range(300, 340)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got[100] == 1 and got[10] == 1 and got[11] == 11 and got[339] == 200 and 5 in got


def brute_pieces(word, first, rest):
    n = at = 0
    while at < len(word):
        end = next((j for j in range(len(word), at, -1) if word[at:j] in (rest if at else first)), 0)
        if not end:
            return -1
        n, at = n + 1, end
    return n


def test_automaton_matches_greedy_search():
    rng = np.random.default_rng(3)
    word = lambda k: "".join(rng.choice(list("abc"), k))
    for _ in range(30):
        first, rest = ({word(int(k)) for k in rng.integers(1, 5, 6)} for _ in range(2))
        machine = token_counts.Automaton(sorted(first), sorted(rest))
        for _ in range(60):
            w = word(int(rng.integers(1, 9)))
            assert machine.count(w) == brute_pieces(w, first, rest)


def test_token_counts(docs, rows, make, odd_rows):
    vocabulary = token_counts.sentencepiece_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    machine = token_counts.Automaton(*vocabulary)
    first, rest = map(set, vocabulary)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs.select("doc_id", "text"), machine, cache_words=50).collect()}
    for d, text in rows[:60]:
        pieces = [brute_pieces("▁" + w, first, rest) for w in WORD.findall(text)]
        assert (got[d].n_words, got[d].n_tokens, got[d].n_unknown) == (len(pieces), sum(map(abs, pieces)), pieces.count(-1))
    odd = token_counts.count_tokens(make(odd_rows), machine)
    assert odd.columns[-3:] == ["n_words_", "n_tokens_", "n_unknown"] and odd.count() == len(odd_rows)
    assert token_counts.count_tokens(make(odd_rows).limit(0), machine).count() == 0


def test_grade_model_on_held_out_ratings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    ratings = grade_model.graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    train = ratings.where("doc_id % 2 = 0")
    model = grade_model.fit(docs, train)
    assert (np.diff(model.thresholds) >= 0).all()
    test = grade_model.score(docs.select("doc_id", "text"), model).join(ratings.where("doc_id % 2 = 1"), "doc_id")
    kept = {r.grade: r.k for r in test.groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[2] > 0.98 and kept[1] < 0.15 and kept[0] < 0.15


def test_grade_model_edges(make, odd_rows, spark):
    ratings = grade_model.graded(spark.createDataFrame([(7, 1, 0), (7, 0, 0), (4, None, 0), (None, 1, 1), (5, 1, 1)], "doc_id bigint, quality int, toxic int"))
    assert {(r.doc_id, r.grade) for r in ratings.collect()} == {(7, 1), (5, 0)}
    model = grade_model.fit(make(odd_rows), ratings)
    assert grade_model.score(make(odd_rows), model).columns[-1] == "kept_"
    assert grade_model.score(make(odd_rows), model).count() == len(odd_rows)
    empty = grade_model.fit(make(odd_rows).limit(0), ratings.limit(0))
    assert not empty.weights.any() and grade_model.score(make(odd_rows).limit(0), empty).count() == 0


def brute_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_quality_rules(make, odd_rows, docs, rows):
    df = make(odd_rows)
    got = quality_rules.judge(df)
    assert [c for c in df.columns if c not in got.columns] == ["kept", "n_words"] or {"kept_", "n_words_"} <= set(got.columns)
    for r in got.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_sketches_merge(docs):
    measured = quality_rules.with_measures(docs).cache()
    keys = ["lang", "source", "measure", "bucket"]
    halves = [quality_rules.sketch(measured.where(f"doc_id % 2 = {k}")) for k in (0, 1)]
    merged = halves[0].union(halves[1]).groupBy(*keys).agg(F.sum("n").alias("n"))
    whole = quality_rules.sketch(measured)
    assert Counter(map(tuple, merged.select(*keys, "n").collect())) == Counter(map(tuple, whole.select(*keys, "n").collect()))
    at = whole.sparkSession.range(0, 5000).select("id", quality_rules.bucket(F.col("id")).alias("b"))
    for r in at.withColumn("top", quality_rules.bucket_top(F.col("b"))).collect():
        assert r.id <= r.top <= max(63, r.id + r.id / 32)


def test_lm_learns_and_scores(docs, make, odd_rows):
    vocabulary, network = lm_score.fit(docs.select("doc_id", "text"), every=1)
    got = lm_score.score(docs.select("doc_id", "text"), vocabulary, network).toPandas()
    assert got.log_prob.sum() / got.n_tokens.sum() > -6.6  # untrained: -2 ln 32 = -6.93
    odd = lm_score.score(make(odd_rows), vocabulary, network)
    assert odd.count() == len(odd_rows)
    assert odd.where("text is null").first()["log_prob"] == 0 and odd.where("text is null").first()["mean_log_prob"] is None
    empty = lm_score.fit(docs.limit(0))
    assert lm_score.score(docs.limit(0), *empty).count() == 0


def test_lm_scores_match_a_plain_softmax():
    net, rng = lm_score.Network(), np.random.default_rng(4)
    tokens = rng.integers(0, lm_score.VOCABULARY, 50)
    at = np.arange(2, 48)
    got = net.log_probs(tokens, at)
    for k, i in enumerate(at):
        x = net.p["bias"] + sum(net.p["embed"][j][tokens[i + o]] for j, o in enumerate(lm_score.OFFSETS))
        h = np.append(np.tanh(x), 1)
        c, p = tokens[i] % 32, tokens[i] // 32
        log = lambda z, n: z[n] - np.log(np.exp(z).sum())
        assert abs(got[k] - log(net.p["top"] @ h, c) - log(net.p["low"][c] @ h, p)) < 1e-4


def test_lm_vocabulary_grows_and_each_word_has_its_own_probability(make, docs, rows):
    # 1,600 words of 40 occurrences each: more than 32 x 32 classes hold
    many = lm_score.count_words(make([(i, " ".join(f"w{(400 * i + j) % 1600}" for j in range(400))) for i in range(160)]))
    vocabulary, classes = lm_score.choose(many)
    assert classes > 32 and {b"w%d" % i for i in range(1600)} <= set(vocabulary)
    counts = lm_score.count_words(docs).cache()
    vocabulary, network = lm_score.fit(docs.select("doc_id", "text"), counts=counts)
    n = Counter({bytes(r.word): r.n for r in counts.collect()})
    assert n == Counter(w for _, t in rows for w in (t or "").encode().lower().split())
    known, totals = set(vocabulary), Counter()
    bucket = lambda w: xxhash.xxh64_intdigest(w, 42) - (1 << 64) * (xxhash.xxh64_intdigest(w, 42) >> 63)
    for w in n.keys() - known:
        totals[bucket(w) % network.buckets] += n[w]
    more = docs.select("doc_id", "text").union(make([(-1, "zzqx-unseen the zzqx-unseen")]).select("doc_id", "text"))
    base = {r.doc_id: r for r in lm_score.score(more, vocabulary, network).collect()}
    for looked_up in (lm_score.LOOKED_UP, 500, 0):
        got = {r.doc_id: r for r in lm_score.score(more, vocabulary, network, counts, text=looked_up > 0, looked_up=looked_up).collect()}
        assert len(got) == len(rows) + 1
        for d, t in [*rows, (-1, "zzqx-unseen the zzqx-unseen")]:
            share = sum(np.log((n[w] or 0.5) / totals[bucket(w) % network.buckets]) for w in (t or "").encode().lower().split() if w not in known)
            assert abs(got[d].log_prob - base[d].log_prob - share) < 0.01


def test_lm_trains_on_every_token_and_beats_unigrams_on_held_out_texts(docs):
    sizes = [0, 1, 2, 3, 7, 30]
    chunk = [np.zeros(n, np.int32) for n in sizes]
    turns = [lm_score.turn(chunk, nth, lm_score.TRAIN_EVERY) for nth in range(lm_score.ROUNDS)]
    assert (sum(t.astype(int) for t in turns) >= 1).all() and len(turns[0]) == sum(sizes)
    half = [docs.where(f"doc_id % 2 = {k}").select("doc_id", "text") for k in (0, 1)]
    counts = lm_score.count_words(half[0]).cache()
    vocabulary, network = lm_score.fit(half[0], counts=counts)
    n = np.maximum(lm_score.token_counts(counts, vocabulary, network), 0.5)
    unigram, words = np.log(n / n.sum()), lm_score.Words(vocabulary, network.buckets)
    held = [words((r.text or "").encode())[0] for r in half[1].collect()]
    base = sum(unigram[x].sum() for x in held) / sum(map(len, held))
    got = lm_score.score(half[1], vocabulary, network).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    assert got > base + 0.005


def test_store_round_trip(docs, rows, spark, tmp_path):
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    tokenizer, start = Tokenizer.from_file(path), 0
    got = {r.doc_id: r for r in token_store.store_digest(docs, path).collect()}
    for d, text in sorted(rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    with open(path, encoding="utf-8") as f:
        token_store.write_store(docs, f"{tmp_path}/s", f.read(), shard_bytes=50_000)
    wanted = [(d,) for d, _ in rows[::7]] + [(10**9,), (-5,), (None,)]
    found = {r.doc_id: r.ids for r in token_store.lookup(spark, f"{tmp_path}/s", spark.createDataFrame(wanted, "doc_id bigint")).collect()}
    texts = dict(rows)
    assert found == {d: tokenizer.encode(texts[d] or "", add_special_tokens=False).ids + [1] for d, _ in rows[::7]}


def test_store_edges(make, odd_rows):
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    tokenizer = Tokenizer.from_file(path)
    got = token_store.store_digest(make(odd_rows), path).collect()
    want = [len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows]
    assert sorted(r.n_tokens for r in got) == sorted(want)
    at = sorted((r.start, r.n_tokens) for r in got)
    assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:]))
    assert token_store.store_digest(make(odd_rows).limit(0), path).count() == 0


def test_word_encoder_equals_the_tokenizer():
    import pyarrow as pa

    with open(f"{TOKENIZERS}/word_bpe_49k.json", encoding="utf-8") as f:
        encode = token_store.WordEncoder(f.read(), words=30)
    rng = np.random.default_rng(5)
    parts = ["a", "B", "é", "É", "İ", "ß", "Σ", "ς", "1", "٣", ".", ",", "'s", "'T", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "\x01", " ", "\n", " ", "\x1c", "\x85", "é", "日", "😀", "&", "#", "--", "\"", "The", "ﬁ", "Å"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000)]
    for text, got in zip(texts, encode(pa.array(texts))):
        assert np.frombuffer(got, "<u2").tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(6).integers(0, 2**63, 5000)).astype(np.uint64)
    index = token_store.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_pii(text):
    ok = {"email": lambda m, d: True, "ip": lambda m, d: all(int(p) <= 255 for p in m.split(".")),
          "card": lambda m, d: 13 <= len(d) <= 19 and luhn(d), "phone": lambda m, d: 9 <= len(d) <= 15}
    return [f"{k}:{m.start()}:{m.end()}" for k, p in pii.BASE.items() for m in re.finditer(p, text or "")
            if ok[k](m[0], re.sub("[^0-9]", "", m[0]))]


PII_ROWS = [
    (1, "mail a.b@c.d_e@f.gh, x@y.zz-a.b@c, 1.2.3.4.5.6.7.8 and 256.1.1.1 0001.02.3.255 999999999999.1.1.1"), (2, None), (3, ""),
    (4, "4111 1111 1111 1111 4111-1111-1111-1112 5500000000000004 +49 (30) 123-4567 +1 2 +12 345 678 901 234 567"), (5, "é😀 a@b.cd 😀 10.0.0.1"),
    (6, "1" * 30_000), (7, "a" * 30_000 + "@b.cd"), (8, "@" * 1000 + "+" * 1000), (9, "password=15959ad9338a8dac1d token = \"841d82b07cb9b9f1fcb7c001\" call 555-123-4567"),
]


def test_pii_base_spans(make, odd_rows):
    df = make(PII_ROWS + odd_rows)
    for r in pii.detect(df).select("text", pii.span_text(F.col("base")).alias("b"), pii.span_text(F.col("spans_")).alias("all")).collect():
        assert r.b.split(",") == (brute_pii(r.text) or [""]), r.text[:80]
        assert set(r.b.split(",")) - {""} <= set(r.all.split(","))
    assert pii.detect(df.limit(0)).count() == 0


def test_pii_secret_at_the_end_of_a_sentence_is_proposed(make):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    df = make([(1, f"the token is {key}."), (2, f"the token is {key}. Then"), (3, f"see {key}.example"), (4, f"to {key}@x.org")], clash=False)
    got = df.select("doc_id", pii._found(F.col("text"), pii.PROPOSED["secret"]).alias("f")).collect()
    assert {r.doc_id: [tuple(x)[2] for x in r.f] for r in got} == {1: [key], 2: [key], 3: [], 4: []}


def test_pii_method_finds_secrets_and_spares_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = pii.detect(docs.select("doc_id", "text")).collect()
    planted = found = 0
    for r in got:
        spans = {(s.start, s.end) for s in r.spans if s.kind == "secret"}
        true = {m.span(1) for m in re.finditer(r"(?:password=|token = \")([0-9a-f]{16,})", r.text)}
        planted += len(true)
        found += len(true & spans)
        assert not spans - true
    assert planted and found == planted


def test_expectation_maximisation_ranks_labelers():
    rng = np.random.default_rng(7)
    n = len(pii.LABELERS)
    accuracy = [0.95, 0.6] + [0.8] * (n - 2)
    counts = Counter()
    for _ in range(4000):
        truth = rng.random() < 0.4
        counts[("k", *[1 if (rng.random() < a) == truth else -1 for a in accuracy])] += 1.0
    _, right = pii.expectation_maximisation(counts)
    assert abs(right[0] - 0.95) < 0.05 and abs(right[1] - 0.6) < 0.06


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_banded_edit_distance_and_selection():
    rng = np.random.default_rng(8)
    for _ in range(4000):
        a = "".join(rng.choice(list("abc"), rng.integers(0, 14)))
        b = list(a)
        for _ in range(rng.integers(0, 4)):
            i, k = rng.integers(0, len(b) + 1), rng.integers(0, 3)
            if k == 0:
                b.insert(i, "a")
            elif i < len(b):
                b[i:i + 1] = [] if k == 1 else ["c"]
        b = "".join(b)
        d = edit_distance(a, b)
        for most in (1, 2, 3):
            assert line_dedup.within(a, b, most) == (d if d <= most else None)
            s, t = sorted((a, b), key=len)
            if d <= most < len(s):
                index = {(len(s), i, s[x:x + n]) for i, (x, n) in enumerate(line_dedup.segments(len(s), most))}
                assert any((size, i, t[x:x + n]) in index for size, i, x, n in line_dedup.probes(len(t), most))


@pytest.mark.parametrize("edits", [1, 2])
def test_line_classes_match_brute_force(make, edits):
    rng = np.random.default_rng(9)
    base = ["".join(rng.choice(list("abcdé "), 30)) for _ in range(6)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(4):
            x = list(base[rng.integers(0, 6)])
            for _ in range(rng.integers(0, 3)):
                x[rng.integers(0, len(x))] = str(rng.choice(list("xyz")))
            lines.append("".join(x))
        rows.append((d, "\n".join([*lines, "", "short"])))
    got = line_dedup.deduplicate_lines(make(rows), edits=edits, min_chars=20).orderBy("doc_id").collect()
    flat = [(d, n, x) for d, t in rows for n, x in enumerate(t.split("\n")) if x.strip()]
    texts = sorted({x for *_, x in flat})
    parent = {x: x for x in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    degree = Counter()
    for i, x in enumerate(texts):
        for y in texts[:i]:
            if min(len(x), len(y)) >= 20 and edit_distance(x, y) <= edits:
                parent[find(x)] = find(y)
                degree[x] += 1
                degree[y] += 1
    seen, gone = set(), defaultdict(set)
    for d, n, x in flat:
        if find(x) in seen:
            gone[d].add(n)
        seen.add(find(x))
    for r, (d, t) in zip(got, rows):
        assert r.text == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d])
        assert (r.n_removed, r.n_links) == (len(gone[d]), sum(degree[x] for x in t.split("\n")))


def test_short_lines_are_linked(make):
    rng = np.random.default_rng(11)
    lines = sorted({"".join(rng.choice(list("abé1"), n)) for n in (1, 1, 1, 2, 2, 2, 3, 4, 5, 8, 12, 20, 23) for _ in range(4)} | {"abcdefgh 1", "abcdefgh 2"})
    for edits in (1, 2):
        got = {r.doc_id: r.n_links for r in line_dedup.deduplicate_lines(make(list(enumerate(lines))), edits=edits).collect()}
        assert got == {i: sum(x != y and edit_distance(x, y) <= edits for y in lines) for i, x in enumerate(lines)}


def test_line_dedup_edges(make, odd_rows):
    df = make(odd_rows)
    got = line_dedup.deduplicate_lines(df)
    assert got.columns[:len(df.columns)] == df.columns and got.count() == len(odd_rows)
    r = got.where("doc_id = 11").first()
    assert (r.n_lines, r.n_removed, r.n_links) == (3, 2, 3) and r.text == "line one is here and long enough\n"
    assert line_dedup.deduplicate_lines(df.limit(0)).count() == 0


def brute_hits(text, items):
    words = decontaminate.words_of((text or "").encode())
    hit, found = set(), set()
    for item, body in items:
        w = decontaminate.words_of((body or "").encode())
        n = min(13, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(x for x in found if x is not None)


@pytest.mark.parametrize("block_bytes", [2 << 20, 60])
def test_decontamination_matches_brute_force(make, odd_rows, spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 500)
    rng = np.random.default_rng(10)
    word = lambda: str(rng.choice(["a", "b", "the", "é", "x1"]))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 13, 14, 20, 0, 2])] + [(None, "a b the a"), (2, "b b é"), (11, None), (12, "a b c d e f g h i j k l m n")]
    rows = odd_rows + [(100 + k, ", ".join(word() for _ in range(60))) for k in range(20)] + [(150, items[4][1].upper())]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found, at = decontaminate.find(make(rows), bench, block_bytes=block_bytes)
    for r in found.collect():
        spans = [(s.start, s.end) for s in r[at["spans"]]]
        assert (r[at["words"]], sum(b - a for a, b in spans), r[at["items"]]) == brute_hits(r.text, items)
    clean = decontaminate.clean(make(rows), bench)
    assert clean.columns == make(rows).columns
    assert decontaminate.hits(make(rows).limit(0), bench).count() == 0
    assert decontaminate.hits(make(rows), bench.limit(0)).where("n_hit > 0").count() == 0


def test_suffix_order():
    rng = np.random.default_rng(11)
    for n in (1, 2, 50, 400):
        x = np.append(rng.integers(1, 3, n), 0)
        assert decontaminate.suffix_order(x).tolist() == sorted(range(n + 1), key=lambda i: x[i:].tolist())


def test_mix_targets_and_words(docs, make, odd_rows):
    got = mixing.mix(docs).toPandas()
    per = got.assign(taken=got["copies"] * got["size"]).groupby("source").agg({"taken": "sum", "target": "max", "source_size": "max", "size": ["sum", "max"]})
    assert (per["size"]["sum"] == per["source_size"]["max"]).all()
    assert abs(per["target"]["max"].sum() - got["size"].sum()) < 1e-6
    assert ((per["taken"]["sum"] - per["target"]["max"]).abs() <= per["size"]["max"] / 2 + 1).all()
    assert (got["copies"] <= 3).all()
    assert mixing.sample(docs).count() == got["copies"].sum()
    df = make(odd_rows)
    mixed = mixing.mix(df)
    assert mixed.columns == [*df.columns, "size_", "source_size", "target", "copies_"] and mixed.count() == len(odd_rows)
    assert mixing.sample(df).columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0


def test_water_filling(spark):
    rng = np.random.default_rng(12)
    for case in range(6):
        sizes = [int(x) for x in rng.integers(0, 1000, 9) ** 2]
        df = spark.createDataFrame([(chr(97 + i) if i < 8 else None, s) for i, s in enumerate(sizes)], "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        weights, target, free = [1 + i % 3 for i in range(9)], [0.0] * 9, set(range(9))
        left = float(sum(sizes))
        while True:
            level = left / sum(weights[i] for i in free) if free else 0
            over = {i for i in free if level * weights[i] > 3 * sizes[i]}
            if not over:
                break
            for i in over:
                target[i] = 3.0 * sizes[i]
                left -= target[i]
            free -= over
        for i in free:
            target[i] = level * weights[i]
        for i in range(9):
            assert abs(got[chr(97 + i) if i < 8 else None] - target[i]) < 1e-6 * max(1, target[i])


def test_a_training_step_makes_no_array_of_the_whole_vocabulary():
    """Each step summed into rows of every token number, 2 MB an offset, however few occur."""
    import tracemalloc

    network = lm_score.Network(128)
    tokens = np.arange(100, 200, dtype=np.int32)
    dense = [e.copy() for e in network.p["embed"]]
    tracemalloc.start()
    network.train(tokens, np.arange(2, 66), 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20
    changed = [np.flatnonzero((a != b).any(axis=1)).tolist() for a, b in zip(dense, network.p["embed"])]
    assert changed == [tokens[np.arange(2, 66) + k].tolist() for k in lm_score.OFFSETS]


def test_lm_words_are_looked_up_once_and_split_as_bytes_are(make, monkeypatch):
    texts = ["  The b\tC\x0b\x0c\r\nthe ", "", None, "   ", "zz \x1c\x1d a\x1fb\x85c zz", "Ä É zz", "\n\nq q THE"] * 3
    plain = [(t or "").encode().lower().split() for t in texts]
    words, hashed = lm_score.Words([b"the"], 7), []
    digest = lm_score.xxhash.xxh64_intdigest
    monkeypatch.setattr(lm_score.xxhash, "xxh64_intdigest", lambda w, seed: hashed.append(w) or digest(w, seed))
    got = list(words.of(pa.array(texts)))
    assert len(hashed) == len(set(hashed)) and set(hashed) == {w for t in plain for w in t} - {b"the"}
    for (tokens, hashes), own in zip(got, plain, strict=True):
        rare = np.array([digest(w, 42) for w in own if w != b"the"], np.uint64).view(np.int64)
        assert hashes.tolist() == rare.tolist() and tokens.tolist() == [8 if w == b"the" else 1 + int(np.uint64(digest(w, 42)).astype(np.int64) % 7) for w in own]
    monkeypatch.undo()
    counted = lm_score.count_words(make(list(enumerate(texts))))
    assert {bytes(r["word"]): r["n"] for r in counted.collect()} == Counter(w for t in plain for w in t)
