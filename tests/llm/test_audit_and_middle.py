"""Source divergence audit and fill-in-the-middle against plain Python, edge cases included."""
import hashlib
import re
from collections import Counter, defaultdict

import pytest

from corate.llm import fill_in_middle, source_audit

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_audit(rows, min_docs=3, top=200):
    """``rows`` are (text, lang, source)."""
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(lower(text or ""))
        counts[lang or "", source or ""].update(terms)
        in_docs[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = {t for t, n in in_docs[lang].items() if n >= min_docs}
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def level(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: level(c) for s, c in groups.items()}, level(whole)
        for s, c in groups.items():
            pairs = [(o, sum((p[s][t] - p[o][t])**2 // p[o][t] for t in kept)) for o in groups if o != s]
            terms = [(t, (p[s][t] - q[t])**2 // q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, r) for r, (i, v) in enumerate(found[:most], 1)}
    return out


@pytest.mark.parametrize("packed", [0, 2, 8, 10**9])
def test_audit_matches_brute_force(spark, packed):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    got = [tuple(r) for r in source_audit.audit(docs, packed=packed).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows)


def test_audit_edges(spark, make, odd_rows):
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else f"s{i % 3}") for i, r in enumerate(odd_rows)]
    rows += [(50, "alone here", "xx", "a"), (51, None, "xx", "b"), (52, "Alpha alpha\x00ALPHA é É", None, "a"), (53, "alpha é", None, "b"),
             (54, "alpha beta beta", "", None), (54, "alpha beta beta", "", None), (55, "alpha", "", "c")]
    docs = make(rows)
    got = {tuple(r) for r in source_audit.audit(docs, top=5).collect()}
    assert got == brute_audit([r[1:] for r in rows], top=5)
    assert ("xx", "a", "pair", "b", 0, 1) in got  # a language without kept terms


def test_audit_long_text_is_split_between_terms(spark, make, monkeypatch):
    monkeypatch.setattr(source_audit, "_PIECE", 50)
    assert [t for part in source_audit._pieces(b"ab " * 100 + b"c" * 300 + b" d") for t in part] == [b"ab"] * 100 + [b"c" * 300, b"d"]


def test_audit_without_shared_names_or_broadcast(spark, make, monkeypatch):
    monkeypatch.setattr(source_audit, "MAX_BROADCAST", 0)
    rows = [(i, f"common word{i % 4} w{i % 2}", "en", f"s{i % 5}") for i in range(40)]
    got = {tuple(r) for r in source_audit.audit(make(rows)).collect()}
    assert got == brute_audit([r[1:] for r in rows])


def test_audit_of_an_empty_table(spark, make):
    out = source_audit.audit(make([]))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.collect() == []


def brute_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middle_matches_brute_force(spark, make, odd_rows):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [r[:2] for r in odd_rows]
    rows += [(100 + i, t) for i, t in enumerate(["x<P>y", "<S>", "a<M>", "<<P", "a<", "P>a", "a b\n\nc", "\U0001F600é1", "$1 \\ {2}", "q" * 300_000, "a1 " * 100_000])]
    docs = make(rows).withColumnRenamed("first", "n")
    out = fill_in_middle.transform(docs)
    back = out.toDF(*[f"c{i}" for i in range(len(out.columns))])
    assert out.columns[:len(docs.columns)] == docs.columns
    k = len(docs.columns)
    got = [(r[0], r[1], *r[k:]) for r in back.collect()]
    assert sorted(got, key=repr) == sorted([(d, t, *brute_middle(d, t)) for d, t in rows], key=repr)


def test_middle_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = fill_in_middle.transform(docs, plain_percent=0, spm_percent=50, seed="x")
    assert {r.form for r in out.select("form").distinct().collect()} >= {"psm", "spm"}
    assert out.where(fill_in_middle.restored(out.output, out.form) != out.text).count() == 0


def test_middle_invalid_bytes_and_empty_table(spark, make):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    row = fill_in_middle.transform(docs, plain_percent=0).first()
    assert row.n == 3 and row.output.count("�") == 1
    assert fill_in_middle.transform(make([])).collect() == []
