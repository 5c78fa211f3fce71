import pytest

TEXT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with columns whose names clash."""
    def build(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, TEXT)
        if clash:
            for c in ("size", "kept", "n_words", "spans", "fp", "key", "id", "class", "copies", "first", "N_TOKENS"):
                df = df.selectExpr("*", f"'x' AS `{c}`")
        return df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, repeated rows, ties."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, long), (None, "no id here at all"), (None, None),
        (7, "a b c d e f g h i j k l m n"), (7, "a b c d e f g h i j k l m n"), (8, "a b c d e f g h i j k l m n", None, None),
        (9, "é日本 ß x \U0001F600 y\x0bz"), (10, "A" * 50_000), (11, "line one is here and long enough\nline one is here and long enougt\n\nline one is here and long enough"),
    ]
