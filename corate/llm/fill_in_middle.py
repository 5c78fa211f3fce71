"""Fill-in-the-middle rewriting with counted regular expressions.

A text is a row of units, each a longest run of ASCII letters or one other
character. ``regexp_count`` gives their number n; two cuts a <= b drawn from a
keyed hash of the document id become the counts of a pattern made for the row,

    ^((?:unit){a}+)((?:unit){b-a}+)(.*)$

whose three groups are prefix, middle and suffix. Counts and units are
possessive, so the match walks the text once and never backs up, whatever its
length. Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import internal

#: The markers and the unit.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"
_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PLAIN_PERCENT, SPM_PERCENT, SEED = 10, 20, "1"


def _draws(doc_id: Column, seed: str) -> list[Column]:
    """Four numbers below 2^32 from the hash of ``seed:doc_id`` (no id: of ``seed:``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from: its three parts put back in order."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def transform(docs: DataFrame, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT, seed: str = SEED) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output.

    Needs doc_id and text; other columns pass through (one called like an added
    column stays, under its own name, ahead of it). ``form`` is plain (output
    is the text, lengths null), psm (prefix, suffix, middle) or spm (suffix
    first). Null text reads as empty; an empty text, or one that holds a
    marker, is plain. Bytes that are no UTF-8 read as U+FFFD. Rows depend on
    their own id and text only: repeated rows come out alike, rows without an
    id share one draw. Empty tables give empty results. Time and memory are
    linear in the text.
    """
    names = {c: internal(docs, f"__fim_{c}") for c in ("text", "n", "a", "b", "form", "m")}
    col = {k: F.col(f"`{v}`") for k, v in names.items()}
    h1, h2, h3, h4 = _draws(F.col("doc_id"), seed)
    text = F.call_function("make_valid_utf8", F.coalesce(F.col("text"), F.lit("")))
    out = docs.withColumn(names["text"], text).withColumn(names["n"], F.regexp_count(col["text"], F.lit(UNIT)).cast("bigint"))
    out = out.withColumns({names["a"]: F.least(h1 % (col["n"] + 1), h2 % (col["n"] + 1)), names["b"]: F.greatest(h1 % (col["n"] + 1), h2 % (col["n"] + 1))})
    plain = (col["text"] == "") | (h3 % 100 >= 100 - plain_percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(col["text"], F.lit(marker))
    out = out.withColumn(names["form"], F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    pattern = F.concat(F.lit(f"(?s)^({_UNIT}{{"), col["a"], F.lit(f"}}+)({_UNIT}{{"), col["b"] - col["a"], F.lit("}+)(.*)$"))
    # one match: the groups come out between markers, which the text does not hold
    cut = F.regexp_replace(col["text"], pattern, F.lit(f"{PREFIX}$1{MIDDLE}$2{SUFFIX}$3"))
    out = out.withColumn(names["m"], F.when(col["form"] != "plain", F.split(cut, f"{PREFIX}|{MIDDLE}|{SUFFIX}", -1)))
    prefix, middle, suffix = (col["m"][i] for i in (1, 2, 3))
    output = (F.when(col["form"] == "plain", col["text"])
              .when(col["form"] == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], col["n"].alias("n"), col["form"].alias("form"),
                      F.length(prefix).cast("bigint").alias("prefix_chars"), F.length(middle).cast("bigint").alias("middle_chars"),
                      output.alias("output"))
