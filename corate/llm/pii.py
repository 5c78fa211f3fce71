"""Personal data by weak supervision (built-in functions only).

Fixed patterns give the base spans: e-mail and IP addresses, card numbers
with a valid check digit, international phone numbers. Looser patterns propose
further spans: phone numbers without a country code and secrets. Labelers vote
on each proposal (+1, 0, -1): regular expressions on the match, gazetteers of
cue words before it, and the characters around it. The votes of all documents
are counted by their combination, a table of bounded size; expectation
maximisation over it estimates how reliable each labeler is and how likely
each combination is personal data. A logistic classifier is then trained on
these probabilities with the votes and the shape of the match as features, and
decides which proposals become spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import internal, saved

#: Fixed patterns of the base kinds, in order.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same languages, written so that Java's matcher neither recurses nor tries a run of
#: characters from each of its positions: a match starts where a run starts or the last match ended.
_FAST = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Proposals of the method, as runs that a match cannot start inside of.
PROPOSED = {
    "phone": r"(?<![0-9A-Za-z+.)-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+(?![A-Za-z0-9_@-]|\.[A-Za-z0-9_])",
}
#: Gazetteers: words that stand right before personal data of a kind.
CUES = {
    "phone": ["phone", "tel", "telephone", "call", "fax", "mobile", "cell"],
    "secret": ["password", "passwd", "pwd", "token", "secret", "key", "api_key", "apikey"],
}
BEFORE, AFTER = 24, 4
#: Probability from which a proposal becomes a span.
DECIDE = 0.9
KINDS = [*BASE, "secret"]


def _found(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of a pattern's leftmost matches, in code points.

    The texts between matches and the matches alternate, so the starts are
    running sums of their lengths.
    """
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    step = F.aggregate(
        pieces, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["gap"]) + F.coalesce(F.length(p["match"]), F.lit(0))).alias("at"),
            F.when(p["match"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.length(p["gap"])).alias("start"), (acc["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("end"),
                p["match"].alias("match"))))).alias("out")),
    )
    return F.when(text.rlike(pattern), step["out"]).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _luhn(digits: Column) -> Column:
    """Check-digit test of a digit string."""
    back = F.split(F.reverse(digits), "")
    value = F.transform(back, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        # leading zeros aside, at most three digits and at most 255
        short = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    """Per base kind the array of (start, end, match) that pass the kind's check."""
    def passing(kind: str) -> Column:
        return F.filter(_found(text, _FAST[kind]), lambda x: _valid(kind, x["match"]))

    return {k: passing(k) for k in BASE}


def _proposals(text: Column) -> Column:
    """Array of (kind, start, end, match, before, after) of the looser patterns."""
    def of(kind: str) -> Column:
        return F.transform(_found(text, PROPOSED[kind]), lambda x: F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"),
            F.substring(text, F.greatest(x["start"] - BEFORE, F.lit(0)) + 1, F.least(x["start"], F.lit(BEFORE))).alias("before"),
            F.substring(text, x["end"] + 1, F.lit(AFTER)).alias("after")))

    return F.concat(*map(of, PROPOSED))


def votes(x: Column) -> dict[str, Column]:
    """Each labeler's vote on a proposal: 1 personal, -1 not, 0 none."""
    match, before, kind = x["match"], F.lower(x["before"]), x["kind"]
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    hexadecimal = match.rlike("^[0-9a-fA-F]+$")
    number = match.rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$")
    cue = F.lit(False)
    near = F.lit(False)
    for k, words in CUES.items():
        listed = "|".join(words)
        cue = cue | ((kind == k) & before.rlike(f"(?:^|[^a-z])(?:{listed})[^a-z0-9]{{0,6}}$"))
        near = near | ((kind == k) & before.rlike(f"(?:^|[^a-z])(?:{listed})(?:[^a-z]|$)"))
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    return {
        # regular expressions on the match
        "shape": F.when(kind == "phone", F.when(number, 1).otherwise(-1)).otherwise(F.when(mixed & hexadecimal, 1).when(mixed, 0).otherwise(-1)),
        "mixture": F.when(kind == "phone", F.when(match.rlike(r"^\(?[2-9]"), 1).otherwise(-1)).otherwise(F.when((digits >= 3) & (digits < F.length(match)), 1).otherwise(-1)),
        # gazetteers of cue words: right before, and anywhere in the words before
        "cue": F.when(cue, 1).otherwise(-1),
        "cue_near": F.when(near, 1).otherwise(0),
        # characters around
        "assigned": F.when(before.rlike(r"[=:]\s?[\"']?$"), 1).otherwise(F.when(kind == "phone", 0).otherwise(-1)),
        "closed": F.when(x["after"].rlike(r"^(?:$|[\s\"',.;)])"), F.lit(0)).otherwise(-1),
    }


LABELERS = ["shape", "mixture", "cue", "cue_near", "assigned", "closed"]


def expectation_maximisation(counts: dict[tuple, float], rounds: int = 50) -> tuple[dict[tuple, float], dict[int, float]]:
    """Posterior of each vote combination, and each labeler's accuracy when it votes.

    ``counts`` is (kind, vote, vote, ...) -> times seen. Labelers are taken as
    independent given the truth; every kind has its own prior. Accuracies
    start at 0.8, which says which side is which, and stay in [0.55, 0.99].
    """
    n = len(LABELERS)
    right, prior = [0.8] * n, {k[0]: 0.5 for k in counts}
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for key in counts:
            odds = math.log(prior[key[0]] / (1 - prior[key[0]]))
            odds += sum(v * math.log(right[j] / (1 - right[j])) for j, v in enumerate(key[1:]))
            post[key] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
        for kind in prior:
            total = sum(c for k, c in counts.items() if k[0] == kind)
            mass = sum(c * post[k] for k, c in counts.items() if k[0] == kind)
            prior[kind] = min(0.95, max(0.02, (mass + 1) / (total + 2)))
        for j in range(n):
            voted = sum(c for k, c in counts.items() if k[1 + j])
            agree = sum(c * (post[k] if k[1 + j] > 0 else 1 - post[k]) for k, c in counts.items() if k[1 + j])
            right[j] = min(0.99, max(0.55, (agree + 8) / (voted + 10)))
    return post, dict(enumerate(right))


def train(rows: list[tuple[tuple, float, float]], rounds: int = 200, rate: float = 1.0, l2: float = 1e-3) -> dict[tuple, float]:
    """Logistic weights by feature from (features, weight, target probability) rows."""
    total = sum(w for _, w, _ in rows) or 1.0
    weights: dict[tuple, float] = {}
    square: dict[tuple, float] = {}
    for _ in range(rounds):
        grad: dict[tuple, float] = {}
        for features, w, target in rows:
            z = sum(weights.get(f, 0.0) for f in features)
            g = w / total * (1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) - target)
            for f in features:
                grad[f] = grad.get(f, 0.0) + g
        for f, g in grad.items():
            g += l2 * weights.get(f, 0.0)
            square[f] = square.get(f, 1e-8) + g * g
            weights[f] = weights.get(f, 0.0) - rate * g / math.sqrt(square[f])
    return weights


def _length_class(match: Column) -> Column:
    return F.least(F.floor(F.length(match) / 8), F.lit(8)).cast("int")


def detect(docs: DataFrame, decide: float = DECIDE) -> DataFrame:
    """``docs`` with base spans and all spans, as arrays of (kind, start, end).

    Added columns: ``base``, ``spans``, underscored where names clash. Needs a
    column text; null reads as empty. Offsets are code points, end exclusive;
    spans are ordered by kind (base kinds, then ``secret``) and start. Added
    spans never overlap a base span. Repeated rows get the same spans. An empty
    table gives an empty result; without proposals only base spans come out.

    The documents are read twice and not shuffled. The vote combinations are
    summed per task before the shuffle; the table that comes to the driver has
    at most 2 * 3**6 * 9 rows.
    """
    names = {c: internal(docs, c) for c in ("base", "spans")}
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select(F.explode(_proposals(text)).alias("x"))
    seen = seen.select(F.col("x.kind").alias("kind"), *[v.cast("int").alias(n) for n, v in votes(F.col("x")).items()], _length_class(F.col("x.match")).alias("size"))
    table = saved(seen.groupBy("kind", *LABELERS, "size").agg(F.count("*").alias("n")), "pii-votes").collect()
    counts: dict[tuple, float] = {}
    for r in table:
        key = (r["kind"], *[r[n] for n in LABELERS])
        counts[key] = counts.get(key, 0.0) + r["n"]
    post, _ = expectation_maximisation(counts)

    def features(r) -> tuple:
        return (("kind", r["kind"]), *[(r["kind"], n, r[n]) for n in LABELERS], (r["kind"], "size", r["size"]))

    weights = train([(features(r), float(r["n"]), post[(r["kind"], *[r[n] for n in LABELERS])]) for r in table])

    def probability(x: Column) -> Column:
        """The classifier as a sum of constants by vote."""
        cast = votes(x)
        parts = F.lit(0.0)
        for kind in PROPOSED:
            own = F.lit(weights.get(("kind", kind), 0.0))
            for name in [*LABELERS, "size"]:
                value = cast[name] if name != "size" else _length_class(x["match"])
                for (_, at), w in sorted(((f[1:], w) for f, w in weights.items() if f[0] == kind and len(f) == 3 and f[1] == name)):
                    own = own + F.when(value == at, w).otherwise(0.0)
            parts = parts + F.when(x["kind"] == kind, own).otherwise(0.0)
        return 1 / (1 + F.exp(-parts))

    kinds = {k: F.col(f"__{k}") for k in BASE}
    out = docs
    for kind, spans in base_spans(text).items():
        out = out.withColumn(f"__{kind}", spans)
    base = F.concat(*[_as_kind(F.lit(k), c) for k, c in kinds.items()])
    out = out.withColumn("__base", base)
    chosen = F.filter(_proposals(text), lambda x: (probability(x) >= decide) & ~F.exists(
        F.col("__base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    out = out.withColumn("__more", F.transform(chosen, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
    everything = F.flatten(F.array(*[F.sort_array(of_kind(F.concat("__base", "__more"), k)) for k in KINDS]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__base").alias(names["base"]), everything.alias(names["spans"]))


def _as_kind(kind: Column, found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(kind.alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
