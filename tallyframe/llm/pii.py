"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them.

Strict patterns give base spans of four kinds (email, ip, card, phone), which always stay. Looser
patterns add candidates: mail addresses spelled with (at) and (dot), phone numbers without a country
code, card numbers in groups of four and addresses with a port or a mistyped part. Three kinds of
labelers vote for, against or not at all on each candidate: regex (the strict pattern or its check),
gazetteer (known domain endings, issuer prefixes, number blocks) and context (telling words around).

Votes are counted over all documents per pattern of votes, at most a few hundred rows. On these counts
expectation maximisation estimates each labeler's reliability without any labels, and a logistic
classifier over the same votes is trained on the posteriors; it decides which candidates become spans.
Texts are handled with DataFrame functions only and never shuffled.

Matching is leftmost and non-overlapping. ``split`` on a pattern returns the text between its matches,
which gives every match its place; patterns start at the beginning of a run of their characters (or
where the last match ended) and use possessive repeats, so long runs cost linear time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, unused, written

KINDS = ("email", "ip", "card", "phone")

# Strict patterns. Each finds what the plain pattern of its kind finds after the kind's check, without
# its repeated scanning: a card is a whole chain of at least 13 digits.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser patterns, tried where a text has the sign in WIDE_SIGN.
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])(?![\x20-][0-9])",
    "phone": r"(?<![0-9])(?<![0-9+][\x20.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])(?![\x20.-][0-9])",
}
BASE_SIGN = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WIDE_SIGN = {"email": r"[(\[]at[)\]]", "ip": ":[0-9A-Fa-f]+:", "card": "[0-9]{4}[\x20-][0-9]{4}", "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# Gazetteer and context words.
DOMAINS = "com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ca|ch|at|nl|be|pl|br|mx|jp|cn|in"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35"
NOT_PUBLIC = r"0*(?:0|10|127)\.|0*192\.0*168\.|0*172\.0*(?:1[6-9]|2[0-9]|3[01])\."
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|adresse|addr",
    "card": "card|visa|credit|payment|karte|tarjeta|carte",
    "phone": r"phone|\btel|call|mobile|fax|telefon|llam|appel",
}
AGAINST = r"version|isbn|serial|order|invoice|\bref\b|\bid\b|\bno\b"
LABELERS = ("regex", "gazetteer", "context", "shape")
NEAR = 40


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]+", "")


def passes(kind: str, m: Column) -> Column:
    """The check of a base match."""
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return (F.length(digits(m)) <= 19) & F.call_function("luhn_check", digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    return F.lit(True)


def matches(text: Column, pattern: str, sign: str) -> Column:
    """All matches of a pattern: their text, what stands next to them, start and end in code points."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    def placed(gaps: Column) -> Column:
        parts = F.transform(found, lambda m, i: F.struct(
            m.alias("m"), F.right(F.get(gaps, i), F.lit(NEAR)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
            F.length(F.get(gaps, i)).alias("skip"), F.length(m).alias("size")))
        none = F.struct(F.array().cast("array<struct<m:string,before:string,after:string,start:int,end:int>>").alias("out"), F.lit(0).alias("at"))
        def add(a: Column, p: Column) -> Column:
            start = a["at"] + p["skip"]
            one = F.struct(p["m"], p["before"], p["after"], start.alias("start"), (start + p["size"]).alias("end"))
            return F.struct(F.array_append(a["out"], one).alias("out"), (start + p["size"]).alias("at"))
        return F.aggregate(parts, none, add, lambda a: a["out"])
    return F.when(text.rlike(sign), F.transform(F.array(gaps), placed)[0])


def gazetteer(kind: str, m: Column) -> Column:
    """1 where the value is of a known range, -1 where it is not, 0 where the list says nothing."""
    if kind == "email":
        return F.when(F.lower(m).rlike(rf"(?:\.|dot[)\]])\x20?(?:{DOMAINS})$"), 1).otherwise(-1)
    if kind == "ip":
        return F.when(m.rlike(f"^(?:{NOT_PUBLIC})"), 0).otherwise(1)
    if kind == "card":
        return F.when(digits(m).rlike(f"^(?:{ISSUERS})"), 1).otherwise(-1)
    return F.when(m.startswith("+"), F.when(m.rlike(r"^\+[1-9]"), 1).otherwise(-1)).when(digits(m).rlike("^[2-9]..[2-9]"), 1).otherwise(-1)


def candidate(kind: str, m: Column, base: bool) -> Column:
    """A span with the votes of all labelers."""
    near = F.lower(m["before"])
    if base:
        regex = F.lit(1)
    elif kind == "card":
        regex = F.when(F.call_function("luhn_check", digits(m["m"])), 1).otherwise(-1)
    else:
        regex = F.lit(0)
    context = F.when(near.rlike(CONTEXT[kind]), 1).when(near.rlike(AGAINST), -1).otherwise(0)
    glued = m["before"].rlike(r"[\p{L}\p{N}]$") | m["after"].rlike(r"^[\p{L}\p{N}]")
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(base).alias("base"),
        regex.alias("regex"), gazetteer(kind, m["m"]).alias("gazetteer"), context.alias("context"), F.when(glued, -1).otherwise(1).alias("shape"))


def with_candidates(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` and an array of all base spans, then all other candidates that overlap none of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,regex:int,gazetteer:int,context:int,shape:int>>")
    def found(kind: str, base: bool) -> Column:
        pattern, sign = (BASE[kind], BASE_SIGN[kind]) if base else (WIDE[kind], WIDE_SIGN[kind])
        kept = F.filter(matches(text, pattern, sign), lambda m: passes(kind, m["m"])) if base else matches(text, pattern, sign)
        return F.coalesce(F.transform(kept, lambda m: candidate(kind, m, base)), none)
    def together(base: Column) -> Column:
        wide = F.concat(*[found(k, False) for k in KINDS])
        return F.concat(base, F.filter(wide, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))))
    base = F.concat(*[found(k, True) for k in KINDS])
    return docs.withColumn(column, F.transform(F.array(base), together)[0])


@dataclass
class SpanClassifier:
    """Logistic scores over votes, and what EM found about the labelers."""

    kinds: list[float]
    weights: list[float]
    reliability: dict[str, float]

    def score(self, c: Column) -> Column:
        """Probability that a candidate is personal data."""
        z = F.array(*[F.lit(k) for k in self.kinds])[c["kind"]]
        for w, name in zip(self.weights, LABELERS):
            z = z + F.lit(w) * c[name]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def accepts(self, c: Column) -> Column:
        return c["base"] | (self.score(c) >= 0.5)


def vote_counts(docs: DataFrame, column: str) -> list[tuple]:
    """(kind, votes..., count) over all candidates: at most 4 kinds x 81 vote patterns."""
    votes = docs.select(F.explode(column).alias("c")).groupBy("c.kind", *[f"c.{n}" for n in LABELERS]).agg(F.count("*").alias("n"))
    return sorted(tuple(r) for r in votes.collect())


def train(counts: list[tuple], rounds: int = 60) -> SpanClassifier:
    """EM over vote patterns, then the classifier on its posteriors.

    Two classes, votes independent given the class, a prior per kind. Smoothing starts from labelers
    that are right more often than wrong, which also fixes which class is which.
    """
    n_kinds, votes = len(KINDS), (-1, 0, 1)
    prior = [0.5] * n_kinds
    start = {1: {-1: 0.2, 0: 0.3, 1: 0.5}, 0: {-1: 0.5, 0: 0.3, 1: 0.2}}
    table = [[dict(start[y]) for y in (0, 1)] for _ in LABELERS]
    posterior = [0.5] * len(counts)
    for _ in range(rounds):
        for i, (kind, *v, _) in enumerate(counts):
            yes, no = math.log(prior[kind]), math.log(1 - prior[kind])
            for l, x in enumerate(v):
                yes, no = yes + math.log(table[l][1][x]), no + math.log(table[l][0][x])
            posterior[i] = 1 / (1 + math.exp(min(700, no - yes)))
        for k in range(n_kinds):
            mine = [(p, c[-1]) for p, c in zip(posterior, counts) if c[0] == k]
            prior[k] = (5 + sum(p * n for p, n in mine)) / (10 + sum(n for _, n in mine))
        for l in range(len(LABELERS)):
            for y in (0, 1):
                mass = {x: 20 * start[y][x] for x in votes}
                for p, c in zip(posterior, counts):
                    mass[c[1 + l]] += (p if y else 1 - p) * c[-1]
                total = sum(mass.values())
                table[l][y] = {x: m / total for x, m in mass.items()}
    reliability = {name: 0.5 * (table[l][1][1] / (table[l][1][1] + table[l][1][-1]) + table[l][0][-1] / (table[l][0][1] + table[l][0][-1])) for l, name in enumerate(LABELERS)}

    # Logistic regression on soft labels by gradient steps; rows are vote patterns, weights their share.
    total = sum(c[-1] for c in counts) or 1
    bias, weights = [0.0] * n_kinds, [0.5] * len(LABELERS)
    for _ in range(2000):
        up_bias, up_weights = [-0.001 * b for b in bias], [-0.001 * (w - 0.5) for w in weights]
        for p, (kind, *v, n) in zip(posterior, counts):
            z = bias[kind] + sum(w * x for w, x in zip(weights, v))
            error = (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) * n / total
            up_bias[kind] += error
            for l, x in enumerate(v):
                up_weights[l] += error * x
        bias = [b + 0.5 * u for b, u in zip(bias, up_bias)]
        weights = [w + 0.5 * u for w, u in zip(weights, up_weights)]
    return SpanClassifier(bias, weights, reliability)


def spans_of(found: DataFrame, column: str, model: SpanClassifier) -> DataFrame:
    """``found`` with ``spans``: the accepted candidates (kind, start, end, base), by kind and start."""
    kept = F.filter(column, model.accepts)
    return found.withColumn("spans", F.sort_array(F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text.

    Needs ``doc_id`` and ``text``; other columns are ignored. One row a row: ``doc_id``, ``n_email``,
    ``n_ip``, ``n_card``, ``n_phone`` (base spans), ``base_sha256`` and ``spans`` (base and added ones).
    Null and empty texts have no spans. Repeated rows stay. An empty table gives no rows. Spans of
    different kinds may overlap; added spans never overlap a base span.
    """
    found = written(with_candidates(docs.select("doc_id", "text"), "candidates").drop("text"), "candidates")
    rows = spans_of(found, "candidates", train(vote_counts(found, "candidates")))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by its kind in brackets; texts without spans, and nulls, as they are.

    Overlapping spans become one placeholder, that of the first. Columns may have any names. The rows
    and their candidates are written once, so that texts are searched once.
    """
    column = unused(docs.columns, "candidates")
    found = written(with_candidates(docs, column), "candidates")
    model = train(vote_counts(found, column))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    def cleaned(wide: Column) -> Column:
        def cut(low: Column, high: Column) -> Column:
            return F.decode(F.substring(wide, low * 4 + 1, (high - low) * 4), "UTF-32")
        spans = F.sort_array(F.transform(F.filter(column, model.accepts), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
        none = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))
        def add(a: Column, s: Column) -> Column:
            more = F.concat(a["parts"], F.array(cut(a["at"], s["start"]), names[s["kind"]]))
            return F.struct(F.when(s["start"] >= a["at"], more).otherwise(a["parts"]).alias("parts"), F.greatest(a["at"], s["end"]).alias("at"))
        end = F.length(F.col("text"))
        return F.aggregate(spans, none, add, lambda a: F.array_join(F.concat(a["parts"], F.array(cut(a["at"], end))), ""))
    text = F.when(F.exists(column, model.accepts), F.transform(F.array(F.encode("text", "UTF-32")), cleaned)[0]).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    return personal_data(read_table(spark, folder, "documents"))
