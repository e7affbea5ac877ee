"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Everything is DataFrame expressions.  A pattern's matches (leftmost, not
overlapping) are extracted and the text is split at the same pattern; the
lengths of both give every match's place in code points.  Validators then
confirm: octets of an address up to 255, Luhn for cards, 8 to 15 digits for
phones, mod-97 for IBANs.  A confirmed span starts with the score of its kind
and gains ``CONTEXT_GAIN`` when one of the kind's context words stands within
``CONTEXT`` code points before it.  Kinds of ``BASE`` are always reported;
the others from ``least_score`` on: an account number is digits like any
others, starts below it, and is reported only where its context names it.

The patterns are written so that matching is linear and never recurses:
possessive runs, and starts only where a run begins or the last match ended.
They find the same spans as the plain forms in the comments.

Defined results: a null text is empty; an empty text has no spans; spans of
different kinds may overlap; rows are independent, so repeated rows repeat
their result; other columns are kept (the output column replaces a column of
the same name); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("iban", "account")
CONTEXT = 40
CONTEXT_GAIN = 0.2

PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 16 to 19 digits: a whole run of digits with single separators
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    # a whole run of 8 to 12 digits, no part of a word, number or longer code
    "account": r"(?<![A-Za-z0-9.+-])[0-9]{8,12}+(?![A-Za-z0-9]|[.-][0-9])",
}
#: A text without this character has no match, so no pattern runs over it.
NEEDS = {"email": "@", "phone": "+"}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "account": 0.6}
CONTEXT_WORDS = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse",
    "card": "card|credit|visa|mastercard|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|telefono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "account": "account|konto|compte|cuenta",
}


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _valid(kind: str) -> str:
    """SQL condition on a matched string ``v``."""
    digits = "regexp_replace(v, '[^0-9]', '')"
    if kind == "ip":
        return (r"forall(split(v, '[.]'), o -> length(regexp_replace(o, '^0+', '')) <= 3 "
                r"and cast(concat('0', right(o, 3)) as int) <= 255)")
    if kind == "card":
        doubled = (f"transform(split(reverse({digits}), ''), (c, i) -> cast(c as int) * (1 + i % 2))")
        return f"aggregate({doubled}, 0, (a, x) -> a + if(x > 9, x - 9, x)) % 10 = 0"
    if kind == "phone":
        return f"length({digits}) between 8 and 15"
    if kind == "iban":
        bare = "regexp_replace(v, ' ', '')"
        value = "if(c between '0' and '9', ascii(c) - 48, ascii(c) - 55)"
        return (f"length({bare}) between 15 and 34 and aggregate(split(concat(substr({bare}, 5), left({bare}, 4)), ''), 0, "
                f"(a, c) -> (a * if({value} > 9, 100, 10) + {value}) % 97) = 1")
    return "true"


def _placed(kind: str) -> str:
    """SQL array of (s, e, v) for the matches in ``_f_kind`` of a text split into ``_g_kind``."""
    return (f"aggregate(arrays_zip(_f_{kind}, slice(_g_{kind}, 1, size(_f_{kind}))), "
            "cast(struct(0, array()) as struct<at: int, out: array<struct<s: int, e: int, v: string>>>), "
            f"(a, x) -> struct(a.at + length(x.`1`) + length(x._f_{kind}) as at, "
            f"concat(a.out, array(struct(a.at + length(x.`1`) as s, a.at + length(x.`1`) + length(x._f_{kind}) as e, "
            f"x._f_{kind} as v))) as out), a -> a.out)")


def with_spans(docs: DataFrame, text: str = "text", name: str = "pii_spans", least_score: float = 0.8) -> DataFrame:
    """``docs`` with an array column of spans (kind, start, end, score), by kind as
    listed in ``KINDS``, then start; code points, end exclusive."""
    kept = [c for c in docs.columns if c != name]
    df = docs.select(F.struct(*kept).alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    for kind in KINDS:
        found = f"regexp_extract_all(_t, {_sql(PATTERNS[kind])}, 0)"
        none = "cast(array() as array<string>)"
        df = df.withColumn(f"_f_{kind}", F.expr(f"if(contains(_t, '{NEEDS[kind]}'), {found}, {none})" if kind in NEEDS else found))
    for kind in KINDS:
        df = df.withColumn(f"_g_{kind}", F.expr(
            f"if(size(_f_{kind}) > 0, split(_t, {_sql(PATTERNS[kind])}, -1), cast(array() as array<string>))"))
    parts = []
    for k, kind in enumerate(KINDS):
        near = f"lower(substr(_t, greatest(p.s - {CONTEXT}, 0) + 1, least(p.s, {CONTEXT}))) rlike '\\\\b({CONTEXT_WORDS[kind]})'"
        spans = (f"transform(filter({_placed(kind)}, p -> exists(array(p.v), v -> {_valid(kind)})), "
                 f"p -> struct('{kind}' as kind, p.s as start, p.e as end, "
                 f"cast(least(1.0, {SCORES[kind]} + if({near}, {CONTEXT_GAIN}, 0.0)) as double) as score))")
        if kind not in BASE:
            spans = f"filter({spans}, p -> p.score >= {least_score})"
        parts.append(f"if(size(_f_{kind}) > 0, {spans}, "
                     "cast(array() as array<struct<kind: string, start: int, end: int, score: double>>))")
    return (df.withColumn("_spans", F.expr(f"concat({', '.join(parts)})"))
              .select(*[F.col("_row")[c].alias(c) for c in kept], F.col("_spans").alias(name)))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"])), ",")


def redact(docs: DataFrame, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """``docs`` without the ``spans`` column, each span of ``text`` replaced by <KIND>
    (of spans that overlap, the first; the rest of the others is removed)."""
    kept = [c for c in docs.columns if c != spans]
    body = F.expr(
        "aggregate(array_sort(transform(_s, p -> struct(p.start as start, -p.end as last, p.kind as kind))), "
        "cast(struct(0, array()) as struct<at: int, out: array<string>>), "
        "(a, p) -> struct(greatest(a.at, -p.last) as at, if(p.start >= a.at, concat(a.out, "
        "array(substr(_t, a.at + 1, p.start - a.at), concat('<', upper(p.kind), '>'))), a.out) as out), "
        "a -> concat(array_join(a.out, ''), substr(_t, a.at + 1)))")
    df = docs.select(F.struct(*kept).alias("_row"), F.col(text).alias("_t"), F.col(spans).alias("_s"))
    new = F.when(F.size("_s") > 0, body).otherwise(F.col("_t"))
    return df.select(*[new.alias(c) if c == text else F.col("_row")[c].alias(c) for c in kept])
