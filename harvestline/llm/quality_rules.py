"""Quality rules as a bitmask ledger.

Every rule is evaluated once for every text.  The ledger keeps a bit for each
failed rule and the measurements behind them.  A policy is a versioned mask
of the rules it enforces; applying one, or asking what each of its rules
alone removes, is bit arithmetic over the ledger, without reading a text
again.  Everything is DataFrame expressions.

Defined results: a null text has no words and fails ``few_words`` alone; an
empty text likewise; rows are independent, so repeated rows repeat their
result; an empty table gives an empty ledger.  Repeated three-word windows
are told apart by a 64-bit hash of their words within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A name and the SQL condition, over measurements, under which it fails.  Its bit is its place in RULES."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("short_words", "n_words > 0 and word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("repeated_lines", "n_lines > 0 and 100 * n_dup_lines > 30 * n_lines"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}

#: Version → the rules it enforces.  Versions are never changed, only added.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(r.name for r in RULES),
}


def policy_mask(version: str) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (other than ``text``) as a struct ``_row`` and the measurements."""
    kept = [c for c in docs.columns if c != text]
    df = docs.select(F.struct(*kept).alias("_row") if kept else F.lit(None).alias("_row"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    df = df.withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
    windows = F.expr("if(size(_w) < 3, cast(array() as array<bigint>), transform(arrays_zip("
                     "slice(_w, 1, size(_w) - 2), slice(_w, 2, size(_w) - 2), slice(_w, 3, size(_w) - 2)), "
                     "x -> xxhash64(x.`0`, x.`1`, x.`2`)))")
    lines = F.expr(f"filter(split(_t, '\\n', -1), x -> x rlike '{WORD.replace(chr(92), chr(92) * 2)}')")
    df = df.select("_row", "_t", F.size("_w").cast("long").alias("n_words"), windows.alias("_h"),
                   F.expr("if(contains(_t, '\\n'), 1, 0)").alias("_many"), lines.alias("_l"))
    # positions of windows that occur twice or more: neighbours in the order of their hashes
    df = df.withColumn("_o", F.expr(
        "if(size(array_distinct(_h)) = size(_h), null, "
        "sort_array(transform(_h, (x, i) -> struct(x as h, i as i))))"))
    df = df.withColumn("_p", F.expr(
        "if(_o is null, null, sort_array(transform(filter(arrays_zip(_o, concat(array(null), slice(_o, 1, size(_o) - 1)), "
        "concat(slice(_o, 2, size(_o) - 1), array(null))), "
        "x -> coalesce(x._o.h = x.`1`.h, false) or coalesce(x._o.h = x.`2`.h, false)), x -> x._o.i)))"))
    covered = F.expr("if(_p is null, 0L, aggregate(_p, struct(0L as n, -3 as last), "
                     "(a, i) -> struct(a.n + least(3, i - a.last) as n, i as last), a -> a.n))")
    bare = F.length(F.translate("_t", " \t\n\x0b\x0c\r", ""))
    symbols = F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))
    return df.select("_row", "n_words", bare.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
                     F.size("_l").cast("long").alias("n_lines"),
                     (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                     covered.cast("long").alias("n_repeat_words"))


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(BIT[rule.name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, measurements, failed): every rule evaluated once for every row."""
    return (measured(docs.select(key, text), text)
            .select(F.col("_row")[key].alias(key), *MEASURES, failure_bits().alias("failed")))


def passes(version: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0


def ablation(book: DataFrame, version: str = "v1") -> DataFrame:
    """For each rule of a policy: rows that fail it, rows it alone removes, and rows kept without it."""
    mask = F.lit(policy_mask(version)).cast("long")
    broken = F.col("failed").bitwiseAND(mask)
    counts = (book.select(broken.alias("b")).groupBy("b").count())  # at most 2**rules rows
    rules = [F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit")) for n in POLICIES[version]]
    each = counts.withColumn("r", F.explode(F.array(*rules))).withColumn("bit", F.col("r.bit"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("count"))), F.lit(0)).cast("long")

    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("b").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(F.col("b") == F.col("bit")).alias("removed_alone"),
        total((F.col("b") == 0) | (F.col("b") == F.col("bit"))).alias("kept_without"))
