"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words: a share of ``budget`` times all words in
proportion to its weight, stopped at ``limit`` times the source's size, the
excess reshared by weight until none is above.  A document of the source then
has target / size fractional copies.  Whole copies are taken as they are; the
fractions are rounded by the weighted pivotal method: two documents meet, and
words of copy mass move from one to the other, in a random direction with
odds that keep both expectations, until one of them is integral.  Each block
of a source leaves at most one fractional document; a reduction tree of
blocks, ``FAN_IN`` to one, combines those until one a source is left, which is
rounded to the nearer side; what that misses is made up, largest first, by
turning over documents that met in the same last block where that brings the
sum nearer.  So a source's taken words miss its target by less than half of
one document, mostly by a few words, and no document is taken more than
``limit`` times (a whole number).

All draws are hashes of the document ids that meet, and blocks are hashes of
ids, so reruns agree whatever the partitioning.  A hot source is many blocks.
Rows that repeat a doc_id, or have none, are numbered in the order of size and
source (rows equal in these are alike), and the number is hashed with the id, so
a hot id is many blocks too.

Defined results: a null text has size 0, and so has an empty one; such
documents take nothing.  A null source is a source of its own, the last one.
Rows that repeat a doc_id are documents of their own.  An empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from .common import WORD, prepare, small_side, stored

BLOCK_ROWS = 2000
FAN_IN = 64
_ROW = "doc_id long, no long, source string, size long, block long, blocks long, whole int, p double, open boolean"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(seed: int, a: int, b: int) -> float:
    x = (seed * 0x9E3779B97F4A7C15 + a * 0xBF58476D1CE4E5B9 + b * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    for shift in (30, 27, 31):
        x = ((x ^ (x >> shift)) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
    return (x >> 11) / (1 << 53)


def round_block(size: np.ndarray, p: np.ndarray, ids: np.ndarray, seed: int) -> np.ndarray:
    """Pivotal rounding in the given order: the new fractions, all but at most
    one of them 0 or 1, with the same sum of size * fraction."""
    p = p.astype(float).copy()
    held = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if held < 0:
            held = j
            continue
        i = held
        to_i = min((1 - p[i]) * size[i], p[j] * size[j])
        to_j = min(p[i] * size[i], (1 - p[j]) * size[j])
        if _uniform(seed, int(ids[i]), int(ids[j])) * (to_i + to_j) < to_j:
            moved = to_i
        else:
            moved = -to_j
        p[i] += moved / size[i]
        p[j] -= moved / size[j]
        for k in (i, j):
            p[k] = 0.0 if p[k] < 1e-9 else 1.0 if p[k] > 1 - 1e-9 else p[k]
        held = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return p


def close_block(size: np.ndarray, before: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Round the fraction that is left in a source's last block and turn over
    documents, largest first, while that brings the words nearer to before."""
    out = (p >= 0.5).astype(float)
    miss = float((size * out).sum() - (size * before).sum())
    for k in np.argsort(-size, kind="stable").tolist():
        turned = size[k] if out[k] == 0 else -size[k]
        if 0 < before[k] < 1 and abs(miss + turned) < abs(miss):
            out[k], miss = 1 - out[k], miss + turned
    return out


def _round_task(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # large documents first: what is left at the end is then mostly a small one
        pdf = pdf.sort_values(["size", "doc_id", "no"], ascending=[False, True, True], kind="stable")
        ids = pdf["doc_id"].fillna(0).to_numpy(np.int64) ^ (pdf["no"].to_numpy(np.int64) << 24)
        size, before = pdf["size"].to_numpy(np.int64), pdf["p"].to_numpy(float)
        p = round_block(size, before, ids, seed)
        if pdf["blocks"].iloc[0] <= 1:
            p = close_block(size, before, p)
        return pdf.assign(p=p, open=(p > 0) & (p < 1))
    return run


def source_targets(units: DataFrame, weights=(5, 2, 1), budget: float = 1.5, limit: int = 2) -> DataFrame:
    """(source, source_size, n, target) from (source, size).  The table has a row a
    source; a round of resharing brings two sums of it to the driver."""
    sums = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = surrogate_key(sums.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "rank", materialize=True)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = stored(ranked.select("source", "source_size", "n", w.alias("w")), "sources")
    row = src.agg(F.sum("source_size").alias("s"), F.sum("w").alias("w")).first()
    total = budget * (row.s or 0)
    level, above = total / (row.w or 1.0), -1
    cap = F.lit(limit) * F.col("source_size")
    while True:
        full = cap <= F.lit(level) * F.col("w")
        r = src.agg(F.sum(F.when(full, cap)).alias("c"), F.sum(F.when(~full, F.col("w"))).alias("w"),
                    F.count(F.when(full, 1)).alias("k")).first()
        if r.k == above or not r.w:
            break
        above, level = r.k, (total - (r.c or 0)) / r.w
    return src.select("source", "source_size", "n",
                      F.when(F.lit(level) * F.col("w") >= cap, cap.cast("double")).otherwise(F.lit(level) * F.col("w")).alias("target"))


def repeated_ids(ids: DataFrame) -> DataFrame:
    """The ids (column ``_id``, null too) that more than one row has."""
    return stored(ids.groupBy("_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("_id").alias("_rid"), F.lit(True).alias("_again")),
                  "repeated-ids")


def numbered(rows: DataFrame, repeated: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``_no``: 0 where the ``_id`` is not repeated, else 1, 2, ... within the
    id in the given order.  No window: the rows of one id are numbered by many tasks."""
    if repeated.isEmpty():
        return rows.withColumn("_no", F.lit(0).cast("long"))
    flagged = rows.join(small_side(repeated), F.col("_id").eqNullSafe(F.col("_rid")), "left").drop("_rid")
    once = flagged.where("_again is null").drop("_again").withColumn("_no", F.lit(0).cast("long"))
    # the last key spreads rows that are equal in all others
    again = flagged.where("_again").drop("_again").withColumn("_tie", F.monotonically_increasing_id())
    again = stored(surrogate_key(again, ["_id", *order, "_tie"], "_rank", materialize=True).drop("_tie"), "numbered")
    first = stored(again.groupBy("_id").agg(F.min("_rank").alias("_first")).withColumnRenamed("_id", "_rid"), "first-numbers")
    again = (again.join(small_side(first), F.col("_id").eqNullSafe(F.col("_rid")))
                  .withColumn("_no", (F.col("_rank") - F.col("_first") + 1).cast("long")).select(*once.columns))
    return once.unionByName(again)


def mix(docs: DataFrame, weights=(5, 2, 1), budget: float = 1.5, limit: int = 2, seed: int = 17,
        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size,
    source_size, target, copies, taken."""
    prepare(docs.sparkSession)
    units = stored(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size")), "units")
    targets = stored(source_targets(units, weights, budget, limit), "targets")
    side = small_side(targets.select(F.col("source").alias("_source"), "source_size", "n", "target"))
    share = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(limit)))).otherwise(0.0)
    known = units.withColumn("_id", F.col("doc_id"))
    known = numbered(known, repeated_ids(known.select("_id")), ["size", "source"]).drop("_id").withColumnRenamed("_no", "no")
    place = F.when(F.col("no") > 0, F.xxhash64(F.lit(seed), "doc_id", "no")).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
    rows = (known.join(side, F.col("source").eqNullSafe(F.col("_source")))
                 .withColumn("_f", share).withColumn("whole", F.floor("_f").cast("int"))
                 .withColumn("p", F.when(F.col("size") > 0, F.col("_f") - F.col("whole")).otherwise(0.0))
                 .withColumn("blocks", F.ceil(F.col("n") / block_rows))
                 .withColumn("block", F.pmod(place, F.col("blocks")))
                 .select("doc_id", "no", "source", "size", "block", "blocks", "whole", "p", (F.col("p") > 0).alias("open")))
    blocks = -(-(targets.agg(F.max("n")).first()[0] or 0) // block_rows)
    settled, level = [], 0
    while True:
        done = stored(rows.where("open").groupBy("source", "block").applyInPandas(_round_task(seed + level), _ROW), "rounded")
        settled += [rows.where("not open"), done.where("not open")]
        rows = done.where("open")
        if blocks <= 1:
            break
        blocks, level = -(-blocks // FAN_IN), level + 1
        rows = (rows.withColumn("block", F.floor(F.col("block") / FAN_IN))
                    .withColumn("blocks", F.ceil(F.col("blocks") / FAN_IN)))
    out = rows
    for part in settled:
        out = out.unionByName(part)
    copies = (F.col("whole") + (F.col("p") >= 0.5).cast("int")).alias("copies")
    return (out.select("doc_id", "source", "size", copies)
               .join(side, F.col("source").eqNullSafe(F.col("_source")))
               .select("doc_id", "source", "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def take(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the ``plan`` from ``mix`` says, with
    the columns of ``docs``.  Rows that repeat a doc_id are matched in the
    order of their size and source."""
    cols = docs.columns
    left = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                       word_count(F.col("text")).alias("_size"), F.col("source").cast("string").alias("_source"),
                       F.xxhash64(F.col("text")).alias("_hash"))
    right = stored(plan.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("source").alias("_source"), "copies"), "plan")
    repeated = repeated_ids(right.select("_id"))
    left = numbered(left, repeated, ["_size", "_source", "_hash"])
    right = (numbered(right, repeated, ["_size", "_source", "copies"])
             .where("copies > 0").select(F.col("_id").alias("_id2"), F.col("_no").alias("_no2"), "copies"))
    both = left.join(right, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_no") == F.col("_no2")))
    return both.withColumn("_copy", F.explode(F.expr("sequence(1, copies)"))).select(*[F.col("_row")[c].alias(c) for c in cols])
