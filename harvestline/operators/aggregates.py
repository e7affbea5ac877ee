"""Aggregate building blocks (AGG1–AGG3, AGG8–AGG10, AGG14–AGG15, AGG23–AGG24).

Rounding policy: a published ``ROUND(avg/ratio, n)`` is reproduced exactly
by rounding half-up in integer arithmetic over fixed-point inputs, and money
is summed as DECIMAL.  The result is the same for any partitioning or
summation order, and the same on any SQL engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col, half_up_div


def count_if(cond) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) — AGG2 (0, not null, on no match)."""
    return F.sum(F.when(col(cond), 1).otherwise(0)).cast("long")


def sum_if(cond, value) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE 0 END) — AGG2."""
    return F.sum(F.when(col(cond), col(value)).otherwise(F.lit(0)))


def pct(num, den, dp: int = 1) -> Column:
    """100·num/den rounded half-up to ``dp`` decimals (AGG3); null when den = 0."""
    scale = 10 ** dp
    n, d = col(num).cast("long"), col(den).cast("long")
    return F.when(d > 0, half_up_div(n * (100 * scale), d) / float(scale))


def fixed_int(c, dp_in: int) -> Column:
    """A fixed-point DOUBLE with ``dp_in`` decimals as an exact integer."""
    return F.round(col(c) * float(10 ** dp_in)).cast("long")


def avg_fixed(c, dp_in: int, dp_out: int) -> Column:
    """ROUND(AVG(c), dp_out) for a column holding ``dp_in`` decimals, exact (AGG1)."""
    x = fixed_int(c, dp_in)
    s, n = F.sum(x), F.count(x)
    if dp_out >= dp_in:
        q = half_up_div(s * (10 ** (dp_out - dp_in)), n)
    else:
        q = half_up_div(s, n * (10 ** (dp_in - dp_out)))
    return F.when(n > 0, q / float(10 ** dp_out))


def money_sum(c, cond=None) -> Column:
    """Exact DECIMAL sum of a money column (optionally of rows where ``cond``)."""
    v = col(c).cast("decimal(18,2)")
    if cond is not None:
        v = F.when(col(cond), v).otherwise(F.lit(Decimal("0.00")).cast("decimal(18,2)"))
    return F.sum(v)


def money_scaled(total: Column, divisor: int, dp: int) -> Column:
    """ROUND(total / divisor, dp) in exact decimal arithmetic, returned as DOUBLE."""
    factor = F.lit(Decimal(1) / Decimal(divisor))
    return F.round(total * factor, dp).cast("double")


def avg_round(c, dp: int) -> Column:
    """ROUND(AVG(c), dp) on a DOUBLE column (no fixed-point structure)."""
    return F.round(F.avg(col(c)), dp)


# --------------------------------------------------------------------------
# Profiles
# --------------------------------------------------------------------------

def numeric_profile(df: DataFrame) -> DataFrame:
    """min / max / avg of every numeric column as long-format rows (AGG23).

    One aggregate pass; the wide row is unpivoted with ``stack``.
    """
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "decimal", "byte")]
    if not num:
        return df.sparkSession.createDataFrame([], "column string, min double, max double, avg double")
    aggs = []
    for c in num:
        aggs += [F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max"),
                 F.avg(F.col(c).cast("double")).alias(f"{c}__avg")]
    wide = df.agg(*aggs)
    stack = "stack({n}, {items}) as (column, min, max, avg)".format(
        n=len(num), items=", ".join(f"'{c}', `{c}__min`, `{c}__max`, `{c}__avg`" for c in num))
    return wide.selectExpr(stack)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, one aggregate pass (AGG24)."""
    cols = df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = "stack({n}, {items}) as (column, null_count)".format(
        n=len(cols), items=", ".join(f"'{c}', n{i}" for i, c in enumerate(cols)))
    return wide.selectExpr(stack)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that exactly repeat an earlier row: count − distinct count (AGG24)."""
    return df.groupBy(*df.columns).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def value_counts(df: DataFrame, c: str, dp: int = 1) -> DataFrame:
    """Count per value with its share of all rows (AGG21).  The share uses a
    window over the grouped rows only (one row per distinct value)."""
    from pyspark.sql.window import Window
    g = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return g.withColumn("pct", pct("n", total, dp))


# --------------------------------------------------------------------------
# Sketches: mergeable summaries of unbounded columns (AGG10, AGG14)
# --------------------------------------------------------------------------

HLL_LG_K = 12
#: Three standard errors of a distinct count by a sketch of 2**HLL_LG_K registers.
HLL_BOUND = 3 * 1.04 / 2 ** (HLL_LG_K / 2)
KLL_K = 400
#: Rank error of a KLL quantile, 99 % of the time, for that k.
KLL_BOUND = 2.446 / KLL_K ** 0.9433


def distinct_sketches(df: DataFrame, cols, keys) -> DataFrame:
    """AGG14: a HyperLogLog sketch of each column by group, 4 KB each, to be stored."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_LG_K)).alias(c) for c in cols])


def distinct_of_sketches(sketches: DataFrame, cols, keys=()) -> DataFrame:
    """Distinct counts of unions of stored sketches: no row is read again, and what
    several groups hold counts once."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in cols])


def quantile_sketches(df: DataFrame, c: str, keys) -> DataFrame:
    """AGG10: a KLL sketch of an unbounded column by group, to be stored."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias("sketch"))


def quantiles_of_sketches(sketches: DataFrame, keys, ranks: dict[str, float]) -> DataFrame:
    """Quantiles of merged sketches: ``ranks`` gives their names and ranks."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("_s"))
    return merged.select(*keys, F.kll_sketch_get_n_double("_s").alias("n"),
                         *[F.kll_sketch_get_quantile_double("_s", F.lit(r)).alias(k) for k, r in ranks.items()])
