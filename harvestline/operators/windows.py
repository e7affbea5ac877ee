"""Window and group-transform operators (WIN1–WIN3, WIN5–WIN7).

None of these uses an unpartitioned window over raw rows: global
statistics are one-row aggregates joined back by broadcast, and per-group
statistics are grouped aggregates joined back on the group key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import half_up_div


def group_medians(df: DataFrame, c: str, keys, weight: str | None = None) -> DataFrame:
    """(keys, median): the exact median of the non-null values of each group (WIN1).

    Values are counted (rows, or their ``weight``), sorted by group and value
    across the cluster, and given the number of rows before them; the one or two
    values that hold the middle ranks of their group are the median.  A group's
    values spread over as many tasks as they fill, so no task holds a hot group.
    """
    from .keys import prefix_sums
    keys = list(keys)
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counted = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(rows.cast("long").alias("_n"))
    placed = prefix_sums(counted, [*keys, c], {"_before": "_n"})
    spans = placed.groupBy(*keys).agg(F.min("_before").alias("_first"), F.sum("_n").alias("_rows"))
    at = F.col("_before") - F.col("_first")

    def holds(rank):
        return (at <= rank) & (rank < at + F.col("_n"))

    low, high = holds(F.expr("(_rows - 1) div 2")), holds(F.expr("_rows div 2"))
    middle = placed.join(spans, keys).where(low | high)
    return middle.groupBy(*keys).agg(
        (F.max(F.when(low, F.col(c))) * 0.5 + F.max(F.when(high, F.col(c))) * 0.5).alias("median"))


def impute_group_median(df: DataFrame, c: str, keys) -> DataFrame:
    """Fill nulls in ``c`` with the median of its group; row count kept (WIN1).

    Only rows with a null value are joined to the medians, so the bulk of the
    table never moves for the imputation.  A group whose values are all null
    stays null, like a pandas transform.
    """
    keys = list(keys)
    med = group_medians(df, c, keys).withColumnRenamed("median", "_med")
    nulls = df.filter(F.col(c).isNull())
    filled = (nulls.join(med, keys, "left")
                   .withColumn(c, F.col("_med").cast(df.schema[c].dataType)).drop("_med")
                   .select(*df.columns))
    return df.filter(F.col(c).isNotNull()).unionByName(filled)


def minmax_rescale_fixed(df: DataFrame, c: str, out: str, dp_in: int = 2, dp_out: int = 1,
                         constant: float = 25.0) -> DataFrame:
    """Global min–max rescale to 0–100 rounded half-up to ``dp_out`` (WIN2);
    a constant column maps to ``constant``.  Exact for fixed-point input:
    min and max come from one aggregate row that is broadcast back."""
    k_in = 10 ** dp_in
    xi = F.round(F.col(c) * float(k_in)).cast("long")
    mm = df.agg(F.min(xi).alias("_lo"), F.max(xi).alias("_hi"))
    j = df.crossJoin(F.broadcast(mm))
    scaled = half_up_div((xi - F.col("_lo")) * (100 * 10 ** dp_out), F.col("_hi") - F.col("_lo")) / float(10 ** dp_out)
    return (j.withColumn(out, F.when(F.col("_hi") > F.col("_lo"), scaled).otherwise(F.lit(constant)))
             .drop("_lo", "_hi"))


def base_index(df: DataFrame, c: str, year_col: str, base_year: int, out: str, dp: int = 1) -> DataFrame:
    """Index to a base year = 100, falling back to the column mean when the
    base year is absent or 0 (WIN3).  ``index_base`` reports which path ran.
    The base is a one-row aggregate broadcast back."""
    base = df.agg(
        F.max(F.when(F.col(year_col) == base_year, F.col(c))).alias("_base"),
        F.avg(c).alias("_mean"))
    j = df.crossJoin(F.broadcast(base))
    use_base = F.col("_base").isNotNull() & (F.col("_base") != 0)
    denom = F.when(use_base, F.col("_base")).otherwise(F.col("_mean"))
    return (j.withColumn(out, F.round(F.col(c) / F.when(denom != 0, denom) * 100.0, dp))
             .withColumn("index_base", F.when(use_base, F.lit(f"year {base_year}")).otherwise(F.lit("mean")))
             .drop("_base", "_mean"))


def rolling_sum_days(df: DataFrame, partition, day_col: str, value_col: str, days: int, out: str) -> DataFrame:
    """Trailing ``days``-day sum per partition (WIN6), e.g. 7-day rainfall.

    Apply it to a daily series (one row per place × day): a window
    partition then holds one place's days, bounded by the calendar.
    """
    w = (Window.partitionBy(*partition).orderBy(F.unix_date(F.col(day_col)))
         .rangeBetween(-(days - 1), 0))
    return df.withColumn(out, F.sum(value_col).over(w))


def marginal_change(df: DataFrame, order_col: str, value_col: str, out: str) -> DataFrame:
    """Change of ``value_col`` from the previous band (WIN7, elasticity).
    Use on an aggregated band table (one row per band): the ordered window
    holds only the bands."""
    w = Window.orderBy(order_col)
    return df.withColumn(out, F.col(value_col) - F.lag(value_col).over(w))
