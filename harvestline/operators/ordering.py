"""Sorts, top-k and set operations (SRT1–SRT6, SET1–SET2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k(df: DataFrame, k: int, order) -> DataFrame:
    """Global top-k (SRT2).  ``orderBy().limit()`` plans as
    TakeOrderedAndProject: each task keeps its own k best rows, so only
    k × tasks rows ever reach the final merge."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, keys, order, n: int = 1) -> DataFrame:
    """Top-n per group (SRT3) with a ranking window partitioned by the keys.

    Use it on already-aggregated input (one row per group × candidate), so a
    group's window partition is bounded by the candidate count, not by raw rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, order_col: str, cols) -> DataFrame:
    """Latest row by ``order_col`` (SRT4) as one aggregate: max over a struct
    led by the order column.  Partial maxima are combined map-side."""
    s = F.max(F.struct(F.col(order_col), *[F.col(c) for c in cols])).alias("_m")
    return df.agg(s).select(*[F.col(f"_m.{c}").alias(c) for c in [order_col, *cols]])


def rank_abs(df: DataFrame, c: str) -> DataFrame:
    """Order by magnitude, largest first (SRT5)."""
    return df.orderBy(F.abs(F.col(c)).desc())


def union_all(dfs) -> DataFrame:
    """Union by column name of same-schema inputs (SET1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """Distinct listing (SET2/AGG15)."""
    return df.select(c).distinct()
