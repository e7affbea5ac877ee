"""Join operators (JN1–JN12, FLT6–FLT8).

Broadcast policy: only tables whose size is bounded by construction (fixed
reference tables, date spines, per-partition counts) are broadcast with an
explicit hint.  Everything else is left to Catalyst + AQE, which broadcast a
side only when its measured size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise run a
sort-merge join, splitting skewed partitions
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def attach(df: DataFrame, dim: DataFrame, keys, cols, how: str = "left", fixed_size: bool = False) -> DataFrame:
    """Left equi-join of selected dimension columns on ``keys`` (JN1–JN4).

    ``fixed_size=True`` marks a dimension whose row count does not grow with
    the data (e.g. five corridors, a date spine); it is then broadcast.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    right = dim.select(*keys, *cols)
    if fixed_size:
        right = F.broadcast(right)
    return df.join(right, keys, how)


def lookup_with_default(df: DataFrame, cfg: DataFrame, key: str, value: str, default, out: str | None = None) -> DataFrame:
    """Config lookup with a default for missing keys (JN10).  ``cfg`` is a
    small fixed table and is broadcast."""
    right = F.broadcast(cfg.select(F.col(key), F.col(value).alias("_v")))
    return (df.join(right, key, "left")
              .withColumn(out or value, F.coalesce(F.col("_v"), F.lit(default)))
              .drop("_v"))


def exists_in(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows whose key exists in ``other`` (FLT7, left_semi)."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def orphans(df: DataFrame, dim: DataFrame, keys) -> DataFrame:
    """Rows whose key has no dimension row (JN7/FLT8, left_anti).  Rows with
    a null key are orphans too, as in ``LEFT JOIN … WHERE dim.key IS NULL``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(dim.select(*keys), keys, "left_anti")


def in_range(df: DataFrame, cfg: DataFrame, key: str, value: str, lo: str, hi: str) -> DataFrame:
    """Keep rows whose ``value`` lies in the configured [lo, hi] window for
    their ``key`` (FLT6: variety harvest window ∋ pack week).  ``cfg`` is a
    fixed-size table and is broadcast; the range test is a filter after an
    equi-join on ``key``, never a theta join."""
    c = F.broadcast(cfg.select(F.col(key), F.col(lo).alias("_lo"), F.col(hi).alias("_hi")))
    return (df.join(c, key).filter(F.col(value).between(F.col("_lo"), F.col("_hi")))
              .drop("_lo", "_hi"))


def as_of(df: DataFrame, versions: DataFrame, date_col: str, version_col: str, keys=()) -> DataFrame:
    """Each row of ``df`` with the version of its key that is valid at its date: the
    latest whose ``version_col`` is not after ``date_col`` (JN12); nulls where there is none.

    Only the distinct days of a key are put in order with its versions, a
    partition that the calendar bounds; the rows are joined on key and day by
    equality.  Of versions of one day the greatest counts (all columns, in order).
    """
    keys = list(keys)
    cols = [c for c in versions.columns if c not in keys]
    known = versions.withColumn("_day", F.col(version_col).try_cast("date")).where("_day is not null").groupBy(*keys, "_day").agg(
        F.max(F.struct(*cols)).alias("_version"))
    asked = df.where(F.col(date_col).isNotNull()).select(*keys, F.col(date_col).cast("date").alias("_day")).distinct()
    days = known.withColumn("_row", F.lit(0)).unionByName(
        asked.withColumns({"_version": F.lit(None).cast(known.schema["_version"].dataType), "_row": F.lit(1)}))
    order = Window.partitionBy(*keys).orderBy("_day", "_row")
    valid = days.withColumn("_version", F.last("_version", ignorenulls=True).over(order)).where("_row = 1").drop("_row")
    rows = df.withColumn("_day", F.col(date_col).cast("date"))
    return rows.join(valid, [*keys, "_day"], "left").select(*[F.col(c) for c in df.columns], *[F.col(f"_version.{c}").alias(c) for c in cols])


def share_of_total(df: DataFrame, c: str, out: str = "share") -> DataFrame:
    """Each row's share of the column total (JN11) — a one-row aggregate
    broadcast back, instead of an unpartitioned window over all rows."""
    tot = df.agg(F.sum(c).alias("_tot"))
    return df.crossJoin(F.broadcast(tot)).withColumn(out, F.col(c) / F.col("_tot")).drop("_tot")
