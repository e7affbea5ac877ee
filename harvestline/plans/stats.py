"""Annual export statistics (SRC3 shape, PRJ9, PRJ19, AGG12, WIN3).

Binding: the driver's ``orders`` table plays the statistics file — one
row per year, free-on-board value by product column (order priority), a
total over the product columns (hazard H3: the total is the sum of the
fruit columns, never an all-goods figure) and an index to a base year with
the mean fallback (hazard H4).  Money is summed in cents, so the scaled
values and the index round exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import half_up_wide
from ..sources.tables import read_table

PRODUCTS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified",
            "5-LOW": "low"}
BASE_YEAR = 1995


def annual_fob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year × product FOB totals in cents, pivoted with explicit values."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_orderpriority", "o_totalprice"])
    cents = F.round(F.col("o_totalprice") * 100).cast("decimal(20,0)")
    aggs = [F.coalesce(F.sum(F.when(F.col("o_orderpriority") == k, cents)), F.lit(0)).cast("decimal(30,0)").alias(f"fob_{v}_cents")
            for k, v in PRODUCTS.items()]
    return (o.filter(F.col("o_orderdate").isNotNull())
             .groupBy(F.year("o_orderdate").alias("year")).agg(*aggs))


def export_statistics(spark: SparkSession, sf_dir: str, base_year: int = BASE_YEAR) -> DataFrame:
    """Clean statistics table: FOB in NZD millions (3 dp), total and the
    base-year index (1 dp); ``index_base`` says whether the base year or
    the mean was used."""
    a = annual_fob(spark, sf_dir)
    total = reduce(lambda x, y: x + y, [F.col(f"fob_{v}_cents") for v in PRODUCTS.values()])
    a = a.withColumn("total_cents", total)
    base = a.agg(F.max(F.when(F.col("year") == base_year, F.col("total_cents"))).alias("_base"),
                 F.sum("total_cents").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    j = a.crossJoin(F.broadcast(base))
    use_base = F.col("_base").isNotNull() & (F.col("_base") != 0)
    # index·10 = total/base·1000 (base path) or total·n/sum·1000 (mean path)
    # in DECIMAL, as a year's cents times 1000 outgrow a long
    idx_base = half_up_wide(F.col("total_cents"), F.lit(1000), F.col("_base"))
    idx_mean = half_up_wide(F.col("total_cents"), F.col("_n") * 1000, F.col("_sum"))
    idx = F.when(use_base, idx_base).when(F.col("_sum") > 0, idx_mean)
    cols = [F.col("year")]
    for v in PRODUCTS.values():
        cols.append((half_up_wide(F.col(f"fob_{v}_cents"), F.lit(1), F.lit(100_000)) / 1000.0).alias(f"fob_{v}_nzd_m"))
    cols += [(half_up_wide(F.col("total_cents"), F.lit(1), F.lit(100_000)) / 1000.0).alias("total_fob_nzd_m"),
             (idx / 10.0).alias("total_index"),
             F.when(use_base, F.lit(f"year {base_year}")).otherwise(F.lit("mean")).alias("index_base")]
    return j.select(*cols)
