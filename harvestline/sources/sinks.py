"""Sinks (SNK1–SNK6, SNK9, SNK11–SNK12) and the materialised star build.

Writes are plain DataFrame writes; publishing is write-audit-publish: the
new output goes to a version folder, is checked there, and only then does a
pointer name it, so readers never see a failed or half-written batch.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.scalars import season_year
from ..session import checkpoint_dir
from .tables import drop_path, read_table


def write_table(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite", fmt: str = "parquet", **options) -> str:
    """SNK1: overwrite (or append) a table, optionally partitioned."""
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return path


#: Rows of one reading are dealt to so many cells, so that a hot reading is many tasks.
READING_CELLS = 16
#: A reading's key without nulls, so that it joins by equality: ``k_`` columns stand for season, week and variety.
READING = ["kpin", "k_season", "k_week", "k_variety"]
CELL = [*READING, "cell"]


def stage_submissions(spark: SparkSession, sf_dir: str, table: str, path: str) -> DataFrame:
    """The numbered submissions, stored in buckets of the reading cell: all that
    the build needs from the raw tables, read and shuffled once.  Only what the
    rest of a submission follows from is moved and stored; readers derive it."""
    from . import bindings
    day = F.to_date("l_shipdate")
    cell = {"kpin": bindings.kpin_of("l_suppkey"), "k_season": F.coalesce(season_year(day), F.lit("")), "k_week": F.coalesce(F.weekofyear(day), F.lit(0)),
            "k_variety": F.coalesce("variety", F.lit("")), "cell": F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(READING_CELLS)).cast("int")}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lineitem = read_table(spark, sf_dir, "lineitem", bindings.LINEITEM_COLS).withColumn("l_shipdate", day)
    rows = bindings.varieties(spark, sf_dir, lineitem).repartition(n, *[cell[c] for c in CELL])
    (rows.withColumns(cell).drop("l_suppkey", "variety").write.bucketBy(n, *CELL).sortBy(*CELL, "l_orderkey", "l_linenumber")
         .options(path=path, compression="zstd").mode("overwrite").saveAsTable(table))
    stored = spark.table(table).withColumns({"l_suppkey": F.col("kpin") - bindings.KPIN_BASE, "variety": F.when(F.col("k_variety") != "", F.col("k_variety"))})
    return bindings.described(stored, *bindings.numbers(), *CELL[1:])


def star_keys(staged: DataFrame, growers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings with their dense keys, and by reading cell what its submissions get.

    ``fruit_key`` numbers the readings in order; the number of submissions of all
    readings before one (and of the cells before one) is where the ``export_id``s
    of a cell start.  A reading without a grower is left out, as its submissions are.
    The cells move once, into ranges of the order, and are pooled and numbered there.
    """
    from ..operators.keys import running_sums
    cells = staged.groupBy(*CELL).agg(
        F.max("pest_indicator").alias("pest_indicator"),  # one value a grower
        F.sum("dm_centi").alias("dm_sum"), F.count(F.lit(1)).alias("n"), F.min("submission_date").alias("reading_date"))
    order = ["k_season", "kpin", "k_week", "k_variety"]
    known = cells.join(growers.select("kpin", "subzone", "grower_key"), "kpin")
    ranged = known.repartitionByRange(int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    counted = ranged.groupBy(*READING, "subzone", "grower_key").agg(
        F.max("pest_indicator").alias("pest_indicator"), F.sum("dm_sum").alias("dm_sum"), F.sum("n").alias("n"), F.min("reading_date").alias("reading_date"),
        F.array_sort(F.collect_list(F.struct("cell", "n"))).alias("cells"))  # READING_CELLS at most
    # growers that repeat a kpin share its readings: the later key comes first
    numbered = running_sums(counted.withColumn("one", F.lit(1).cast("long")), [*order, F.desc("grower_key")], {"fruit_key": "one", "first": "n"})
    numbered = numbered.withColumns({
        "fruit_key": F.col("fruit_key") + 1, "season": F.when(F.col("k_season") != "", F.col("k_season")),
        "pack_week": F.when(F.col("k_week") != 0, F.col("k_week")), "variety": F.when(F.col("k_variety") != "", F.col("k_variety"))}).drop("one")
    each = numbered.select(*READING, "subzone", "grower_key", "fruit_key", "first", "cells", F.posexplode("cells").alias("_at", "_cell"))
    earlier = F.aggregate(F.slice("cells", F.lit(1), F.col("_at")), F.lit(0).cast("long"), lambda acc, c: acc + c["n"])
    starts = each.select(*READING, F.col("_cell.cell").alias("cell"), "subzone", "grower_key", "fruit_key", (F.col("first") + earlier).alias("first"))
    return numbered.drop("cells", "first"), starts


def build_star(spark: SparkSession, sf_dir: str, out_dir: str, **fact_kw) -> dict:
    """SNK4: materialise the star schema, dimensions before the fact.

    The raw submissions are read once and shuffled once, into buckets of their
    reading cell.  Readings, keys and fact all start from the buckets: the fact
    joins its keys and numbers its rows without moving.  All surrogate keys are
    dense and follow from the rows alone.  The fact is partitioned by season so
    season-sliced reads (SRC8) prune.  Returns the written paths.
    """
    from ..operators.keys import surrogate_key
    from ..plans import star

    run = uuid.uuid4().hex
    table, stage_path = f"star_stage_{run}", os.path.join(checkpoint_dir(spark), "scratch", f"star-{run}")
    paths = {}
    staged = stage_submissions(spark, sf_dir, table, stage_path)
    tdim = star.dim_time(spark, staged)
    cor = star.dim_corridor(spark)
    paths["dim_time"] = write_table(tdim, os.path.join(out_dir, "dim_time"))
    paths["dim_corridor"] = write_table(cor, os.path.join(out_dir, "dim_corridor"))
    growers = surrogate_key(star.dim_grower(spark, sf_dir, cor), ["kpin"], "grower_key")
    paths["dim_grower"] = write_table(growers, os.path.join(out_dir, "dim_grower"))
    readings, starts = star_keys(staged, spark.read.parquet(paths["dim_grower"]))
    paths["dim_fruit_quality"] = write_table(star.fruit_columns(star.reading_columns(readings), "fruit_key"), os.path.join(out_dir, "dim_fruit_quality"), compression="zstd")
    f = star_fact(spark, sf_dir, staged, starts, spark.read.parquet(paths["dim_time"]), **fact_kw)
    paths["fact_export_transactions"] = write_table(f, os.path.join(out_dir, "fact_export_transactions"), partition_by="season", compression="zstd")
    spark.sql(f"DROP TABLE {table}")
    drop_path(spark, stage_path)
    return paths


def star_fact(spark: SparkSession, sf_dir: str, staged: DataFrame, starts: DataFrame, time_dim: DataFrame, **fact_kw) -> DataFrame:
    """The stored fact: bucketed submissions with the keys of their cell ,
    numbered inside it."""
    from ..plans import star
    order = Window.partitionBy(*CELL).orderBy("order_key", "line_number")
    placed = staged.join(starts, CELL).withColumn("export_id", F.col("first") + F.row_number().over(order))
    return star.fact(spark, sf_dir, placed, time_dim=time_dim, keep=("export_id", "fruit_key", "order_key", "line_number"), **fact_kw)


def read_star(spark: SparkSession, star_dir: str) -> dict:
    """SRC7 over a materialised star: tables as DataFrames, registered as views
    (the fact's as in ``star_views``, booleans as 0/1)."""
    from ..plans.star import fact_view
    names = ["dim_time", "dim_corridor", "dim_grower", "dim_fruit_quality", "fact_export_transactions"]
    out = {n: spark.read.parquet(os.path.join(star_dir, n)) for n in names}
    for n, df in out.items():
        (fact_view(df) if n == "fact_export_transactions" else df).createOrReplaceTempView(n)
    return out


def season_slice(df: DataFrame, season: str) -> DataFrame:
    """SRC8: parameterised season scan; on the partitioned fact it prunes
    to one directory."""
    return df.filter(F.col("season") == F.lit(season))


def write_payloads(payload_json: DataFrame, out_dir: str) -> str:
    """SNK5: one JSON document per season (``season=YYYY-YY`` folders)."""
    df = payload_json.withColumn("season_file", F.regexp_replace("season", "/", "-"))
    (df.select("season_file", F.col("payload").alias("value"))
       .write.mode("overwrite").partitionBy("season_file").text(out_dir))
    return out_dir


def append_run_log(spark: SparkSession, log_path: str, run_id: str, status: str, health: float, detail: str = "") -> None:
    """SNK11: append-only run log, OK or ALERT."""
    row = spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("logged_at"),
                                F.lit(status).alias("status"), F.lit(float(health)).alias("health_score"),
                                F.lit(detail).alias("detail"))
    row.write.mode("append").parquet(log_path)


def read_published(spark: SparkSession, publish_path: str) -> DataFrame:
    """The version that the latest pointer names."""
    base = publish_path.rstrip("/")
    run_id = spark.read.parquet(f"{base}/pointer").agg(F.max_by("run_id", "published_at")).first()[0]  # one row
    return spark.read.parquet(f"{base}/versions/{run_id}")


def publish_if_healthy(df: DataFrame, health: DataFrame | Callable[[DataFrame], DataFrame], publish_path: str, log_path: str,
                       gate: float = C.HEALTH_GATE, partition_by=None) -> bool:
    """SNK12: write-audit-publish.

    The batch is written to a version folder of its own.  ``health`` (one row,
    or a function that audits the written copy) then decides: any violated
    integrity check refuses the batch whatever the score, and the score must
    reach the gate.  Publishing appends one row to the pointer table, so a
    reader sees the old version or the new one, and a crash before it leaves
    the last good one.  A refused version is removed.  Either way one line
    goes to the run log.
    """
    from ..operators.quality import HARD_CHECKS
    spark, base = df.sparkSession, publish_path.rstrip("/")
    run_id = uuid.uuid4().hex[:12]
    staged = write_table(df, f"{base}/versions/{run_id}", partition_by=partition_by)
    found = health(spark.read.parquet(staged)) if callable(health) else health
    row = found.first().asDict()  # one row
    score, broken = row["health_score"], [c for c in HARD_CHECKS if row.get(c, 0) != 0]
    ok = score is not None and score >= gate and not broken
    if ok:
        (spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("published_at"))
              .write.mode("append").parquet(f"{base}/pointer"))
    else:
        drop_path(spark, staged)
    why = f"violated: {', '.join(broken)}" if broken else f"health {score} below gate {gate}"
    append_run_log(spark, log_path, run_id, "OK" if ok else "ALERT", score if score is not None else -1.0,
                   "published" if ok else f"{why}; kept last good output")
    return ok
