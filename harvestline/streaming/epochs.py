"""Tables that micro-batches fill, one folder an epoch, and what is built on them:
the gate for late rows and the log of gated publishing (STR3, STR6, SNK11, SNK12).

An epoch's rows are written to a hidden folder and then moved to
``epoch=N`` in one step, so a reader sees all of an epoch or nothing, and a
micro-batch that is run again finds its epoch there and changes nothing.  One
stream writes a table.  (Where a store has no atomic move, a reader may see an
epoch while it is copied; ``read_committed`` goes by the log and does not.)
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..sources.tables import drop_path, move_path, path_status


def epoch_path(table: str, epoch: int) -> str:
    return f"{table.rstrip('/')}/epoch={epoch}"


def has_epoch(spark: SparkSession, table: str, epoch: int) -> bool:
    return path_status(spark, epoch_path(table, epoch)) is not None


def stage(df: DataFrame, table: str, partition_by: str | None = None) -> str:
    """Write rows where no reader of ``table`` looks."""
    path = f"{table.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    w = df.write.partitionBy(partition_by) if partition_by else df.write
    w.parquet(path)
    return path


def commit(spark: SparkSession, staged: str, table: str, epoch: int) -> bool:
    """Make staged rows the epoch's, unless it is there already."""
    if has_epoch(spark, table, epoch):
        drop_path(spark, staged)
        return False
    move_path(spark, staged, epoch_path(table, epoch))
    return True


def put_epoch(df: DataFrame, table: str, epoch: int, partition_by: str | None = None) -> bool:
    """``df`` as epoch ``epoch`` of ``table``, once."""
    spark = df.sparkSession
    return not has_epoch(spark, table, epoch) and commit(spark, stage(df, table, partition_by), table, epoch)


def read_epochs(spark: SparkSession, table: str, schema) -> DataFrame:
    """All epochs of a table with the column ``epoch``; no rows before the first one.
    ``schema`` is the DDL or type of the table's own columns."""
    found = spark.createDataFrame([], schema) if path_status(spark, table) is None else (
        spark.read.schema(schema).option("basePath", table).parquet(table))
    return found if "epoch" in found.columns else found.withColumn("epoch", F.lit(None).cast("int"))


# --------------------------------------------------------------------------
# Late rows
# --------------------------------------------------------------------------

MARKS = "high_micros long, rows long, late long, partly_late long"


def read_marks(spark: SparkSession, base: str) -> DataFrame:
    """By epoch: the latest event time so far, how many rows came, and how many late."""
    return read_epochs(spark, f"{base}/marks", MARKS)


def sort_out_late(ts: str, delay: str, first_close: Column, last_close: Column, base: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: rows with the column ``arrival`` to ``base``/rows.

    The watermark of an epoch is the latest event time of all epochs before it
    less ``delay``.  A row that is in windows which close from ``first_close``
    to ``last_close`` is ``late`` if all of them are closed, ``partly`` late if
    some are.  What a stream over the other rows groups is never behind its own
    watermark: that one follows from a part of the same rows, whole epochs of
    them, and never runs ahead of this one.  ``base``/marks has a row an epoch.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if has_epoch(spark, f"{base}/marks", epoch):
            return
        before = read_marks(spark, base).where(F.col("epoch") == epoch - 1).first() if epoch else None
        high = F.lit(before["high_micros"] if before else None).cast("long")
        closed = F.timestamp_micros(high) - F.expr(f"interval {delay}")  # null, and so never reached, before the first epoch
        arrival = F.when(last_close <= closed, "late").when(first_close <= closed, "partly").otherwise("on_time")
        rows = batch.where(F.col(ts).isNotNull()).withColumn("arrival", arrival)
        staged = stage(rows, f"{base}/rows", "arrival")
        # counted on the copy, of which two columns are read
        copy = spark.read.schema(rows.schema).parquet(staged)
        mark = copy.agg(F.greatest(high, F.max(F.unix_micros(ts))).alias("high_micros"), F.count(F.lit(1)).alias("rows"),
                        F.count_if(F.col("arrival") == "late").alias("late"), F.count_if(F.col("arrival") == "partly").alias("partly_late"))
        marked = stage(mark, f"{base}/marks")
        commit(spark, staged, f"{base}/rows", epoch)
        commit(spark, marked, f"{base}/marks", epoch)
    return run


def read_late(spark: SparkSession, base: str, schema) -> DataFrame:
    """The side table: rows that came too late for some or all of their windows."""
    return _with_arrival(spark, base, schema).where(F.col("arrival") != "on_time")


def _with_arrival(spark: SparkSession, base: str, schema) -> DataFrame:
    path = f"{base}/rows"
    empty = spark.createDataFrame([], schema).withColumns({"epoch": F.lit(None).cast("int"), "arrival": F.lit(None).cast("string")})
    return empty if path_status(spark, path) is None else spark.read.schema(empty.schema).option("basePath", path).parquet(path)


def stream_in_time(spark: SparkSession, base: str, schema) -> DataFrame:
    """A stream over the rows that are in time for a window at least; a
    micro-batch takes whole epochs."""
    empty = spark.createDataFrame([], schema).withColumns({"epoch": F.lit(None).cast("int"), "arrival": F.lit(None).cast("string")})
    return spark.readStream.schema(empty.schema).option("basePath", f"{base}/rows").parquet(f"{base}/rows").where(F.col("arrival") != "late")


# --------------------------------------------------------------------------
# Gated publishing with a log (STR6)
# --------------------------------------------------------------------------

LOG = "status string, health_score double, rows long, violated string"


def publish_epoch(batch: DataFrame, epoch: int, base: str, audit: Callable[[DataFrame], DataFrame], gate: float = C.HEALTH_GATE) -> None:
    """Write, audit, and only then publish a micro-batch; log it either way.

    The staged copy is audited (one row with ``health_score`` and the integrity
    checks).  A violated check or a score under the gate leaves the batch out.
    The log line, one an epoch, is written last: until it is there the epoch is
    not read, and a run that was ended anywhere before it starts over with the
    same outcome.
    """
    from ..operators.quality import HARD_CHECKS
    spark = batch.sparkSession
    data, log = f"{base}/data", f"{base}/log"
    if has_epoch(spark, log, epoch):
        return
    staged = epoch_path(data, epoch) if has_epoch(spark, data, epoch) else stage(batch, data)
    copy = spark.read.schema(batch.schema).parquet(staged)
    found = audit(copy).first().asDict()  # one row
    score, broken = found["health_score"], [c for c in HARD_CHECKS if found.get(c, 0) != 0]
    ok = score is not None and score >= gate and not broken
    line = spark.range(1).select(F.lit("OK" if ok else "ALERT").alias("status"), F.lit(score).cast("double").alias("health_score"),
                                 F.lit(copy.count()).cast("long").alias("rows"), F.lit(",".join(broken)).alias("violated"))
    if not ok:
        drop_path(spark, staged)
    elif staged != epoch_path(data, epoch):
        commit(spark, staged, data, epoch)
    put_epoch(line, log, epoch)


def read_log(spark: SparkSession, base: str) -> DataFrame:
    """One line an epoch, whether published or not."""
    return read_epochs(spark, f"{base}/log", LOG)


def read_committed(spark: SparkSession, base: str, schema) -> DataFrame:
    """The rows of the published epochs that the log names."""
    published = read_log(spark, base).where("status = 'OK'").select("epoch")
    return read_epochs(spark, f"{base}/data", schema).join(published, "epoch", "left_semi")
