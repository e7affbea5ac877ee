"""Scans of the parquet tables (SRC5) with explicit column lists.

Only the columns a plan needs are selected, so the parquet scan's
``ReadSchema`` stays narrow and filters push down.
"""

from __future__ import annotations

import logging
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


log = logging.getLogger(__name__)


def path_status(spark: SparkSession, path: str) -> str | None:
    """``dir``, ``file`` or None (absent), by the file system the path belongs to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(p):
        return None
    return "dir" if store.getFileStatus(p).isDirectory() else "file"


def path_stamp(spark: SparkSession, path: str) -> int | None:
    """When a table's file or folder was last changed; None where it is absent."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getFileStatus(p).getModificationTime() if store.exists(p) else None


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a path that nothing points to any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a path that does not exist yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    store = p(source).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(p(target).getParent())
    if not store.rename(p(source), p(target)):
        raise OSError(f"could not move {source} to {target}")


def put_table(df: DataFrame, path: str, **options) -> DataFrame:
    """Write ``df`` unless the table is there, and read it back: what is built on
    it starts from files, whichever executors are lost."""
    if path_status(df.sparkSession, f"{path}/_SUCCESS") is None:
        df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_table(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint folder and read it back."""
    return put_table(df, os.path.join(checkpoint_dir(df.sparkSession), "scratch", f"{name}-{uuid.uuid4().hex}"), **options)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, cols=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def load_sources(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict:
    """Named scans, tolerating missing tables (SRC5); what is missing is logged.
    The store itself is asked, so any path that Spark reads will do."""
    out = {}
    for n in names:
        if path_status(spark, table_path(sf_dir, n)) is not None:
            out[n] = read_table(spark, sf_dir, n)
        else:
            log.warning("source %s is missing: %s", n, table_path(sf_dir, n))
    return out


def register_views(spark: SparkSession, frames: dict) -> None:
    """Expose DataFrames to ``spark.sql`` (SRC7)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
