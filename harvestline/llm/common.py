"""Helpers shared by the corpus operators: stored tables, checked broadcasts, Arrow batches."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows and bytes in one Arrow batch: bound what the JVM and a Python worker hold at once.
TEXT_ROWS = 250
BATCH_BYTES = 2 << 20

#: A side is broadcast only when it was counted and has at most so many narrow rows.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 16 << 20

#: One word: a maximal run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Spark this package for its Python workers, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root, name = os.path.split(package)
        out = os.path.join(tempfile.mkdtemp(prefix="harvestline-"), "harvestline-package")
        spark.sparkContext.addPyFile(shutil.make_archive(out, "zip", root, name))
        _shipped.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package; small Arrow batches, by bytes too, since one row may hold a
    very long text (a batch ends with the row that reaches the bound)."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > TEXT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Other Arrow batches for what is run inside: many rows where they are
    narrow, few where each may hold megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages start
    from files that every executor sees, whichever executors are lost."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` (narrow, already stored) for broadcast if a count proves it
    small; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def bounded_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` (already stored) for broadcast if its rows, strings and arrays
    measured, take at most ``limit`` bytes; otherwise leave the join to a shuffle."""
    def width(field):
        if field.dataType.typeName() in ("string", "binary"):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        if field.dataType.typeName() == "array":
            return F.coalesce(F.octet_length(F.array_join(F.col(field.name).cast("array<string>"), ",")), F.lit(0)) * 8 + 16
        return F.lit(16)

    size = df.agg(F.sum(sum((width(f) for f in df.schema.fields), F.lit(16)).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def row_groups(offsets: np.ndarray, limit: int):
    """Split rows into runs of at most ``limit`` bytes (one row at least)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b
