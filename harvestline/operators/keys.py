"""Dense surrogate keys 1..n in a total order (PRJ16/WIN4), distributed.

``row_number()`` over an unpartitioned window would pull every row into one
task.  Instead the rows are range-partitioned on the full order (the range
boundaries come from a sample, so hot values of a leading column still
spread over many partitions), numbered inside each partition, and shifted by
the row count of all earlier partitions.  Only one row per partition ever
leaves the executors, and that small offsets table is what is broadcast.

The per-partition counts and the numbering must see identical partitions.
That holds when the input is a deterministic scan (range bounds come from a
fixed-seed sample over the same input order).  When the input comes out of
a shuffle its row order is not fixed, so pass ``materialize=True``: the
numbered frame is then checkpointed to the shared ``spark.checkpoint.dir``
and both uses read the stored copy (this also cuts the lineage, so a lost
executor does not recompute the upstream joins).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_dir
from ..sources.tables import scratch_table


def surrogate_key(df: DataFrame, order_cols, name: str, num_partitions: int | None = None,
                  materialize: bool = False) -> DataFrame:
    spark = df.sparkSession
    order_cols = list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    # position within the partition: the id's low 33 bits count rows in order
    ranged = ranged.withColumn("_pos", F.col("_pos") - F.shiftleft(F.col("_pid").cast("long"), 33))
    if materialize:
        checkpoint_dir(spark)
        ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    return (out.withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("long"))
               .drop("_pid", "_pos", "_off"))


def prefix_sums(df: DataFrame, order_cols, weights: dict[str, str], num_partitions: int | None = None) -> DataFrame:
    """For each ``name: weight`` the sum of that column over all rows before each
    row of the order, distributed.

    The rows are range-partitioned on the order and stored with their partition and
    their sums inside it, which start from the total of the partitions before, of
    which there is one row each.  Rows that are equal in the order may
    take either place.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return running_sums(df.repartitionByRange(n, *order_cols), order_cols, weights)


def running_sums(ranged: DataFrame, order_cols, weights: dict[str, str]) -> DataFrame:
    """``prefix_sums`` of rows that lie in ranges of the order already: a sorted
    partition is summed as it is stored, so no row moves again."""
    own = {k: f"_{k}" for k in weights}
    placed = ranged.sortWithinPartitions(*order_cols).select(
        "*", *[F.coalesce(F.col(w).cast("long"), F.lit(0)).alias(own[k]) for k, w in weights.items()], F.spark_partition_id().alias("_pid"))
    stored = scratch_table(placed.mapInArrow(_sums_before(list(own.values())), placed.schema), "ranged", compression="zstd")
    totals = stored.groupBy("_pid").agg(*[F.sum(w).alias(f"_all_{k}") for k, w in weights.items()])
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_all_{k}").over(earlier), F.lit(0)).alias(f"_all_{k}") for k in weights])
    return (stored.join(F.broadcast(offsets), "_pid")
                  .withColumns({k: (F.col(own[k]) + F.col(f"_all_{k}")).cast("long") for k in weights})
                  .drop("_pid", *own.values(), *[f"_all_{k}" for k in weights]))


def _sums_before(columns: list):
    """Each column replaced by its sum over the rows before, batch after batch of a partition."""
    def run(batches):
        reached = dict.fromkeys(columns, 0)
        for batch in batches:
            for c in columns:
                w = batch.column(c).to_numpy()
                upto = reached[c] + np.cumsum(w)
                batch = batch.set_column(batch.schema.get_field_index(c), c, pa.array(upto - w))
                reached[c] = int(upto[-1]) if len(upto) else reached[c]
            yield batch
    return run


def hashed_surrogate_key(df: DataFrame, order_cols, name: str, buckets: int | None = None) -> DataFrame:
    """Dense keys 1..n in the total order (hash bucket, ``order_cols``).

    Rows are hash-partitioned by a bucket computed from the full key, so a
    bucket's membership is a pure function of the row: the per-bucket counts
    and the numbering agree whatever order the shuffle delivers rows in, and
    no checkpoint is needed.  Both branches read the one (reused) exchange;
    the ``row_number`` window is clustered by the bucket the data is already
    partitioned by, so it adds no shuffle.  Buckets are uniform (the key is
    near-unique), so a hot value in a leading column does not skew them.
    Include enough columns in ``order_cols`` to make the order total.
    """
    spark = df.sparkSession
    order_cols = list(order_cols)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = df.withColumn("_b", F.pmod(F.xxhash64(*[F.col(c) for c in order_cols]), F.lit(n))).repartition(n, "_b")
    counts = x.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_b", F.coalesce(
        F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    numbered = x.withColumn("_rn", F.row_number().over(Window.partitionBy("_b").orderBy(*order_cols)))
    out = numbered.join(F.broadcast(offsets), "_b")
    return out.withColumn(name, (F.col("_off") + F.col("_rn")).cast("long")).drop("_b", "_rn", "_off")
