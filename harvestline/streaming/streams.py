"""Structured Streaming restatements of the batch operators (STR1–STR6).

The batch formulas are reused unchanged; only the grouping becomes an
event-time window with a watermark.  Sources are file streams over the
parquet tables (any file source or Kafka works the same way); timestamps
are cast from TIMESTAMP_NTZ to TIMESTAMP before the watermark (H29).

Windowed streams run in append mode: a window's row is written once, when the
watermark closes it, and its state is dropped, so the state holds the open
windows only.  A first stream keeps late rows apart (``epochs.sort_out_late``);
``read_windows`` shows closed windows and, from the state, the open ones.

Completed queries use ``trigger(availableNow=True)`` so a run processes
everything present and stops — the same job runs continuously with a
processing-time trigger.  Checkpoints live under the shared
``spark.checkpoint.dir`` so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import config as C
from ..functions.scalars import season_phase
from ..session import checkpoint_dir
from ..sources.tables import path_status, put_table, read_table, table_path
from .epochs import publish_epoch, put_epoch, read_committed, read_epochs, read_log, sort_out_late, stream_in_time


def read_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A file stream over one table with the batch table's schema."""
    path = table_path(sf_dir, name)
    r = spark.readStream.schema(read_table(spark, sf_dir, name).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if path_status(spark, path) == "dir":  # a table of part files
        return r.parquet(path)
    return r.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))


def _ckpt(spark: SparkSession, tag: str, out_path: str) -> str:
    """The same folder for every run of ``tag`` into ``out_path``: a restarted run goes on."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{tag}-{uuid.uuid5(uuid.NAMESPACE_URL, out_path).hex}")


# --------------------------------------------------------------------------
# STR1: 15-minute counts → daily tumbling totals per site and class
# --------------------------------------------------------------------------

TRAFFIC = "ts timestamp, region_name string, site_reference string, class_weight string, traffic_count double"


def traffic_stream(events: DataFrame) -> DataFrame:
    """Events as 15-minute count rows with an event-time column ``ts``."""
    from ..plans.traffic import _region_label, _site_ref
    u = F.col("user_id")
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        _region_label(u).alias("region_name"),
        _site_ref(u).alias("site_reference"),
        F.when(F.col("event_type").isin("purchase", "error"), "Heavy").otherwise("Light").alias("class_weight"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("traffic_count"))


def corridor_rows(sdf: DataFrame) -> DataFrame:
    """Rows of the region and the highway; both filters run before the state."""
    x = sdf.filter(F.coalesce(F.lower("region_name").contains(C.REGION_NAME.lower())
                              | F.col("region_name").contains(C.REGION_CODE), F.lit(False)))
    return x.filter(F.col("site_reference").startswith(C.SH2_PREFIX))


def traffic_medians(history: DataFrame) -> DataFrame:
    """(site_reference, class_weight, median): what null counts are filled with (WIN1)."""
    from ..operators.windows import group_medians
    return group_medians(corridor_rows(history), "traffic_count", ["site_reference", "class_weight"])


def traffic_windows(sdf: DataFrame, delay: str = "1 day", medians: DataFrame | None = None) -> DataFrame:
    """Daily tumbling sums in thousandths by site; null counts take the site and
    class median of ``medians`` (a stored table of the history, joined
    stream-static), or add nothing without it."""
    x = corridor_rows(sdf)
    if medians is not None:
        x = x.join(medians, ["site_reference", "class_weight"], "left").withColumn("traffic_count", F.coalesce("traffic_count", "median"))
    milli = F.round(F.col("traffic_count") * 1000.0).cast("long")
    return (x.withWatermark("ts", delay)
             .groupBy(F.window("ts", "1 day"), "site_reference")
             .agg(F.sum(F.when(F.col("class_weight") == "Heavy", milli)).alias("hm"),
                  F.sum(F.when(F.col("class_weight") == "Light", milli)).alias("lm")))


def traffic_result(g: DataFrame) -> DataFrame:
    """STR1's columns from window sums."""
    from ..functions.scalars import half_up_div
    g = g.fillna(0, ["hm", "lm"])
    denom = int(round(11 * C.BASE_HEAVY_DAILY / 10))
    centi = half_up_div(F.col("hm") * 3 + F.col("lm"), F.lit(denom))
    d = F.to_date(F.col("window.start"))
    return g.select(
        d.alias("date"), "site_reference",
        (F.col("hm") / 1000.0).alias("heavy_count"), (F.col("lm") / 1000.0).alias("light_count"),
        ((F.col("hm") + F.col("lm")) / 1000.0).alias("total_count"),
        (F.least(F.greatest(centi, F.lit(0)), F.lit(10000)) / 100.0).alias("congestion_index"),
        F.weekofyear(d).alias("pack_week"), season_phase(F.weekofyear(d)).alias("season_phase"))


def daily_traffic_stream(sdf: DataFrame, delay: str = "1 day", medians: DataFrame | None = None) -> DataFrame:
    """STR1: watermark + 1-day tumbling window per site; heavy/light sums in
    thousandths and the DF1 congestion index."""
    return traffic_result(traffic_windows(sdf, delay, medians))


# --------------------------------------------------------------------------
# STR2: 7-day sliding rainfall
# --------------------------------------------------------------------------

RAIN = "ts timestamp, value double"


def rain_windows(sdf: DataFrame, delay: str = "1 day") -> DataFrame:
    """7-day windows sliding by a day over the rainfall readings (``ts``,
    ``value`` in mm); sums in hundredths of a mm, exact."""
    centi = F.round(F.col("value") * 100.0).cast("long")
    return (sdf.withWatermark("ts", delay)
               .groupBy(F.window("ts", "7 days", "1 day"))
               .agg(F.sum(centi).alias("c"), F.count(F.lit(1)).alias("readings")))


def rain_result(g: DataFrame) -> DataFrame:
    return g.select(F.to_date(F.col("window.start")).alias("window_start"),
                    F.to_date(F.col("window.end")).alias("window_end"),
                    (F.col("c") / 100.0).alias("rain_7d_mm"), "readings")


def rain_7d_stream(sdf: DataFrame, delay: str = "1 day") -> DataFrame:
    """STR2: 7-day rainfall for every day that ends such a window."""
    return rain_result(rain_windows(sdf, delay))


# --------------------------------------------------------------------------
# Append mode: closed windows, open windows, late rows
# --------------------------------------------------------------------------

def day_end(ts: str) -> Column:
    """When the day of ``ts`` ends."""
    return F.date_trunc("day", F.col(ts)) + F.expr("interval 1 day")


def run_gate(sdf: DataFrame, delay: str, first_close: Column, last_close: Column, base: str, ts: str = "ts") -> StreamingQuery:
    """Take in what is there, late rows kept apart under ``base``."""
    return _run_available(sdf, sort_out_late(ts, delay, first_close, last_close, base), "append", _ckpt(sdf.sparkSession, "gate", base))


def run_windows(windows: DataFrame, base: str) -> StreamingQuery:
    """Group what came in time; the windows that the watermark closes go to ``base``/closed."""
    def put(batch: DataFrame, epoch: int) -> None:
        put_epoch(batch, f"{base}/closed", epoch)

    return _run_available(windows, put, "append", _ckpt(windows.sparkSession, "windows", base))


def read_windows(windows: DataFrame, base: str) -> DataFrame:
    """Closed windows, and the open ones as far as they have come (from the state
    that the stream keeps), with the column ``closed``."""
    spark, schema = windows.sparkSession, windows.schema
    done = read_epochs(spark, f"{base}/closed", schema).drop("epoch").withColumn("closed", F.lit(True))
    state = _ckpt(spark, "windows", base)
    if path_status(spark, f"{state}/state") is None:
        return done
    kept = spark.read.format("statestore").load(state)
    keys = kept.schema["key"].dataType.names
    values = StructType([f for f in schema.fields if f.name not in keys])
    still_open = kept.select("key.*", F.col("value").cast(values).alias("v")).select(*keys, "v.*").select(*schema.names)
    return done.unionByName(still_open.withColumn("closed", F.lit(False)))


def _run_available(sdf: DataFrame, each, mode: str, checkpoint: str) -> StreamingQuery:
    q = (sdf.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


# --------------------------------------------------------------------------
# STR3: duplicate removal bounded by the watermark
# --------------------------------------------------------------------------

def dedupe_stream(sdf: DataFrame, keys, delay: str = "1 hour") -> DataFrame:
    """STR3: drop repeats of ``keys`` that arrive within ``delay`` of each
    other; state older than the watermark is evicted."""
    return sdf.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


# --------------------------------------------------------------------------
# STR4–STR6: live state, enrichment, gated publish
# --------------------------------------------------------------------------

def submissions_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """STR5: streaming lineitem enriched stream–static with part and the
    supplier subzone, then the batch fact formulas."""
    from ..plans import star
    from ..sources import bindings
    li = read_stream(spark, sf_dir, "lineitem", max_files)
    subs = bindings.submissions(spark, sf_dir, lineitem=li)
    return star.fact(spark, sf_dir, subs)


def run_to_table(sdf: DataFrame, out_path: str, mode: str = "complete", tag: str = "q") -> str:
    """Run a stream with ``availableNow`` and keep its current result as a
    parquet table: in complete mode each micro-batch replaces the table, else
    it is its own epoch, so a repeated micro-batch changes nothing."""
    def publish(batch: DataFrame, epoch: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(out_path)
        else:
            put_epoch(batch, out_path, epoch)

    _run_available(sdf, publish, mode, _ckpt(sdf.sparkSession, tag, out_path))
    return out_path


def _latest(df: DataFrame) -> DataFrame:
    state = F.max(F.struct("date_key", "season", "pack_week")).alias("s")
    return df.agg(state).select("s.*").filter(F.col("date_key").isNotNull())


def read_live_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The latest of the rows that the micro-batches of STR4 left."""
    return _latest(read_epochs(spark, state_path, "date_key int, season string, pack_week int"))


def live_state_stream(spark: SparkSession, sf_dir: str, state_path: str) -> str:
    """STR4: the latest (date_key, season, pack_week) kept current.  Each
    micro-batch reduces itself to one row (max over a struct) in its own
    epoch; ``read_live_state`` takes the latest of these rows."""
    sdf = submissions_stream(spark, sf_dir).filter(F.col("date_key").isNotNull())

    def merge(batch: DataFrame, epoch: int) -> None:
        put_epoch(_latest(batch), state_path, epoch)

    _run_available(sdf, merge, "append", _ckpt(spark, "live", state_path))
    return state_path


def enrich_stream(sdf: DataFrame, feed_path: str, date_col: str, out_path: str) -> str:
    """STR5: every row takes the feed landing that is valid at its date (JN12).
    The landings are read anew by each micro-batch, so one that arrives while
    the stream runs counts from the next micro-batch on."""
    from ..operators.joins import as_of
    from ..sources.files import feed_values, read_feed
    spark = sdf.sparkSession

    def enrich(batch: DataFrame, epoch: int) -> None:
        put_epoch(as_of(batch, feed_values(read_feed(spark, feed_path)), date_col, "fx_date"), out_path, epoch)

    _run_available(sdf, enrich, "append", _ckpt(spark, "enrich", out_path))
    return out_path


def publish_stream(spark: SparkSession, sf_dir: str, base: str, gate: float = C.HEALTH_GATE, max_files: int | None = None) -> str:
    """STR6: every micro-batch of submissions is health-checked (DQ8) and
    published only when it passes the gate; the log has a line for it either
    way (SNK11, SNK12).  ``epochs.read_committed`` reads what was published."""
    from ..operators.quality import fact_health

    def publish(batch: DataFrame, epoch: int) -> None:
        publish_epoch(batch, epoch, base, fact_health, gate)

    sdf = submissions_stream(spark, sf_dir, max_files).drop("mts_pass_int")
    _run_available(sdf, publish, "append", _ckpt(spark, "publish", base))
    return base


# --------------------------------------------------------------------------
# Registered forms: run the stream over the whole table, read the result
# --------------------------------------------------------------------------

def _result_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "results", f"{name}-{uuid.uuid4().hex[:8]}")


def daily_traffic_stream_batch(spark: SparkSession, sf_dir: str, out_path: str | None = None) -> DataFrame:
    """STR1 over all that has arrived: closed and open days, null counts filled
    with the medians of the history."""
    base = out_path or _result_path(spark, "str1")
    medians = put_table(traffic_medians(traffic_stream(read_table(spark, sf_dir, "events"))), f"{base}/medians")
    run_gate(traffic_stream(read_stream(spark, sf_dir, "events")), "1 day", day_end("ts"), day_end("ts"), base)
    windows = traffic_windows(stream_in_time(spark, base, TRAFFIC), "1 day", medians)
    run_windows(windows, base)
    return traffic_result(read_windows(windows, base))


def rain_7d_stream_batch(spark: SparkSession, sf_dir: str, out_path: str | None = None) -> DataFrame:
    """STR2 over all that has arrived, closed and open windows."""
    base = out_path or _result_path(spark, "str2")
    ev = read_stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    run_gate(ev, "1 day", day_end("ts"), day_end("ts") + F.expr("interval 6 days"), base)
    windows = rain_windows(stream_in_time(spark, base, RAIN))
    run_windows(windows, base)
    return rain_result(read_windows(windows, base))


def dedupe_stream_batch(spark: SparkSession, sf_dir: str, out_path: str | None = None) -> DataFrame:
    """STR3 over all that has arrived; rows behind the watermark are kept apart and counted."""
    base = out_path or _result_path(spark, "str3")
    ev = read_stream(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
    run_gate(ev, "2 hours", F.col("ts"), F.col("ts"), base)
    d = dedupe_stream(stream_in_time(spark, base, ev.schema), ["user_id", "event_type", "hour"], "2 hours").select("user_id", "event_type", "hour")
    run_to_table(d, f"{base}/closed", "append", "str3")
    return read_epochs(spark, f"{base}/closed", d.schema).drop("epoch")


def live_state_batch(spark: SparkSession, sf_dir: str, out_path: str | None = None) -> DataFrame:
    out = out_path or _result_path(spark, "str4")
    live_state_stream(spark, sf_dir, out)
    return read_live_state(spark, out)


def enrich_stream_batch(spark: SparkSession, sf_dir: str, out_path: str | None = None) -> DataFrame:
    """STR5 over all submissions, counted by the landing that they took."""
    from ..sources import bindings
    base = out_path or _result_path(spark, "str5")
    bindings.feed_landings(spark, sf_dir).write.mode("ignore").json(f"{base}/feed")
    subs = bindings.submissions(spark, sf_dir, lineitem=read_stream(spark, sf_dir, "lineitem")).select("submission_date", "trays_submitted")
    enrich_stream(subs, f"{base}/feed", "submission_date", f"{base}/rows")
    rows = read_epochs(spark, f"{base}/rows", "trays_submitted long, fx_date string, nzd_eur double")
    return rows.groupBy("fx_date", "nzd_eur").agg(F.count(F.lit(1)).alias("submissions"), F.sum("trays_submitted").cast("long").alias("trays"))


def publish_stream_batch(spark: SparkSession, sf_dir: str, out_path: str | None = None) -> DataFrame:
    """STR6 over all submissions: the log, with the rows that a reader finds of each epoch."""
    base = publish_stream(spark, sf_dir, out_path or _result_path(spark, "str6"))
    found = read_committed(spark, base, "season string").groupBy("epoch").agg(F.count(F.lit(1)).alias("published"))
    return read_log(spark, base).join(found, "epoch", "left").fillna(0, ["published"])
