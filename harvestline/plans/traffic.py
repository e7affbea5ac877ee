"""Traffic counts → daily corridor congestion (AGG10–AGG13, WIN1–WIN2, DF1,
FLT1–FLT3, PRJ11).

Two published paths are kept apart (hazards H19, H20):

* 15-minute counts: region by name-or-code (FLT1), SH2 prefix (FLT3), bad
  timestamps dropped, null counts filled with the site × class median
  (WIN1), summed per day and pivoted by class (AGG11–AGG12).
* daily counts: exact duplicates removed (PRJ11), region by regex (FLT2),
  SH2 prefix, bad dates kept through parsing but dropped by the pivot (a
  null group key, as pandas does), pivoted by class.

Counts are carried in thousandths so that the congestion index (DF1) and
the rescale (WIN2) round exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import half_up_div, season_phase
from ..operators.aggregates import avg_fixed
from ..operators.cleaning import drop_dupes, normalise_columns, prefix_filter, region_filter_rx
from ..operators.quality import audit_rows, removed_by
from ..operators.windows import group_medians, minmax_rescale_fixed
from ..sources.tables import read_table, scratch_table

CLASSES = ["Heavy", "Light"]


# --------------------------------------------------------------------------
# Bindings: the driver's ``events`` table as traffic-count files
# --------------------------------------------------------------------------

def _region_label(user_id) -> F.Column:
    code = (user_id % 14) + 1
    return F.when(code == 4, F.lit(C.REGION_LABEL)).otherwise(
        F.concat(F.lpad(code.cast("string"), 2, "0"), F.lit(" - Region")))


def _site_ref(user_id) -> F.Column:
    return F.lpad(((user_id % 3 + 1) * 100000 + user_id).cast("string"), 8, "0")


def tms_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute count rows (upper-case headers as in the source files)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    u = F.col("user_id")
    return ev.select(
        F.col("ts").alias("START_DATE"),
        _region_label(u).alias("REGION_NAME"),
        _site_ref(u).alias("SITE_REFERENCE"),
        F.concat(F.lit("Site "), u.cast("string")).alias("SITE_DESCRIPTION"),
        F.when(F.col("event_type").isin("purchase", "error"), "Heavy").otherwise("Light").alias("CLASS_WEIGHT"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("TRAFFIC_COUNT"),
    )


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily count rows with the mixed-case headers of the daily file."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    u = F.col("user_id")
    return ev.select(
        F.col("ts").cast("string").alias("startDate"),
        u.alias("siteID"),
        _region_label(u).alias("regionName"),
        _site_ref(u).alias("siteReference"),
        F.when(F.col("event_type").isin("purchase", "error"), "Heavy").otherwise("Light").alias("classWeight"),
        F.concat(F.lit("Site "), u.cast("string")).alias("siteDescription"),
        (F.col("event_id") % 2 + 1).cast("int").alias("laneNumber"),
        F.when(F.col("event_id") % 2 == 0, "Increasing").otherwise("Decreasing").alias("flowDirection"),
        F.col("value").alias("trafficCount"),
    )


# --------------------------------------------------------------------------
# Operators
# --------------------------------------------------------------------------

def pivot_class(df: DataFrame, keys, class_col: str, value_col: str, classes=CLASSES) -> DataFrame:
    """Pivot class → columns with sums (AGG12), absent classes → 0 (PRJ12/13).

    Written as conditional sums in one aggregate: the same result as
    ``groupBy().pivot(c, values).sum()`` with explicit values, but a single
    shuffle.  Counts are summed in thousandths (exact).
    """
    milli = F.round(F.col(value_col) * 1000.0).cast("long")
    aggs = [F.coalesce(F.sum(F.when(F.col(class_col) == k, milli)), F.lit(0)).alias(f"{k.lower()}_milli")
            for k in classes]
    return df.groupBy(*keys).agg(*aggs)


def with_congestion(df: DataFrame, base: float = C.BASE_HEAVY_DAILY) -> DataFrame:
    """DF1 in fixed point: round(clamp(100·(3h + l)/(11·base), 0, 100), 2)."""
    # with H, L in thousandths: ci·100 = 10000·(3H + L)/(1000·11·base) = (3H + L)/(11·base/10)
    denom = int(round(11 * base / 10))
    centi = half_up_div(F.col("heavy_milli") * 3 + F.col("light_milli"), F.lit(denom))
    return df.withColumns({
        "heavy_count": F.col("heavy_milli") / 1000.0,
        "light_count": F.col("light_milli") / 1000.0,
        "total_count": (F.col("heavy_milli") + F.col("light_milli")) / 1000.0,
        "congestion_index": F.least(F.greatest(centi, F.lit(0)), F.lit(10000)) / 100.0,
    })


CELL = ["date", "SITE_REFERENCE", "SITE_DESCRIPTION", "REGION_NAME", "CLASS_WEIGHT", "TRAFFIC_COUNT"]


def corridor_steps() -> dict:
    """The steps of the 15-minute path, with what a row must meet to stay (FLT1, FLT3)."""
    region = F.col("REGION_NAME")
    return {"region": F.lower(region).contains(C.REGION_NAME.lower()) | region.contains(C.REGION_CODE),
            "highway": F.col("SITE_REFERENCE").cast("string").startswith(C.SH2_PREFIX),
            "dated": F.col("START_DATE").isNotNull()}


def traffic_cells(tms: DataFrame) -> DataFrame:
    """Rows of the corridor by day, site, class and value, counted: the one scan of
    the counts, stored, that the medians and the sums both start from.  What a
    step removes is counted along, in a row that names the step."""
    x = tms.withColumn("date", F.to_date("START_DATE")).withColumn("step", removed_by(corridor_steps()))
    x = x.withColumns({c: F.when(F.col("step").isNull(), F.col(c)) for c in CELL})
    return scratch_table(x.groupBy("step", *CELL).agg(F.count(F.lit(1)).alias("n")), "traffic-cells")


def audited_traffic(tms: DataFrame, audit_path: str, run_id: str) -> DataFrame:
    """The daily traffic with its audit trail: one row a step appended to ``audit_path`` (DQ1, SNK7)."""
    cells = traffic_cells(tms)
    audit_rows(cells.select("step", "n"), corridor_steps(), run_id).coalesce(1).write.mode("append").parquet(audit_path)
    return traffic_from_cells(cells)


def traffic_daily(tms: DataFrame) -> DataFrame:
    """15-minute path → one row per day × site (WIN1, AGG11, AGG12, DF1)."""
    return traffic_from_cells(traffic_cells(tms))


def traffic_from_cells(cells: DataFrame) -> DataFrame:
    """Days and sites from counted values.

    A null count is worth the median of its site and class, so a day's sum is
    that of its known counts plus the median for each unknown one."""
    cells = cells.where("step is null").drop("step")
    site_class, keys = ["SITE_REFERENCE", "CLASS_WEIGHT"], ["date", "SITE_REFERENCE", "SITE_DESCRIPTION", "REGION_NAME"]
    medians = group_medians(cells, "TRAFFIC_COUNT", site_class, "n")

    def milli(c):
        return F.round(F.col(c) * 1000.0).cast("long")

    day = (cells.filter(F.col("SITE_DESCRIPTION").isNotNull() & F.col("REGION_NAME").isNotNull())
                .groupBy(*keys, "CLASS_WEIGHT").agg(F.sum(milli("TRAFFIC_COUNT") * F.col("n")).alias("known"),
                                                    F.sum(F.when(F.col("TRAFFIC_COUNT").isNull(), F.col("n")).otherwise(0)).alias("unknown"))
                .join(medians, site_class, "left"))
    value = F.coalesce("known", F.lit(0)) + F.col("unknown") * F.coalesce(milli("median"), F.lit(0))
    p = with_congestion(day.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("CLASS_WEIGHT") == k, value)), F.lit(0)).alias(f"{k.lower()}_milli") for k in CLASSES]))
    w = F.weekofyear("date")
    return p.select(
        "date", F.col("SITE_REFERENCE").alias("site_reference"), F.col("SITE_DESCRIPTION").alias("site_description"),
        F.col("REGION_NAME").alias("region_name"), "heavy_count", "light_count", "total_count", "congestion_index",
        w.alias("iso_week"), w.alias("pack_week"), season_phase(w).alias("season_phase"))


def traffic_daily_counts(daily: DataFrame) -> DataFrame:
    """Daily-file path (PRJ1, PRJ11, FLT2, FLT3, AGG12, DF1)."""
    x = normalise_columns(daily)
    x = drop_dupes(x)
    x = region_filter_rx(x, "regionname", C.REGION_REGEX)
    x = prefix_filter(x, "sitereference", C.SH2_PREFIX)
    d = F.to_date(F.try_to_timestamp(F.col("startdate")))
    x = x.withColumn("date", d)
    w = F.weekofyear("date")
    x = x.withColumns({"iso_week": w, "pack_week": w, "season_phase": season_phase(w), "year": F.year("date")})
    keys = ["date", "sitereference", "iso_week", "pack_week", "season_phase", "year"]
    x = x.filter(F.col("date").isNotNull())  # pivot drops null group keys
    p = with_congestion(pivot_class(x, keys, "classweight", "trafficcount"))
    return p.select("date", F.col("sitereference").alias("site_reference"), "iso_week", "pack_week",
                    "season_phase", "year", "heavy_count", "light_count", "total_count", "congestion_index")


def congestion_profile(daily: DataFrame) -> DataFrame:
    """Global median, p75, max and min of the congestion index (AGG10).
    Exact percentiles: the aggregate merges value-frequency maps, whose size
    is the number of distinct index values (≤ 10,001), not the row count."""
    return daily.agg(
        F.round(F.percentile("congestion_index", 0.5), 4).alias("ci_median"),
        F.round(F.percentile("congestion_index", 0.75), 4).alias("ci_p75"),
        F.max("congestion_index").alias("ci_max"),
        F.min("congestion_index").alias("ci_min"),
        F.count(F.lit(1)).alias("days"))


def scaled(daily: DataFrame) -> DataFrame:
    """Congestion rescaled to the observed range (WIN2)."""
    return minmax_rescale_fixed(daily, "congestion_index", "congestion_index_scaled", 2, 1)


def weekly_congestion(daily: DataFrame) -> DataFrame:
    """Average rescaled congestion per pack week, 1 dp (AGG13)."""
    return (scaled(daily).groupBy("pack_week")
            .agg(avg_fixed("congestion_index_scaled", 1, 1).alias("avg_congestion_by_week")))


def corridor_congestion(daily: DataFrame) -> DataFrame:
    """One row: the corridor average of the rescaled index (dim_corridor input)."""
    return scaled(daily).agg(avg_fixed("congestion_index_scaled", 1, 1).alias("congestion_index_avg"))


def rain_daily_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN6: daily rainfall (events' daily Σ value, hundredths exact) and the
    trailing 7-day total.  The window runs over the daily series (one row
    per day), so its partition is bounded by the calendar, not the data."""
    from ..operators.windows import rolling_sum_days
    ev = read_table(spark, sf_dir, "events", ["ts", "value"]).filter(F.col("ts").isNotNull())
    daily = (ev.groupBy(F.to_date("ts").alias("day"))
               .agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("rain_centi"))
               .withColumn("place", F.lit(C.REGION_NAME)))
    out = rolling_sum_days(daily, ["place"], "day", "rain_centi", 7, "_r7")
    return out.select("place", "day", (F.col("rain_centi") / 100.0).alias("rain_mm"),
                      (F.col("_r7") / 100.0).alias("rain_7d_mm"))
