"""Star schema: dim_time, dim_corridor, dim_fruit_quality, dim_grower and
fact_export_transactions (SRC9, JN1–JN4, PRJ14–18, DF19–DF23).

Everything here is lazy.  ``star_views`` registers the tables for SQL
(SRC7) keyed by natural keys; ``build_star`` materialises them with dense
surrogate keys (PRJ16) and writes Parquet partitioned by season (SNK1/SNK4).

Join strategy at scale:
* dim_time (fixed date spine) and dim_corridor (five rows) are broadcast —
  their size does not grow with the data.
* dim_grower grows with suppliers and dim_fruit_quality with submissions;
  they join on their keys and Catalyst/AQE pick broadcast or sort-merge
  from measured sizes.  The stored build (``sources.sinks.build_star``) buckets the
  submissions once by reading; readings, keys and fact start from that copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import formulas as DF
from ..functions.scalars import (date_key, half_up_div, is_pack_season, iso_year, season_phase,
                                 season_year)
from ..sources import bindings

READING_KEY = ["kpin", "season", "pack_week", "variety"]


# --------------------------------------------------------------------------
# dim_time (SRC9, DF2–DF4)
# --------------------------------------------------------------------------

def date_spine(spark: SparkSession, start: str = C.SPINE_START, end: str = C.SPINE_END) -> DataFrame:
    """One row per calendar day, inclusive; generated inside the executors."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))).alias("date"))


def spine_of(dates: DataFrame, start: str = C.SPINE_START, end: str = C.SPINE_END) -> DataFrame:
    """The spine, widened to the first and last plausible ``submission_date`` of a
    table (one aggregate over one column), so that no such row of it falls outside.
    What is not plausible has no calendar day; DQ3 counts it (``fk_fact_time``)."""
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    plausible = dates.where(F.col("submission_date").between(F.to_date(F.lit(C.PLAUSIBLE_START)), F.to_date(F.lit(C.PLAUSIBLE_END))))
    span = plausible.agg(F.min("submission_date").alias("lo"), F.max("submission_date").alias("hi"))
    return span.select(F.explode(F.sequence(F.least(first, "lo"), F.greatest(last, "hi"), F.expr("interval 1 day"))).alias("date"))


def dim_time(spark: SparkSession, dates: DataFrame | None = None, start: str = C.SPINE_START, end: str = C.SPINE_END) -> DataFrame:
    """The calendar from ``start`` to ``end``, and as far as ``dates`` reach."""
    d = F.col("date")
    spine = date_spine(spark, start, end) if dates is None else spine_of(dates, start, end)
    return spine.select(
        date_key(d).alias("date_key"), d,
        F.weekofyear(d).alias("iso_week"),
        iso_year(d).cast("int").alias("iso_year"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.weekofyear(d).alias("pack_week"),
        season_year(d).alias("season_year"),
        season_phase(F.weekofyear(d)).alias("season_phase"),
        is_pack_season(d).cast("int").alias("is_pack_season"),
    )


# --------------------------------------------------------------------------
# dim_corridor (SRC10, WIN2 via traffic)
# --------------------------------------------------------------------------

def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A fixed reference table built inside the JVM (SRC10): ``inline`` over a
    literal array of structs, no Python-side serialisation."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    types = [f.strip().split(" ", 1)[1] for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(r, names, types)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dim_corridor(spark: SparkSession, congestion_avg=C.CONGESTION_DEFAULT) -> DataFrame:
    """Five corridor rows from the subzone reference.  ``congestion_avg`` is
    a number or a one-row DataFrame with column ``congestion_index_avg``
    (the traffic-derived average, see plans.traffic.corridor_congestion)."""
    rows = [(i + 1, sz, C.HIGHWAYS[sz], float(v["distance_port_km"]), float(v["base_risk_weight"]),
             float(v["psa_incidence_historical"])) for i, (sz, v) in enumerate(C.SUBZONES.items())]
    ref = literal_table(spark, rows, "corridor_key int, subzone string, highway string, distance_port_km double, "
                                     "base_risk_weight double, psa_incidence_historical double")
    if isinstance(congestion_avg, DataFrame):
        ref = ref.crossJoin(F.broadcast(congestion_avg.select(F.col("congestion_index_avg").cast("double"))))
    else:
        ref = ref.withColumn("congestion_index_avg", F.lit(float(congestion_avg)))
    return ref.select("corridor_key", "subzone", "highway", "distance_port_km", "congestion_index_avg",
                      "base_risk_weight", "psa_incidence_historical")


# --------------------------------------------------------------------------
# dim_grower (JN4, PRJ17)
# --------------------------------------------------------------------------

def dim_grower(spark: SparkSession, sf_dir: str, corridor: DataFrame | None = None) -> DataFrame:
    """Grower register ⋈ corridor on subzone; own distance wins, corridor
    distance fills the gaps."""
    g = bindings.grower_register(spark, sf_dir)
    cor = F.broadcast((corridor if corridor is not None else dim_corridor(spark))
                      .select("subzone", "corridor_key", F.col("distance_port_km").alias("distance_port_km_corridor")))
    j = g.join(cor, "subzone", "left")
    return j.select("kpin", "subzone", "primary_variety", F.col("organic").cast("int").alias("organic"),
                    "orchard_ha",
                    F.coalesce("distance_port_km", "distance_port_km_corridor").alias("distance_port_km"),
                    F.col("psa_history").cast("int").alias("psa_history"),
                    "base_risk_weight", "dm_std_modifier", "corridor_key")


# --------------------------------------------------------------------------
# dim_fruit_quality: maturity readings pooled per grower × season × week × variety
# --------------------------------------------------------------------------

def reading_columns(g: DataFrame) -> DataFrame:
    """Readings from pooled rows: ``dm_sum`` and ``n`` of their submissions, ``reading_date``."""
    r = g.withColumns({"dm_centi": half_up_div("dm_sum", "n").cast("int"), "sample_size": F.col("n") * 90}).drop("dm_sum", "n")
    return r.withColumns({
        "dm_pct": F.col("dm_centi") / 100.0,
        "mts_threshold": DF.mts_threshold("variety"),
        "mts_pass": DF.mts_pass("dm_centi", "variety"),
        "tzg_score": DF.taste_score("dm_centi", "variety"),
    })


def readings(subs: DataFrame) -> DataFrame:
    """Maturity readings: the pooled composite of a grower's submissions in a
    pack week (partial aggregation happens map-side before the shuffle)."""
    return reading_columns(subs.groupBy(*READING_KEY, "subzone", "pest_indicator").agg(
        F.sum("dm_centi").alias("dm_sum"), F.count(F.lit(1)).alias("n"), F.min("submission_date").alias("reading_date")))


def dim_fruit_quality(subs: DataFrame) -> DataFrame:
    return fruit_columns(readings(subs))


def fruit_columns(r: DataFrame, *keep) -> DataFrame:
    """The stored columns of readings."""
    return r.select(
        *keep,
        "kpin", "season", "subzone", "variety",
        DF.growing_method("variety").alias("growing_method"),
        "pack_week", "reading_date", "dm_pct", "mts_threshold",
        DF.mts_status("mts_pass").alias("mts_status"),
        "tzg_score", DF.taste_grade("tzg_score", "mts_pass").alias("tzg_grade"),
        "pest_indicator",
        F.concat_ws("_", F.col("kpin").cast("string"), F.col("pack_week").cast("string")).alias("maturity_area"),
        "sample_size")


# --------------------------------------------------------------------------
# fact_export_transactions (JN1–JN3, DF19–DF23)
# --------------------------------------------------------------------------

FACT_COLUMNS = [
    "date_key", "corridor_key", "grower_key", "season", "subzone", "variety", "pack_week",
    "season_phase", "trays_submitted", "trays_exported", "trays_lost", "loss_pct",
    "dm_pct_avg", "tzg_score", "mts_pass", "submit_payment_nzd", "taste_payment_nzd",
    "total_return_nzd", "freight_cost_nzd", "margin_erosion_pct", "otif_pct", "risk_score",
    "congestion_index", "rainfall_mm_7d", "reg_index", "vol_index",
]


def fact(spark: SparkSession, sf_dir: str, subs: DataFrame | None = None,
         congestion=C.CONGESTION_DEFAULT, reg_index: float = C.REG_INDEX_DEFAULT,
         pest: float = C.PEST_DEFAULT, distance_km: float | None = C.DISTANCE_DEFAULT_KM,
         time_dim: DataFrame | None = None, keep=()) -> DataFrame:
    """Submission batches joined to their dimensions plus the operational
    measures.  Defaults follow the published build: one congestion value for
    all rows, regulation 15, pest 20 and a 30 km haul (``distance_km=None``
    uses the corridor distance instead).

    ``corridor_key`` comes from the five-row corridor table (broadcast) and
    the phase from the date spine (broadcast), so the fact rows are never
    shuffled here.  ``grower_key`` is taken from ``subs`` where it has one (the
    stored build); analytical queries do not read grower keys.  ``keep`` names
    further columns of ``subs``.
    """
    subs = subs if subs is not None else bindings.submissions(spark, sf_dir)
    td = F.broadcast((time_dim if time_dim is not None else dim_time(spark))
                     .select("date_key", "pack_week", "season_phase"))
    cor = F.broadcast(dim_corridor(spark).select("subzone", "corridor_key",
                                                 F.col("distance_port_km").alias("corridor_distance_km")))
    f = subs.join(cor, "subzone", "left").join(td, ["date_key", "pack_week"], "left")
    if "grower_key" not in f.columns:
        f = f.withColumn("grower_key", F.lit(None).cast("long"))
    km = F.lit(float(distance_km)) if distance_km is not None else F.col("corridor_distance_km")
    f = f.withColumns({
        "congestion_index": F.lit(float(congestion)),
        "rainfall_mm_7d": DF.rain_estimate("pack_week"),
        "reg_index": F.lit(float(reg_index)),
        "_km": km,
    })
    f = f.withColumns({
        "otif_pct": DF.otif("congestion_index", "rainfall_mm_7d", "reg_index", "mts_pass"),
        "risk_score": DF.risk_score("dm_pct_avg", F.lit(float(pest)), "congestion_index",
                                    "rainfall_mm_7d", "reg_index"),
        "freight_cost_nzd": DF.freight_cost("trays_exported", "_km", "congestion_index"),
        "margin_erosion_pct": DF.margin_erosion("total_return_nzd", "trays_submitted"),
        "mts_pass_int": F.col("mts_pass").cast("int"),
    })
    return f.select(*keep, "kpin", "submission_date", *FACT_COLUMNS, "mts_pass_int")


def fact_view(f: DataFrame) -> DataFrame:
    """Star-schema surface: booleans as 0/1 like the stored table (PRJ14)."""
    return f.drop("mts_pass").withColumnRenamed("mts_pass_int", "mts_pass")


def star_views(spark: SparkSession, sf_dir: str, **fact_kw) -> dict:
    """Register the star schema as temp views for ``spark.sql`` (SRC7)."""
    subs = bindings.submissions(spark, sf_dir)
    cor = dim_corridor(spark)
    views = {
        "dim_time": dim_time(spark, subs),
        "dim_corridor": cor,
        "dim_grower": dim_grower(spark, sf_dir, cor),
        "dim_fruit_quality": dim_fruit_quality(subs),
        "fact_export_transactions": fact_view(fact(spark, sf_dir, subs, **fact_kw)),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
