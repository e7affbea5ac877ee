"""Registry of every runnable query: name → callable(spark, sf_dir) → DataFrame."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregates as A
from .operators import quality as DQ
from .operators.aggregates import duplicate_count, null_profile, numeric_profile
from .plans import feed as P
from .plans import models as ML
from .plans import queries as Q
from .plans import stats as S
from .plans import traffic as T
from .plans import sql, star
from .session import apply_defaults, checkpoint_dir
from .streaming import streams as STR
from .sources import bindings, sinks
from .sources.tables import path_stamp, read_table, scratch_table, table_path


class Star:
    """Lazy star schema over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, **fact_kw):
        apply_defaults(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.subs = bindings.submissions(spark, sf_dir)
        self.time = star.dim_time(spark, self.subs)
        self.fact = star.fact(spark, sf_dir, self.subs, time_dim=self.time, **fact_kw)
        self.readings = star.readings(self.subs)
        self.fruit = star.dim_fruit_quality(self.subs)


_STARS: dict = {}

FACT_PROFILE_COLS = ["date_key", "corridor_key", "season", "subzone", "variety", "pack_week", "season_phase",
                     "trays_submitted", "dm_pct_avg", "otif_pct", "risk_score", "total_return_nzd",
                     "margin_erosion_pct"]


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    """One lazy star per (session, directory): DataFrames are immutable, so
    every query reuses the same analysed plans instead of re-reading footers
    and re-analysing the bindings.  Tables that were written anew get a new one."""
    stamps = tuple(path_stamp(spark, table_path(sf_dir, t)) for t in ("region", "nation", "supplier", "part", "lineitem"))
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _STARS or _STARS[key][0] != stamps:
        _STARS[key] = stamps, Star(spark, sf_dir)
    return _STARS[key][1]


def _star(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_for(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4, PRJ16, JN1, JN2: the surrogate keys of the stored star, by submission."""
    paths = sinks.build_star(apply_defaults(spark), sf_dir, _results(spark, "star"))
    fact, fruit, growers = (spark.read.parquet(paths[t]) for t in ("fact_export_transactions", "dim_fruit_quality", "dim_grower"))
    f = fact.select("order_key", "line_number", "export_id", "fruit_key", "grower_key")
    f = f.join(fruit.select("fruit_key", "dm_pct", "maturity_area"), "fruit_key", "left")
    return f.join(growers.select("grower_key", "kpin"), "grower_key", "left")


FACT_COUNT_COLS = ["trays_submitted", "trays_exported", "trays_lost", "pack_week", "risk_score"]


def _plain(df: DataFrame) -> DataFrame:
    """Money as DOUBLE, like the other published results."""
    return df.withColumns({c: df[c].cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def _results(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "results", f"{name}-{uuid.uuid4().hex}")


def _sql(name: str):
    """A named query as SQL text over the registered views of a directory."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star.star_views(apply_defaults(spark), sf_dir)
        return sql.run_sql(spark, name)
    return run


def query_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK9: the saved key figures of the six queries."""
    star.star_views(apply_defaults(spark), sf_dir)
    return sql.save_results(spark, _results(spark, "sql"))


def distinct_sketch_totals(fact: DataFrame) -> DataFrame:
    """AGG14: totals over all seasons from stored sketches of the seasons, beside the exact counts."""
    cols = ["kpin", "variety", "submission_date"]
    stored = scratch_table(A.distinct_sketches(fact, cols, ["season"]), "distinct-sketches")
    estimate = A.distinct_of_sketches(stored, cols)
    exact = fact.agg(*[F.countDistinct(c).alias(f"{c}_exact") for c in cols])
    both = estimate.crossJoin(exact)  # a row each
    return both.select(*[f"{c}_exact" for c in cols], *[
        (F.abs(F.col(c) - F.col(f"{c}_exact")) <= F.ceil(F.col(f"{c}_exact") * A.HLL_BOUND)).alias(f"{c}_within_bound") for c in cols])


def median_of_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10: the monthly median of event values from stored daily sketches, with
    whether its rank among the month's values is within the sketch's bound."""
    events = read_table(apply_defaults(spark), sf_dir, "events", ["ts", "value"]).where("ts is not null and value is not null")
    events = events.select(F.to_date("ts").alias("day"), F.trunc(F.to_date("ts"), "month").alias("month"), "value")
    daily = scratch_table(A.quantile_sketches(events, "value", ["day", "month"]), "quantile-sketches")
    medians = A.quantiles_of_sketches(daily, ["month"], {"median": 0.5})
    ranked = events.join(F.broadcast(medians), "month").groupBy("month").agg(  # a row a month
        F.max("n").alias("n"), F.sum((F.col("value") < F.col("median")).cast("long")).alias("below"),
        F.sum((F.col("value") <= F.col("median")).cast("long")).alias("not_above"))
    within = (F.col("below") <= F.col("n") * (0.5 + A.KLL_BOUND)) & (F.col("not_above") >= F.col("n") * (0.5 - A.KLL_BOUND))
    return ranked.select("month", "n", within.alias("within_bound"))


def traffic_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ1, SNK7: the audit trail that a run of the traffic path leaves."""
    path = _results(spark, "audit")
    T.audited_traffic(T.tms_15min(apply_defaults(spark), sf_dir), path, "run")
    return spark.read.schema(DQ.AUDIT).parquet(path).drop("run_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q1_compliance": _star(lambda s: Q.q1_compliance(s.fact)),
    "q2_otif_by_week": _star(lambda s: Q.q2_otif_by_week(s.fact, s.time)),
    "q3_dm_elasticity": _star(lambda s: Q.q3_dm_elasticity(s.fact)),
    "q4_dm_variance": _star(lambda s: Q.q4_dm_variance(s.fruit)),
    "q5_risk_bands": _star(lambda s: Q.q5_risk_bands(s.fact)),
    "q6_worst_weeks": _star(lambda s: Q.q6_worst_weeks(s.fact, s.time)),
    "v1_mts_fail_rate": _star(lambda s: Q.v1_mts_fail_rate(s.fact)),
    "v2_returns_by_season": _star(lambda s: Q.v2_returns_by_season(s.fact)),
    "v3_dm_by_subzone": _star(lambda s: Q.v3_dm_by_subzone(s.readings)),
    "v4_risk_distribution": _star(lambda s: Q.v4_risk_distribution(s.fact)),
    "v5_orphans": _star(lambda s: Q.v5_orphans(s.fact, s.readings)),
    "v6_otif_by_season": _star(lambda s: Q.v6_otif_by_season(s.fact)),
    "m3_seasonal_breakdown": _star(lambda s: Q.seasonal_breakdown(s.fact)),
    # the star schema on natural keys; grower_key is filled by the stored build
    "star_dim_time": _star(lambda s: s.time),
    "star_dim_corridor": lambda spark, d: star.dim_corridor(spark, T.corridor_congestion(T.traffic_daily(T.tms_15min(spark, d)))),
    "star_dim_grower": _star(lambda s: star.dim_grower(s.spark, s.sf_dir)),
    "star_dim_fruit_quality": _star(lambda s: s.fruit),
    "star_fact": _star(lambda s: _plain(star.fact_view(s.fact).drop("grower_key"))),
    "snk4_star_keys": lambda spark, d: stored_keys(spark, d),
    "df17_loss_causes": _star(lambda s: Q.loss_causes(s.subs)),
    "flt6_harvest_window": _star(lambda s: Q.harvest_window(s.subs)),
    "agg23_fact_profile": _star(lambda s: numeric_profile(s.fact.select(*FACT_COUNT_COLS))),
    "agg24_duplicate_rows": _star(lambda s: duplicate_count(s.fact.select("kpin", "season", "pack_week", "variety", "trays_submitted"))),
    # payload feed
    "p1_season_aggregate": _star(lambda s: P.season_aggregate(s.fact)),
    "p2_subzone_breakdown": _star(lambda s: P.subzone_breakdown(s.readings)),
    "p3_worst_week": _star(lambda s: P.worst_week(s.fact)),
    "p4_weekly_risk_arc": _star(lambda s: P.weekly_risk_arc(s.fact)),
    "p5_live_state": _star(lambda s: P.live_state(s.fact)),
    "p6_season_payloads": _star(lambda s: P.payload_json(P.payloads(s.fact, s.readings))),
    "p6_payload_fields": _star(lambda s: P.payload_fields(P.payload_json(P.payloads(s.fact, s.readings, feed=bindings.feed_landings(s.spark, s.sf_dir))))),
    "p6_live_payload": _star(lambda s: P.payload_fields(P.payload_json(P.payloads(s.fact, s.readings, feed=bindings.feed_landings(s.spark, s.sf_dir), live=True)))),
    "p7_subzone_profile": _star(lambda s: P.subzone_profile(P.subzone_breakdown(s.readings))),
    "jn12_feed_as_of": _star(lambda s: P.feed_as_of(s.fact, bindings.feed_landings(s.spark, s.sf_dir))),
    # data quality
    "dq_star_checks": _star(lambda s: DQ.star_checks(s.fact, s.readings, star.dim_corridor(s.spark), s.time, star.dim_grower(s.spark, s.sf_dir))),
    "dq_fact_health": _star(lambda s: DQ.fact_health(s.fact)),
    "dq_fact_null_profile": _star(lambda s: null_profile(s.fact.select(*FACT_PROFILE_COLS))),
    # traffic → congestion
    "traffic_daily": lambda spark, d: T.traffic_daily(T.tms_15min(spark, d)),
    "traffic_daily_counts": lambda spark, d: T.traffic_daily_counts(T.daily_counts(spark, d)),
    "congestion_profile": lambda spark, d: T.congestion_profile(T.traffic_daily(T.tms_15min(spark, d))),
    "weekly_congestion": lambda spark, d: T.weekly_congestion(T.traffic_daily(T.tms_15min(spark, d))),
    "corridor_congestion": lambda spark, d: T.corridor_congestion(T.traffic_daily(T.tms_15min(spark, d))),
    # annual statistics
    "export_statistics": lambda spark, d: S.export_statistics(spark, d),
    **{f"{name}_sql": _sql(name[:2]) for name in ("q1_compliance", "q2_otif_by_week", "q3_dm_elasticity", "q4_dm_variance", "q5_risk_bands",
                                                  "q6_worst_weeks")},
    "snk9_query_results": lambda spark, d: query_results(spark, d),
    "agg9_dm_by_variety": _star(lambda s: Q.dm_by_variety(s.fruit)),
    "agg14_distinct_counts": _star(lambda s: Q.distinct_counts(s.fact)),
    "agg14_distinct_sketches": _star(lambda s: distinct_sketch_totals(s.fact)),
    "agg22_season_validation": _star(lambda s: Q.season_validation(s.readings, s.subs)),
    "agg22_dm_by_subzone": _star(lambda s: Q.dm_by_subzone(s.readings)),
    "agg25_fact_totals": _star(lambda s: Q.fact_totals(s.fact)),
    "agg21_taste_grades": _star(lambda s: Q.grade_counts(s.fruit)),
    "jn11_subzone_shares": _star(lambda s: Q.subzone_shares(s.fact)),
    "flt7_active_growers": _star(lambda s: Q.active_growers(star.dim_grower(s.spark, s.sf_dir), s.fact, "1995/96")),
    "snk8_table_summary": _star(lambda s: DQ.table_summary(
        {"dim_time": s.time, "dim_grower": star.dim_grower(s.spark, s.sf_dir), "dim_fruit_quality": s.fruit, "fact_export_transactions": s.fact},
        {"dim_time": "date_key", "dim_grower": "kpin", "dim_fruit_quality": star.READING_KEY, "fact_export_transactions": star.READING_KEY})),
    "ml3_standardised_ranges": _star(lambda s: ML.standardised_ranges(s.readings)),
    "agg10_quantile_sketches": lambda spark, d: median_of_sketches(spark, d),
    "dq1_traffic_audit": lambda spark, d: traffic_audit(spark, d),
    "df30_scenario_rescore": _star(lambda s: Q.rescore(s.fact)),
    "win7_dm_elasticity": _star(lambda s: Q.dm_elasticity(s.fact)),
    "win6_rain_7d": lambda spark, d: T.rain_daily_7d(spark, d),
    # models
    "m1_mts_model": _star(lambda s: ML.m1(s.spark, s.readings)),
    "m2_otif_model": _star(lambda s: ML.m2(s.spark, s.fact)),
    "m2b_otif_model_leak_free": _star(lambda s: ML.m2(s.spark, s.fact, leak_free=True)),
    "m2_weight_alignment": _star(lambda s: ML.m2_alignment(s.spark, s.fact)),
    "snk10_model_coefficients": _star(lambda s: ML.save_reports(s.spark, s.readings, s.fact, _results(s.spark, "models"))),
    "ml_rule_metrics": _star(lambda s: ML.rule_metrics(s.fact)),
    # streaming (availableNow runs over the whole table)
    "str1_daily_traffic_stream": lambda spark, d: STR.daily_traffic_stream_batch(spark, d),
    "str2_rain_7d_stream": lambda spark, d: STR.rain_7d_stream_batch(spark, d),
    "str3_dedupe_stream": lambda spark, d: STR.dedupe_stream_batch(spark, d),
    "str4_live_state_stream": lambda spark, d: STR.live_state_batch(spark, d),
    "str5_enrich_stream": lambda spark, d: STR.enrich_stream_batch(spark, d),
    "str6_publish_stream": lambda spark, d: STR.publish_stream_batch(spark, d),
}


def oracle() -> dict[str, str]:
    from .plans.oracle_sql import queries_sql
    return queries_sql()
