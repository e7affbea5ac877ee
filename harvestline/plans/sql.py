"""The named queries as SQL text over the registered star views (SRC7, SNK9).

Averages and shares are rounded half up from whole numbers, like the
DataFrame forms: a column that holds ``d`` decimals is summed as an integer
of that many.  Money is DECIMAL.  ``save_results`` runs all of them and keeps
results, texts and key figures.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.aggregates import numeric_profile


def half_up(num: str, den: str, dp: int) -> str:
    """num / den to ``dp`` decimals, for whole numbers; null where den is 0."""
    return f"(2 * {10 ** dp} * ({num}) + ({den})) div nullif(2 * ({den}), 0) / {10 ** dp}D"


def average(column: str, held: int, dp: int) -> str:
    """avg(column), a column of ``held`` decimals, to ``dp`` decimals."""
    return half_up(f"sum(cast(round({column} * {10 ** held}) AS bigint))", f"count({column}) * {10 ** held}", dp)


def share(num: str, den: str, dp: int) -> str:
    return half_up(f"100 * ({num})", den, dp)


def money(total: str, unit: str, dp: int) -> str:
    return f"cast(round(({total}) * {unit}BD, {dp}) AS double)"


def case_of(column: str, steps) -> str:
    """The step that a column's value is in, by a table of steps."""
    *first, (_, last) = steps
    return "CASE " + " ".join(f"WHEN {column} < {upper} THEN '{name}'" for upper, name in first) + f" ELSE '{last}' END"


FAILED, REVERSED = "count_if(mts_pass = 0)", "sum(if(mts_pass = 0, submit_payment_nzd, 0))"
BELOW, ABOVE = f"count_if(otif_pct < {C.OTIF_TARGET})", f"count_if(otif_pct >= {C.OTIF_TARGET})"

QUERIES = {
    "q1": f"""
SELECT season, variety, count(*) AS total_submissions, {FAILED} AS mts_fails,
       {share(FAILED, "count(*)", 2)} AS mts_fail_pct, {average("dm_pct_avg", 2, 3)} AS avg_dm_pct,
       round(min(dm_pct_avg), 2) AS min_dm_pct, {money(REVERSED, "0.001", 2)} AS payment_reversed_nzd_k
FROM fact_export_transactions
GROUP BY season, variety
ORDER BY season, mts_fail_pct DESC, variety
""",
    "q2": f"""
SELECT f.pack_week, t.season_phase, {average("otif_pct", 2, 2)} AS avg_otif, round(min(otif_pct), 2) AS min_otif,
       round(avg(congestion_index), 2) AS avg_congestion, {average("rainfall_mm_7d", 1, 1)} AS avg_rainfall_mm,
       count(*) AS submissions, {BELOW} AS below_target_count, {share(BELOW, "count(*)", 1)} AS below_target_pct
FROM fact_export_transactions f JOIN dim_time t ON t.date_key = f.date_key
GROUP BY f.pack_week, t.season_phase
ORDER BY f.pack_week, t.season_phase
""",
    "q3": f"""
SELECT (2 * cast(round(dm_pct_avg * 100) AS bigint) + 10) div 20 / 10D AS dm_pct_band, count(*) AS submissions,
       {average("tzg_score", 3, 3)} AS avg_tzg,
       round(avg(cast(taste_payment_nzd AS double) / nullif(trays_exported, 0)), 4) AS avg_taste_per_tray,
       round(avg(cast(total_return_nzd AS double) / nullif(trays_submitted, 0)), 4) AS avg_return_per_tray,
       {money("sum(total_return_nzd)", "0.000001", 2)} AS total_return_nzd_m, {average("margin_erosion_pct", 2, 2)} AS avg_margin_erosion_pct
FROM fact_export_transactions
WHERE mts_pass = 1
GROUP BY dm_pct_band
ORDER BY dm_pct_band
""",
    "q4": f"""
SELECT subzone, season, count(*) AS readings, {average("dm_pct", 2, 3)} AS dm_mean, round(stddev_pop(dm_pct), 3) AS dm_std,
       round(min(dm_pct), 2) AS dm_min, round(max(dm_pct), 2) AS dm_max, round(max(dm_pct) - min(dm_pct), 2) AS dm_range,
       {share("count_if(mts_status = 'FAIL')", "count(*)", 1)} AS mts_fail_pct
FROM dim_fruit_quality
GROUP BY subzone, season
ORDER BY subzone, season
""",
    "q5": f"""
SELECT {case_of("risk_score", C.RISK_BANDS)} AS risk_band, count(*) AS total,
       {BELOW} AS otif_below_88, {share(BELOW, "count(*)", 1)} AS detection_rate_pct,
       {ABOVE} AS otif_above_88, {share(ABOVE, "count(*)", 1)} AS false_alarm_rate_pct
FROM fact_export_transactions
GROUP BY risk_band
ORDER BY risk_band
""",
    "q6": f"""
SELECT f.season, f.pack_week, t.season_phase, f.subzone, {average("risk_score", 0, 1)} AS avg_risk_score,
       cast(max(risk_score) AS double) AS max_risk_score, {average("dm_pct_avg", 2, 3)} AS avg_dm, {average("otif_pct", 2, 2)} AS avg_otif,
       round(avg(congestion_index), 1) AS avg_congestion, {average("rainfall_mm_7d", 1, 1)} AS avg_rainfall,
       count(*) AS submissions, {FAILED} AS mts_fails, {money("sum(total_return_nzd)", "0.000001", 3)} AS return_nzd_m,
       {money(REVERSED, "0.001", 2)} AS payments_reversed_nzd_k
FROM fact_export_transactions f JOIN dim_time t ON t.date_key = f.date_key
GROUP BY f.season, f.pack_week, t.season_phase, f.subzone
ORDER BY avg_risk_score DESC, season, pack_week, subzone
LIMIT 20
""",
}


def run_sql(spark: SparkSession, name: str) -> DataFrame:
    """A named query over the views that are registered in the session."""
    return spark.sql(QUERIES[name])


def save_results(spark: SparkSession, out_dir: str) -> DataFrame:
    """SNK9: run every named query, save its rows (``results/qN``) and its text
    (``texts``), and return the saved key figures: minimum, maximum and average of
    every number column of every result."""
    figures = []
    for name in QUERIES:
        path = f"{out_dir}/results/{name}"
        rows = run_sql(spark, name)
        rows.write.mode("overwrite").parquet(path)
        saved = spark.read.schema(rows.schema).parquet(path)
        figures.append(numeric_profile(saved).select(F.lit(name).alias("query"), "column", *[F.round(c, 6).alias(c) for c in ("min", "max", "avg")]))
    texts = spark.createDataFrame(list(QUERIES.items()), "query string, value string")
    texts.write.mode("overwrite").partitionBy("query").text(f"{out_dir}/texts")
    reduce(DataFrame.unionByName, figures).write.mode("overwrite").parquet(f"{out_dir}/figures")
    return spark.read.parquet(f"{out_dir}/figures")
