"""The named analytical queries Q1–Q6, the load-time validation queries V1–V6
and the seasonal breakdown (AGG18) over the star schema.

Each takes DataFrames, returns a DataFrame with the published column names
and is fully lazy.  All groupings are partial+final hash aggregates: the
shuffle carries one partial row per group per task, never the fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import formulas as DF
from ..functions.scalars import half_up_div
from ..operators.aggregates import (avg_fixed, avg_round, count_if, money_scaled, money_sum, pct,
                                    fixed_int)
from ..operators.ordering import top_k

def FAIL():
    return ~F.col("mts_pass")


def BELOW():
    return F.col("otif_pct") < C.OTIF_TARGET


def q1_compliance(f: DataFrame) -> DataFrame:
    """Q1: maturity-standard compliance by season × variety."""
    g = f.groupBy("season", "variety").agg(
        F.count(F.lit(1)).alias("total_submissions"),
        count_if(FAIL()).alias("mts_fails"),
        avg_fixed("dm_pct_avg", 2, 3).alias("avg_dm_pct"),
        F.round(F.min("dm_pct_avg"), 2).alias("min_dm_pct"),
        money_scaled(money_sum("submit_payment_nzd", FAIL()), 1000, 2).alias("payment_reversed_nzd_k"))
    return (g.select("season", "variety", "total_submissions", "mts_fails",
                     pct("mts_fails", "total_submissions", 2).alias("mts_fail_pct"),
                     "avg_dm_pct", "min_dm_pct", "payment_reversed_nzd_k")
             .orderBy("season", F.desc("mts_fail_pct"), "variety"))


def q2_otif_by_week(f: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Q2: OTIF degradation by pack week × phase (inner join to dim_time, JN5)."""
    t = F.broadcast(time_dim.select("date_key", F.col("season_phase").alias("t_phase")))
    j = f.join(t, "date_key")
    g = j.groupBy("pack_week", F.col("t_phase").alias("season_phase")).agg(
        avg_fixed("otif_pct", 2, 2).alias("avg_otif"),
        F.round(F.min("otif_pct"), 2).alias("min_otif"),
        avg_round("congestion_index", 2).alias("avg_congestion"),
        avg_fixed("rainfall_mm_7d", 1, 1).alias("avg_rainfall_mm"),
        F.count(F.lit(1)).alias("submissions"),
        count_if(BELOW()).alias("below_target_count"))
    return (g.withColumn("below_target_pct", pct("below_target_count", "submissions", 1))
             .orderBy("pack_week", "season_phase"))


def q3_dm_elasticity(f: DataFrame) -> DataFrame:
    """Q3: value per 0.1 % dry-matter band, passing fruit only (FLT4, AGG4)."""
    p = f.filter(F.col("mts_pass"))
    band = half_up_div(fixed_int("dm_pct_avg", 2), F.lit(10))  # ROUND(dm, 1), exact
    taste_tray = F.col("taste_payment_nzd").cast("double") / F.when(F.col("trays_exported") != 0, F.col("trays_exported"))
    ret_tray = F.col("total_return_nzd").cast("double") / F.when(F.col("trays_submitted") != 0, F.col("trays_submitted"))
    g = p.groupBy((band / 10.0).alias("dm_pct_band")).agg(
        F.count(F.lit(1)).alias("submissions"),
        avg_fixed("tzg_score", 3, 3).alias("avg_tzg"),
        F.round(F.avg(taste_tray), 4).alias("avg_taste_per_tray"),
        F.round(F.avg(ret_tray), 4).alias("avg_return_per_tray"),
        money_scaled(money_sum("total_return_nzd"), 1_000_000, 2).alias("total_return_nzd_m"),
        avg_fixed("margin_erosion_pct", 2, 2).alias("avg_margin_erosion_pct"))
    return g.orderBy("dm_pct_band")


def q4_dm_variance(readings: DataFrame) -> DataFrame:
    """Q4: dry-matter spread by subzone × season.  The published self-join to
    the group mean is replaced by ``stddev_pop`` (AGG8): one pass, no join."""
    g = readings.groupBy("subzone", "season").agg(
        F.count(F.lit(1)).alias("readings"),
        avg_fixed("dm_pct", 2, 3).alias("dm_mean"),
        F.round(F.stddev_pop("dm_pct"), 3).alias("dm_std"),
        F.round(F.min("dm_pct"), 2).alias("dm_min"),
        F.round(F.max("dm_pct"), 2).alias("dm_max"),
        ((F.max(fixed_int("dm_pct", 2)) - F.min(fixed_int("dm_pct", 2))) / 100.0).alias("dm_range"),
        count_if(F.col("mts_status") == "FAIL").alias("_fails"))
    return (g.withColumn("mts_fail_pct", pct("_fails", "readings", 1)).drop("_fails")
             .orderBy("subzone", "season"))


def q5_risk_bands(f: DataFrame) -> DataFrame:
    """Q5: does the risk band predict OTIF < 88 (AGG5 inside, AGG7 outside)."""
    g = f.groupBy(DF.risk_band4("risk_score").alias("risk_band")).agg(
        F.count(F.lit(1)).alias("total"),
        count_if(BELOW()).alias("otif_below_88"),
        count_if(F.col("otif_pct") >= C.OTIF_TARGET).alias("otif_above_88"))
    return (g.select("risk_band", "total", "otif_below_88",
                     pct("otif_below_88", "total", 1).alias("detection_rate_pct"),
                     "otif_above_88",
                     pct("otif_above_88", "total", 1).alias("false_alarm_rate_pct"))
             .orderBy("risk_band"))


def _week_subzone(f: DataFrame, time_dim: DataFrame) -> DataFrame:
    t = F.broadcast(time_dim.select("date_key", F.col("season_phase").alias("t_phase")))
    j = f.join(t, "date_key")
    return j.groupBy("season", "pack_week", F.col("t_phase").alias("season_phase"), "subzone").agg(
        avg_fixed("risk_score", 0, 1).alias("avg_risk_score"),
        F.max("risk_score").cast("double").alias("max_risk_score"),
        avg_fixed("dm_pct_avg", 2, 3).alias("avg_dm"),
        avg_fixed("otif_pct", 2, 2).alias("avg_otif"),
        avg_round("congestion_index", 1).alias("avg_congestion"),
        avg_fixed("rainfall_mm_7d", 1, 1).alias("avg_rainfall"),
        F.count(F.lit(1)).alias("submissions"),
        count_if(FAIL()).alias("mts_fails"),
        money_scaled(money_sum("total_return_nzd"), 1_000_000, 3).alias("return_nzd_m"),
        money_scaled(money_sum("submit_payment_nzd", FAIL()), 1000, 2).alias("payments_reversed_nzd_k"))


def q6_worst_weeks(f: DataFrame, time_dim: DataFrame, k: int = 20) -> DataFrame:
    """Q6: top-k season × week × subzone by average risk (SRT2).  Ties are
    broken by season, pack week, subzone so the k rows are deterministic."""
    g = _week_subzone(f, time_dim)
    return top_k(g, k, [F.desc("avg_risk_score"), "season", "pack_week", "subzone"])


# --------------------------------------------------------------------------
# Validation queries (V1–V6)
# --------------------------------------------------------------------------

def v1_mts_fail_rate(f: DataFrame) -> DataFrame:
    g = f.agg(F.count(F.lit(1)).alias("_n"), count_if(FAIL()).alias("_fails"))
    return g.select(pct("_fails", "_n", 2).alias("mts_fail_pct"))


def v2_returns_by_season(f: DataFrame) -> DataFrame:
    return (f.groupBy("season").agg(
        money_scaled(money_sum("total_return_nzd"), 1_000_000, 2).alias("return_nzd_m"),
        F.count(F.lit(1)).alias("submissions")).orderBy("season"))


def v3_dm_by_subzone(readings: DataFrame) -> DataFrame:
    return (readings.groupBy("subzone").agg(
        avg_fixed("dm_pct", 2, 3).alias("dm_mean"),
        avg_fixed("tzg_score", 3, 3).alias("tzg_mean"),
        F.count(F.lit(1)).alias("readings")).orderBy(F.desc("dm_mean"), "subzone"))


def v4_risk_distribution(f: DataFrame) -> DataFrame:
    """AGG6: load-check bands ordered by their lowest score; share of all rows
    via a window over the four grouped rows (JN11 without a second scan)."""
    g = f.groupBy(DF.risk_band_load("risk_score").alias("risk_band")).agg(
        F.count(F.lit(1)).alias("submissions"), F.min("risk_score").alias("_min"))
    total = F.sum("submissions").over(Window.partitionBy())
    return (g.withColumn("pct", pct("submissions", total, 1))
             .orderBy("_min").drop("_min"))


def v5_orphans(f: DataFrame, readings: DataFrame, keys=("kpin", "season", "pack_week", "variety")) -> DataFrame:
    """FK integrity: fact rows with no fruit-quality row (JN7, left_anti)."""
    from ..operators.joins import orphans
    return orphans(f, readings, list(keys)).agg(F.count(F.lit(1)).alias("orphan_rows"))


def v6_otif_by_season(f: DataFrame) -> DataFrame:
    return (f.groupBy("season").agg(
        avg_fixed("otif_pct", 2, 2).alias("avg_otif"),
        F.round(F.min("otif_pct"), 2).alias("min_otif"),
        F.count(F.lit(1)).alias("submissions")).orderBy("season"))


def seasonal_breakdown(f: DataFrame) -> DataFrame:
    """AGG18: totals, risk, OTIF, fail rates, returns and reversals by season."""
    g = f.groupBy("season").agg(
        F.count(F.lit(1)).alias("total"),
        avg_fixed("risk_score", 0, 1).alias("avg_risk"),
        avg_fixed("otif_pct", 2, 2).alias("avg_otif"),
        count_if(FAIL()).alias("_fails"),
        count_if(BELOW()).alias("_below"),
        money_scaled(money_sum("total_return_nzd"), 1_000_000, 2).alias("return_nzd_m"),
        money_scaled(money_sum("submit_payment_nzd", FAIL()), 1_000_000, 3).alias("reversed_nzd_m"))
    return (g.select("season", "total", "avg_risk", "avg_otif",
                     pct("_fails", "total", 1).alias("mts_fail_pct"),
                     pct("_below", "total", 1).alias("otif_fail_pct"),
                     "return_nzd_m", "reversed_nzd_m").orderBy("season"))


# --------------------------------------------------------------------------
# Scenario re-scoring (DF30) and elasticity (WIN7)
# --------------------------------------------------------------------------

# scenario inputs: congestion, extra 7-day rain (mm), regulation, pest
SCENARIOS = [("baseline", C.CONGESTION_DEFAULT, 0.0, C.REG_INDEX_DEFAULT, C.PEST_DEFAULT),
             ("wet_week", C.CONGESTION_DEFAULT, 40.0, C.REG_INDEX_DEFAULT, C.PEST_DEFAULT),
             ("clear_corridor", 40.0, 0.0, C.REG_INDEX_DEFAULT, C.PEST_DEFAULT),
             ("regulatory_load", C.CONGESTION_DEFAULT, 0.0, 40.0, 35.0)]


def rescore(f: DataFrame, scenarios=SCENARIOS) -> DataFrame:
    """DF30: apply user-set inputs to every submission and re-score OTIF and
    risk with DF20/DF21.

    A score depends on pack week, dry matter and maturity alone, so submissions
    are counted by these first; every count is then scored under each scenario in
    its own columns, and the columns become rows after the last aggregate.  No row
    is multiplied."""
    counted = f.groupBy("pack_week", "dm_pct_avg", "mts_pass").agg(F.count(F.lit(1)).alias("n"))
    sums, n = [], F.col("n")
    for k, (_, congestion, rain_add, regulation, pest) in enumerate(scenarios):
        cong, reg = F.lit(float(congestion)), F.lit(float(regulation))
        rain = DF.rain_estimate("pack_week") + F.lit(float(rain_add))
        otif = DF.otif(cong, rain, reg, "mts_pass")
        risk = DF.risk_score("dm_pct_avg", F.lit(float(pest)), cong, rain, reg)
        sums += [F.sum(fixed_int(otif, 2) * n).alias(f"otif_{k}"), F.sum(F.when(otif.isNotNull(), n)).alias(f"otif_n_{k}"),
                 F.sum(risk * n).alias(f"risk_{k}"), F.sum(F.when(risk.isNotNull(), n)).alias(f"risk_n_{k}"),
                 F.sum(F.when(otif < C.OTIF_TARGET, n).otherwise(0)).alias(f"below_{k}")]
    total = counted.agg(F.sum("n").alias("rows"), *sums)
    each = [F.struct(F.lit(s[0]).alias("scenario"), F.coalesce("rows", F.lit(0)).cast("long").alias("submissions"),
                     (half_up_div(f"otif_{k}", f"otif_n_{k}") / 100.0).alias("avg_otif"),
                     (half_up_div(F.col(f"risk_{k}") * 10, f"risk_n_{k}") / 10.0).alias("avg_risk"),
                     F.coalesce(f"below_{k}", F.lit(0)).cast("long").alias("below_target")) for k, s in enumerate(scenarios)]
    return total.select(F.inline(F.array(*each)))


def dm_elasticity(f: DataFrame) -> DataFrame:
    """WIN7: change in return per tray from one 0.1 % DM band to the next."""
    from ..operators.windows import marginal_change
    q3 = q3_dm_elasticity(f).select("dm_pct_band", "avg_return_per_tray")
    out = marginal_change(q3, "dm_pct_band", "avg_return_per_tray", "_d")
    return out.withColumn("return_per_tray_change", F.round("_d", 4)).drop("_d")


# --------------------------------------------------------------------------
# Losses and harvest windows (DF17, DF18, AGG21, FLT6)
# --------------------------------------------------------------------------

def loss_causes(subs: DataFrame) -> DataFrame:
    """Submissions that lost trays by cause, with financial impact and share of all of them."""
    lost = subs.filter(F.col("trays_lost") > 0).withColumns({
        "cause": DF.loss_cause("mts_pass", "loss_draw"),
        "impact": DF.loss_financial_impact("submit_payment_nzd", "mts_pass", "trays_lost")})
    g = lost.groupBy("cause").agg(F.count(F.lit(1)).alias("events"), F.sum("trays_lost").cast("long").alias("trays_lost"),
                                  F.sum("impact").cast("double").alias("impact_nzd"))
    total = F.sum("events").over(Window.partitionBy())  # a row a cause
    return g.withColumns({"share_pct": pct("events", total, 1), "ccp": DF.ccp_triggered("cause").cast("int"),
                          "market_block": DF.market_block_risk("cause").cast("int")})


def harvest_window(subs: DataFrame) -> DataFrame:
    """FLT6: submissions and trays inside the harvest window of their variety."""
    from ..operators.joins import in_range
    from .star import literal_table
    windows = literal_table(subs.sparkSession, [(v, a, b) for v, (a, b) in C.HARVEST_WINDOW.items()],
                            "variety string, first int, last int")
    return in_range(subs, windows, "variety", "pack_week", "first", "last").groupBy("variety").agg(
        F.count(F.lit(1)).alias("submissions"), F.sum("trays_submitted").cast("long").alias("trays"))


# --------------------------------------------------------------------------
# Validation summaries (AGG9, AGG14, AGG22, AGG25)
# --------------------------------------------------------------------------

def dm_by_variety(fruit: DataFrame) -> DataFrame:
    """AGG9: mean, sample std and range of dry matter by variety."""
    return fruit.groupBy("variety").agg(
        F.count(F.lit(1)).alias("readings"), avg_fixed("dm_pct", 2, 2).alias("dm_mean"), F.round(F.stddev_samp("dm_pct"), 2).alias("dm_std"),
        F.round(F.min("dm_pct"), 1).alias("dm_min"), F.round(F.max("dm_pct"), 1).alias("dm_max"))


def season_validation(readings: DataFrame, subs: DataFrame, lo: float = 85.0, hi: float = 97.0) -> DataFrame:
    """AGG22: by season the share of passed readings and whether it is in the
    expected range, the returns and the trays."""
    passed = readings.groupBy("season").agg(pct(count_if(F.col("mts_pass")), F.count(F.lit(1)), 1).alias("pass_pct"))
    returns = subs.groupBy("season").agg(money_scaled(money_sum("total_return_nzd"), 1_000_000, 1).alias("return_nzd_m"),
                                         F.sum("trays_submitted").cast("long").alias("trays_submitted"))
    return passed.join(returns, "season", "left").withColumn("expected", F.col("pass_pct").between(lo, hi))


def dm_by_subzone(readings: DataFrame) -> DataFrame:
    """AGG22: mean and sample std of dry matter by subzone, the steadiest first."""
    return readings.groupBy("subzone").agg(
        avg_fixed("dm_pct", 2, 2).alias("dm_mean"), F.round(F.stddev_samp("dm_pct"), 2).alias("dm_std")).orderBy("dm_std", "subzone")


def fact_totals(f: DataFrame) -> DataFrame:
    """AGG25: the totals that the load reports."""
    return f.agg(
        F.count(F.lit(1)).alias("rows"), money_scaled(money_sum("total_return_nzd"), 1_000_000, 1).alias("total_return_nzd_m"),
        F.sum("trays_submitted").cast("long").alias("total_trays"), avg_fixed("otif_pct", 2, 1).alias("avg_otif"),
        avg_fixed("risk_score", 0, 1).alias("avg_risk"), pct(count_if(F.col("mts_pass")), F.count(F.lit(1)), 1).alias("mts_pass_pct"))


def distinct_counts(f: DataFrame) -> DataFrame:
    """AGG14: growers, varieties and submission days of a season, exact."""
    return f.groupBy("season").agg(F.countDistinct("kpin").alias("growers"), F.countDistinct("variety").alias("varieties"),
                                   F.countDistinct("submission_date").alias("days"))


def grade_counts(fruit: DataFrame) -> DataFrame:
    """AGG21: readings by taste grade with their share."""
    from ..operators.aggregates import value_counts
    return value_counts(fruit, "tzg_grade")


def subzone_shares(f: DataFrame) -> DataFrame:
    """JN11: each subzone's share of all trays submitted."""
    from ..operators.joins import share_of_total
    trays = f.groupBy("subzone").agg(F.sum("trays_submitted").cast("long").alias("trays"))
    return share_of_total(trays, "trays").withColumn("share", F.round("share", 6))


def active_growers(growers: DataFrame, f: DataFrame, season: str) -> DataFrame:
    """FLT7, SRC8: growers that submitted in a season, by variety."""
    from ..operators.joins import exists_in
    from ..sources.sinks import season_slice
    return exists_in(growers, season_slice(f, season), ["kpin"]).groupBy("primary_variety").agg(F.count(F.lit(1)).alias("growers"))
