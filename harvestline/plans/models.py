"""Risk-score validation models M1–M2 and the fixed-rule check (ML1–ML13).

M1 predicts a maturity failure from a reading; M2 predicts OTIF < 88 from
the risk inputs.  M2 keeps the published feature set, whose ``mts_pass``
leaks the target (hazard H5: OTIF < 88 exactly when the fruit failed); the
leak-free variant drops it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..operators import models as M

M1_FEATURES = ["dm_dist_to_mts", "pest_indicator", "pack_week_norm", "is_opotiki", "stress_season"]
M2_FEATURES = ["dm_norm", "cong_norm", "rain_norm", "reg_norm", "mts_pass", "pw_norm", "is_opotiki", "stress_season"]
DESIGNED = {"dm_norm": 0.35, "cong_norm": 0.15, "rain_norm": 0.15, "reg_norm": 0.10, "mts_pass": 0.25,
            "pw_norm": 0.0, "is_opotiki": 0.0, "stress_season": 0.0}


def features_mts(readings: DataFrame) -> DataFrame:
    """ML1 over dim_fruit_quality rows."""
    return readings.select(
        "kpin", "season", "pack_week", "variety",
        (F.col("dm_pct") - F.col("mts_threshold")).alias("dm_dist_to_mts"),
        F.col("pest_indicator").cast("double").alias("pest_indicator"),
        ((F.col("pack_week") - 11) / 15.0).alias("pack_week_norm"),
        (F.col("subzone") == "Opotiki").cast("double").alias("is_opotiki"),
        (F.col("season") == C.STRESS_SEASON).cast("double").alias("stress_season"),
        (~F.col("mts_pass")).cast("double").alias("label"))


def features_otif(fact: DataFrame) -> DataFrame:
    """ML2 over fact rows (rain clipped at 120)."""
    return fact.select(
        "kpin", "season", "pack_week", "variety", "submission_date", "dm_pct_avg", "trays_submitted",
        F.col("dm_pct_avg").alias("dm_norm"),
        F.col("congestion_index").alias("cong_norm"),
        F.least(F.col("rainfall_mm_7d"), F.lit(120.0)).alias("rain_norm"),
        F.col("reg_index").alias("reg_norm"),
        F.col("mts_pass").cast("double").alias("mts_pass"),
        ((F.col("pack_week") - 11) / 15.0).alias("pw_norm"),
        (F.col("subzone") == "Opotiki").cast("double").alias("is_opotiki"),
        (F.col("season") == C.STRESS_SEASON).cast("double").alias("stress_season"),
        (F.col("otif_pct") < C.OTIF_TARGET).cast("double").alias("label"))


def run_model(spark: SparkSession, df: DataFrame, features, keys, cv: bool = True):
    """Count equal rows → standardise → split → fit → test metrics, McFadden and CV F1.
    Returns (metrics row DataFrame, coefficients DataFrame)."""
    return run_counted(spark, M.count_rows(df, features, "label", keys), features, cv)


def run_counted(spark: SparkSession, counted: DataFrame, features, cv: bool = True):
    """``run_model`` from counted rows, which may hold further features.  The metrics
    are one aggregate row; it is materialised so the persisted features can
    be released before the result is returned."""
    # the standardised features feed the fit, the test metrics and every CV
    # fold, so they are computed once and kept (memory, spilling to disk)
    z = M.standardise_counted(counted, features).withColumn("test", F.col("n") - F.col("train")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = M.fit_logit(z.where("train > 0"), features, "label", weight="train")
        pred = M.predict(model, z.where("test > 0"), features)
        row = M.binary_metrics(pred, weight="test").crossJoin(M.mcfadden(pred, weight="test")).first()
        cv_score = M.cv_f1_counted(z, features, "label") if cv else None
    finally:
        z.unpersist()
    metrics = spark.createDataFrame([row]).withColumn("cv_f1", F.lit(cv_score).cast("double"))
    metrics = metrics.withColumn("n_test", (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")))
    return metrics, M.coef_table(spark, model, features)


def m1(spark: SparkSession, readings: DataFrame, cv: bool = True) -> DataFrame:
    metrics, _ = run_model(spark, features_mts(readings), M1_FEATURES, ["kpin", "season", "pack_week", "variety"], cv)
    return metrics.select(F.lit("m1_mts_fail").alias("model"), "*")


def m2(spark: SparkSession, fact: DataFrame, leak_free: bool = False, cv: bool = True) -> DataFrame:
    feats = [f for f in M2_FEATURES if not (leak_free and f == "mts_pass")]
    keys = ["kpin", "season", "pack_week", "variety", "submission_date", "dm_pct_avg", "trays_submitted"]
    metrics, _ = run_model(spark, features_otif(fact), feats, keys, cv)
    return metrics.select(F.lit("m2_otif_below_88" + ("_leak_free" if leak_free else "")).alias("model"), "*")


def m2_alignment(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """ML12: learned vs designed weights for model 2."""
    keys = ["kpin", "season", "pack_week", "variety", "submission_date", "dm_pct_avg", "trays_submitted"]
    _, coefs = run_model(spark, features_otif(fact), M2_FEATURES, keys, cv=False)
    return M.weight_alignment(coefs, DESIGNED)


def standardised_ranges(readings: DataFrame) -> DataFrame:
    """ML1, ML3: the range of every standardised feature of M1, a row a feature."""
    z = M.standardise(features_mts(readings), M1_FEATURES)
    wide = z.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{c}_{k}") for c in M1_FEATURES for k, f in (("lo", F.min), ("hi", F.max))])
    return wide.select("n", F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.round(f"{c}_lo", 6).alias("z_min"), F.round(f"{c}_hi", 6).alias("z_max"))
                                               for c in M1_FEATURES])))


def save_reports(spark: SparkSession, readings: DataFrame, fact: DataFrame, out_dir: str) -> DataFrame:
    """SNK10: fit M1, M2 and the leak-free M2, and save what the validation report
    shows of them: ``metrics`` and ``confusion`` by model, ``coefficients`` with
    direction and rank (ML11, SRT5), ``alignment`` with the designed weights (ML12).
    Returns the saved coefficients."""
    keys = ["kpin", "season", "pack_week", "variety", "submission_date", "dm_pct_avg", "trays_submitted"]
    free = [f for f in M2_FEATURES if f != "mts_pass"]
    otif = M.count_rows(features_otif(fact), M2_FEATURES, "label", keys)  # both models of it have its rows
    runs = {"m1_mts_fail": (M.count_rows(features_mts(readings), M1_FEATURES, "label", keys[:4]), M1_FEATURES),
            "m2_otif_below_88": (otif, M2_FEATURES), "m2_otif_below_88_leak_free": (otif, free)}
    for name, (counted, features) in runs.items():
        metrics, coefs = run_counted(spark, counted, features)
        ranked = coefs.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("coefficient").desc(), "feature")))  # a row a feature
        cells = F.expr("stack(4, 1, 1, tp, 0, 0, tn, 0, 1, fp, 1, 0, fn) as (label, pred, rows)")
        for table, rows in (("metrics", metrics), ("confusion", metrics.select(cells)), ("coefficients", ranked),
                            ("alignment", M.weight_alignment(coefs, DESIGNED))):
            rows.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/{table}/model={name}")
    return spark.read.option("basePath", f"{out_dir}/coefficients").parquet(f"{out_dir}/coefficients")


def rule_metrics(fact: DataFrame, threshold: int = 45) -> DataFrame:
    """ML7–ML9 for a fixed rule: the risk score predicts OTIF < 88 when it
    reaches ``threshold`` (the ELEVATED band); probability = risk/100."""
    x = fact.select((F.col("otif_pct") < C.OTIF_TARGET).cast("int").alias("label"),
                    (F.col("risk_score") >= threshold).cast("int").alias("pred"),
                    (F.col("risk_score") / 100.0).alias("prob"))
    return M.binary_metrics(x).crossJoin(M.mcfadden(x))
