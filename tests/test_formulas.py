"""Formula vectors and boundaries of the domain formulas."""
import pytest
from pyspark.sql import functions as F

from harvestline.functions import formulas as DF
from harvestline.functions.scalars import season_phase, season_year


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("rain,ok_otif,fail_otif", [
    (28.0, 88.63, 76.63), (32.0, 88.46, 76.46), (22.0, 88.87, 76.87), (18.0, 89.02, 77.02), (15.0, 89.13, 77.13)])
def test_otif_vectors(spark, rain, ok_otif, fail_otif):
    assert one(spark, DF.otif(F.lit(91.8), F.lit(rain), F.lit(15.0), F.lit(True))) == ok_otif
    assert one(spark, DF.otif(F.lit(91.8), F.lit(rain), F.lit(15.0), F.lit(False))) == fail_otif


@pytest.mark.parametrize("dm,risk", [(13.0, 54), (14.5, 51), (15.5, 37), (16.1, 26), (16.5, 23), (17.0, 20), (18.0, 19)])
def test_risk_vectors(spark, dm, risk):
    assert one(spark, DF.risk_score(F.lit(dm), F.lit(20.0), F.lit(91.8), F.lit(22.0), F.lit(15.0))) == risk


@pytest.mark.parametrize("heavy,light,ci", [(800.0, 6400.0, 100.0), (400.0, 3200.0, 50.0), (0.0, 0.0, 0.0)])
def test_congestion_vectors(spark, heavy, light, ci):
    assert one(spark, DF.congestion_index(F.lit(heavy), F.lit(light))) == ci


def test_congestion_fixed_point_matches(spark):
    from harvestline.plans.traffic import with_congestion
    df = spark.createDataFrame([(800000, 6400000), (400000, 3200000), (0, 0), (1000000, 9000000)],
                               "heavy_milli long, light_milli long")
    got = [r["congestion_index"] for r in with_congestion(df).collect()]
    assert got == [100.0, 50.0, 0.0, 100.0]


@pytest.mark.parametrize("week,phase", [(13, "KiwiStart"), (14, "MainPack"), (22, "MainPack"), (23, "Late")])
def test_phase_boundaries(spark, week, phase):
    assert one(spark, season_phase(F.lit(week))) == phase


@pytest.mark.parametrize("d,label", [("2025-03-31", "2024/25"), ("2025-04-01", "2025/26"), ("1999-12-31", "1999/00")])
def test_season_label(spark, d, label):
    assert one(spark, season_year(F.to_date(F.lit(d)))) == label


def test_taste_and_threshold(spark):
    # exactly at the threshold passes; below fails with score 0
    assert one(spark, DF.mts_pass(F.lit(1610), F.lit("SunGold"))) is True
    assert one(spark, DF.mts_pass(F.lit(1609), F.lit("SunGold"))) is False
    assert one(spark, DF.taste_milli(F.lit(1549), F.lit("Green"))) == 0
    assert one(spark, DF.taste_milli(F.lit(2000), F.lit("SunGold"))) == 860
    assert one(spark, DF.taste_milli(F.lit(2000), F.lit("RubyRed"))) == 1000
    # (17.75 − 15.5)/(20 − 15.5) = 0.5 exactly
    assert one(spark, DF.taste_milli(F.lit(1775), F.lit("Green"))) == 500
    assert one(spark, DF.taste_grade(F.lit(0.8), F.lit(True))) == "A+"
    assert one(spark, DF.taste_grade(F.lit(0.9), F.lit(False))) == "F"


def test_money_is_exact(spark):
    v = one(spark, DF.submit_payment(F.lit("Green"), F.lit("42"), F.lit(3)))
    assert str(v) == "7.65"
    v = one(spark, DF.taste_payment(F.lit(500), F.lit(101), F.lit(True)))
    assert str(v) == "47.98"  # 0.5 · 0.95 · 101 = 47.975 → half-up
    assert one(spark, DF.margin_erosion(F.lit(10.0), F.lit(0))) is None


def test_freight_default_distance(spark):
    v = one(spark, DF.freight_cost(F.lit(100), F.lit(30.0), F.lit(91.8)))
    assert float(v) == 37.2  # 100 · .0085 · 30 · 1.459 = 37.2045
