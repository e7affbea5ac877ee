"""Operator properties: keys, imputation, rescale, index, cleaning, filters, sinks."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestline.operators import cleaning as CL
from harvestline.operators import quality as DQ
from harvestline.operators.keys import surrogate_key
from harvestline.operators.windows import base_index, impute_group_median, minmax_rescale_fixed

from .conftest import SF_SMALL


def test_surrogate_key_dense_and_partition_independent(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    a = surrogate_key(df, ["g", "k"], "sk", num_partitions=3).select("g", "k", "sk")
    b = surrogate_key(df.repartition(11), ["g", "k"], "sk", num_partitions=7, materialize=True).select("g", "k", "sk")
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb
    assert sorted(r[2] for r in ra) == list(range(1, 5001))
    # order respected: sk follows (g, k)
    assert [r[2] for r in sorted(ra, key=lambda r: (r[0], r[1]))] == list(range(1, 5001))


def test_impute_group_median_keeps_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("b", 4.0), ("b", 6.0), ("c", None)],
                               "k string, v double")
    out = impute_group_median(df, "v", ["k"])
    assert out.count() == df.count()
    got = sorted((r.k, r.v) for r in out.collect())
    assert ("a", 2.0) in got and ("b", 5.0) in got and ("c", None) in got


def test_minmax_rescale(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (15.0,)], "x double")
    vals = sorted(r.s for r in minmax_rescale_fixed(df, "x", "s").collect())
    assert vals == [0.0, 50.0, 100.0]
    const = spark.createDataFrame([(7.0,), (7.0,)], "x double")
    assert {r.s for r in minmax_rescale_fixed(const, "x", "s").collect()} == {25.0}


def test_base_index_fallback(spark):
    df = spark.createDataFrame([(2014, 50.0), (2015, 0.0), (2016, 100.0)], "year int, v double")
    out = {r.year: (r.idx, r.index_base) for r in base_index(df, "v", "year", 2015, "idx").collect()}
    assert out[2016] == (200.0, "mean")
    ok = {r.year: r.idx for r in base_index(df, "v", "year", 2014, "idx").collect()}
    assert ok[2016] == 200.0 and ok[2014] == 100.0


def test_names_and_filters(spark):
    df = spark.createDataFrame([(" A b ", "x", "y")], ["Region Name", "site-ref", "Region Name "])
    assert CL.normalise_columns(df).columns == ["region_name", "site_ref", "region_name_1"]
    assert CL.dedupe_names(["a", "a", "a"]) == ["a", "a_1", "a_2"]
    d2 = spark.createDataFrame([(1,)], ["TRAFFIC_CNT"])
    assert CL.require_columns(d2, ["TRAFFIC_COUNT"]).columns == ["TRAFFIC_COUNT"]
    with pytest.raises(ValueError):
        CL.require_columns(d2, ["SITE_REFERENCE"])
    r = spark.createDataFrame([("04 - Bay of Plenty",), ("bay of plenty",), ("Waikato",), (None,)], ["r"])
    assert CL.region_filter(r, "r", "Bay of Plenty", "04").count() == 2
    assert CL.region_filter_rx(r, "r", "Bay of Plenty|04 -|04-").count() == 2
    s = spark.createDataFrame([("00212345",), ("212345",), ("01N00001",)], ["s"])
    assert [x.p for x in s.select(CL.pad_site("s").alias("p")).collect()] == ["00212345", "00212345", "01N00001"]
    assert CL.prefix_filter(s, "s", "002").count() == 1


def test_clean_survey(spark):
    rows = [(" Bay of Plenty ", "11,250", "S"), ("Total", "-", "12"), ("Note: something", "1", "1"), ("", "1", "1")]
    df = spark.createDataFrame(rows, "region string, y2022 string, y2024 string")
    out = CL.clean_survey(df, "region", ["y2022", "y2024"]).orderBy("region").collect()
    assert [(r.region, r.y2022, r.y2024, r.is_subtotal) for r in out] == [
        ("Bay of Plenty", 11250.0, None, False), ("Total", 0.0, 12.0, True)]


def test_load_to_schema_and_pk_fk(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("flag", T.IntegerType()),
                           T.StructField("missing", T.StringType())])
    df = spark.createDataFrame([(1, True, "x"), (1, False, "y"), (None, True, "z")], "k int, flag boolean, extra string")
    out = DQ.load_to_schema(df, schema)
    assert out.columns == ["k", "flag", "missing"]
    assert [r.flag for r in out.collect()] == [1, 0, 1]
    assert DQ.schema_diff(df, schema) == {"missing": ["missing"], "extra": ["extra"]}
    pk = DQ.check_pk(df, ["k"], "pk").first()
    assert pk.violations == 2  # one duplicate group + one null key
    dim = spark.createDataFrame([(1,)], "k int")
    assert DQ.check_fk(df.filter("k is not null"), dim, ["k"], "fk").first().violations == 0


def test_publish_gate_keeps_last_good(spark, scratch):
    from harvestline.sources.sinks import publish_if_healthy, read_published
    good = spark.createDataFrame([(1,)], "x int")
    bad = spark.createDataFrame([(2,)], "x int")
    pub, log = os.path.join(scratch, "pub"), os.path.join(scratch, "log")
    ok_health = spark.createDataFrame([(100.0,)], "health_score double")
    low_health = spark.createDataFrame([(50.0,)], "health_score double")
    assert publish_if_healthy(good, ok_health, pub, log) is True
    assert publish_if_healthy(bad, low_health, pub, log) is False
    # a violated integrity check refuses a batch whatever its score; the audit reads the written copy
    broken = lambda staged: staged.agg(F.lit(100.0).alias("health_score"), F.sum("x").alias("bad_trays"))
    assert publish_if_healthy(bad, broken, pub, log) is False
    assert [r.x for r in read_published(spark, pub).collect()] == [1]
    assert len(os.listdir(os.path.join(pub, "versions"))) == 1
    assert publish_if_healthy(bad, ok_health, pub, log) is True
    assert [r.x for r in read_published(spark, pub).collect()] == [2]
    assert sorted(r.status for r in spark.read.parquet(log).collect()) == ["ALERT", "ALERT", "OK", "OK"]


def test_fact_invariants(spark):
    from harvestline.registry import star_for
    f = star_for(spark, SF_SMALL).fact
    bad = f.filter((F.col("trays_exported") + F.col("trays_lost") != F.col("trays_submitted"))
                   | (~F.col("mts_pass") & (F.col("total_return_nzd") != 0))
                   | ~F.col("otif_pct").between(52.0, 97.5)
                   | ~F.col("risk_score").between(1, 100)).count()
    assert bad == 0


def test_star_build_keys(spark, scratch):
    from harvestline.sources.sinks import build_star, read_star
    build_star(spark, SF_SMALL, os.path.join(scratch, "star"))
    t = read_star(spark, os.path.join(scratch, "star"))
    f = t["fact_export_transactions"]
    n = f.count()
    agg = f.agg(F.countDistinct("export_id").alias("d"), F.max("export_id").alias("m"),
                F.sum(F.col("fruit_key").isNull().cast("int")).alias("nf"),
                F.sum(F.col("grower_key").isNull().cast("int")).alias("ng")).first()
    assert (agg.d, agg.m, agg.nf, agg.ng) == (n, n, 0, 0)
    # star SQL surface (SRC7): the published Q1 text runs on the stored views
    q = spark.sql("SELECT season, variety, COUNT(*) AS n FROM fact_export_transactions GROUP BY 1, 2")
    assert q.agg(F.sum("n")).first()[0] == n


def test_hashed_surrogate_key_dense_after_shuffle(spark):
    from harvestline.operators.keys import hashed_surrogate_key
    df = spark.range(0, 4000).select((F.col("id") % 97).alias("g"), F.col("id").alias("k")).repartition(7, "g")
    out = hashed_surrogate_key(df, ["g", "k"], "sk", buckets=5)
    ids = sorted(r.sk for r in out.collect())
    assert ids == list(range(1, 4001))
    again = {(r.g, r.k): r.sk for r in hashed_surrogate_key(df.repartition(3), ["g", "k"], "sk", buckets=5).collect()}
    assert again == {(r.g, r.k): r.sk for r in out.collect()}


def test_folds_fitted_together_score_like_a_loop(spark):
    import numpy as np

    from harvestline.operators import models as M
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 3))
    y = (x @ [1.5, -1.0, 0.2] + rng.standard_normal(4000) > 0.3).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double").cache()
    tagged = df.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)))
    weights = M.fit_folds(tagged, ["a", "b", "c"], "label", 5)
    scores = []
    for k in range(5):
        model = M.fit_logit(tagged.where(F.col("fold") != k), ["a", "b", "c"], "label")
        assert np.allclose(weights[k], [*model.coefficients, model.intercept], atol=2e-3)
        scores.append(M.binary_metrics(M.predict(model, tagged.where(F.col("fold") == k), ["a", "b", "c"])).first()["f1"])
    assert abs(M.cv_f1(df, ["a", "b", "c"], "label", ["id"]) - sum(scores) / 5) < 2e-3


def test_folds_reach_large_weights(spark):
    import numpy as np

    from harvestline.operators import models as M
    rng = np.random.default_rng(5)
    x = rng.standard_normal(3000) / 100
    y = (rng.random(3000) < 1 / (1 + np.exp(-500 * x))).astype(float)
    df = spark.createDataFrame([(float(a), float(v), i % 2) for i, (a, v) in enumerate(zip(x, y))], "a double, label double, fold int")
    for k, (w, b) in enumerate(M.fit_folds(df, ["a"], "label", 2, c=1e9)):
        own = np.arange(3000) % 2 != k
        left = y[own] - 1 / (1 + np.exp(-(w * x[own] + b)))
        assert w > 300 and abs(left.sum()) < 1e-4 and abs(left @ x[own]) < 1e-6  # the gradient is 0


def test_counted_rows_give_the_models_of_all_rows(spark):
    import numpy as np

    from harvestline.operators import models as M
    from harvestline.plans import models as ML
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 12, 6000) / 4, rng.integers(0, 2, 6000), np.full(6000, 91.8)])
    y = (x @ [1.5, -1.0, 0.0] + rng.standard_normal(6000) > 1.6).astype(float)
    df = spark.createDataFrame([(i // 2, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double").cache()
    features = ["a", "b", "c"]
    counted = M.count_rows(df, features, "label", ["id"])
    rows = counted.collect()
    assert len(rows) <= 12 * 2 * 2 and sum(r.n for r in rows) == 6000
    assert all(sum(r[f"fold_{k}"] for k in range(5)) == r.n for r in rows)
    z = M.standardise_counted(counted, features)
    assert {r.c for r in z.collect()} == {0.0}
    plain = M.standardise(df.drop("c"), features[:2]).withColumn("c", F.lit(0.0)).cache()
    train, test = M.split(plain, ["id"])
    assert sum(r.train for r in rows) == train.count()
    model = M.fit_logit(train, features, "label")
    pred = M.predict(model, test, features)
    want = M.binary_metrics(pred).crossJoin(M.mcfadden(pred)).first()
    metrics, coefs = ML.run_model(spark, df, features, ["id"])
    got = metrics.first()
    assert all(got[c] == want[c] for c in want.asDict()) and got.n_test == test.count()
    assert np.allclose([r.coefficient for r in sorted(coefs.collect(), key=lambda r: r.feature)], model.coefficients, atol=1e-4)
    assert abs(got.cv_f1 - M.cv_f1(plain, features, "label", ["id"])) < 1e-9
