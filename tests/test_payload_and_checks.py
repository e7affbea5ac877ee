"""The one-scan payload, the health gate, audit trails, sketches, saved results and encodings."""

import os

import pytest
from pyspark.sql import functions as F

from harvestline import config as C
from harvestline.operators import aggregates as A
from harvestline.operators import quality as DQ
from harvestline.plans import feed as P
from harvestline.plans import queries as Q
from harvestline.plans import sql, star, stats
from harvestline.plans import traffic as T
from harvestline.registry import star_for
from harvestline.sources import bindings
from harvestline.sources import files as FS
from harvestline.sources import sinks
from harvestline.streaming import epochs as E

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def s(spark):
    return star_for(spark, SF_SMALL)


@pytest.fixture(scope="module")
def stored(spark, s, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("fact"))
    s.fact.write.parquet(f"{out}/fact")
    s.readings.write.parquet(f"{out}/readings")
    return spark.read.parquet(f"{out}/fact"), spark.read.parquet(f"{out}/readings")


def scans(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Scan parquet" in line and column in line for line in plan.split("\n"))


def test_the_payload_scans_the_fact_once(spark, s, stored):
    fact, readings = stored
    for live in (False, True):
        assert scans(P.payloads(fact, readings, feed=bindings.feed_landings(spark, SF_SMALL), live=live), "risk_score") == 1


def test_payload_parts_equal_their_own_queries(s, stored):
    fact, readings = stored
    rows = {r.season: r for r in P.payloads(fact, readings).collect()}
    for r in P.season_aggregate(fact).collect():
        p = rows[r.season]
        assert (p.dm, p.rainfall, p.vol, p.regulatory, p.pack_week) == (r.dm_avg, r.rain_avg, r.vol_avg, r.reg_avg, r.last_pack_week)
        q = p.data_quality
        assert (q.otif_avg, q.risk_avg, q.total_return_nzd_m, q.payments_reversed_nzd_m, q.total_trays, q.submissions) == (
            r.otif_avg, r.risk_avg, r.total_return_nzd_m, r.payments_reversed_nzd_m, r.total_trays, r.submissions)
    for r in P.worst_week(fact).collect():
        w = rows[r.season].worst_week
        assert (w.pack_week, w.subzone, w.avg_risk, w.avg_dm, w.avg_otif, w.mts_fails, w.submissions) == (
            r.pack_week, r.subzone, r.avg_risk, r.avg_dm, r.avg_otif, r.mts_fails, r.submissions)
    for r in P.weekly_risk_arc(fact).collect():
        assert rows[r.season].weekly_risk_arc == r.weekly_risk_arc
    health = DQ.fact_health(fact).first()
    assert {(r.data_quality.nulls, r.data_quality.health_score) for r in rows.values()} == {(health.nulls, health.health_score)}


def test_payload_notes_and_live_season(spark, s, stored):
    fact, readings = stored
    live = P.live_state(fact).first()
    (p,) = P.payloads(fact, readings, notes=spark.createDataFrame([(live.season, "dry")], "season string, note string"), live=True).collect()
    assert (p.season, p.pack_week, p.season_profile.climateNote) == (live.season, live.pack_week, "dry")
    (other,) = {r.season_profile.climateNote for r in P.payloads(fact, readings).collect()}
    assert other == C.CLIMATE_NOTE_DEFAULT


def test_an_empty_fact_has_a_live_state_and_no_health(s, stored):
    fact, readings = stored
    none = fact.limit(0)
    assert tuple(P.live_state(none).first()) == (None, *C.LIVE_DEFAULT)
    assert P.payloads(none, readings).count() == 0
    assert not (DQ.fact_health(none).first().health_score or 0)


def test_nulls_refuse_a_batch(spark, s, stored, scratch):
    """Cells that are null cannot pass a check; half of them null refuses the batch, all of them too."""
    fact = stored[0].drop("mts_pass_int")
    half = F.col("trays_submitted") % 20 == 0
    for k, column in enumerate(("trays_exported", "trays_lost", "mts_pass", "otif_pct", "risk_score", "total_return_nzd")):
        for every in (half, F.lit(True)):
            broken = fact.withColumn(column, F.when(~every, F.col(column)))
            found = DQ.fact_health(broken).first()
            assert found.nulls == broken.where(F.col(column).isNull()).count() > 0
            assert not sinks.publish_if_healthy(broken, DQ.fact_health, f"{scratch}/{k}", f"{scratch}/log")
    E.publish_epoch(fact.withColumn("trays_exported", F.lit(None).cast("long")), 0, f"{scratch}/stream", DQ.fact_health)
    assert E.read_log(spark, f"{scratch}/stream").first().status == "ALERT"
    assert sinks.publish_if_healthy(fact, DQ.fact_health, f"{scratch}/good", f"{scratch}/log")


def test_foreign_keys_of_all_five(spark, s):
    growers, corridor = star.dim_grower(spark, SF_SMALL), star.dim_corridor(spark)
    lost = growers.where("kpin % 3 = 0")
    some = growers.where("kpin % 3 <> 0").withColumn("corridor_key", F.when(F.col("kpin") % 5 == 0, F.lit(99)).otherwise(F.col("corridor_key")))
    found = {r.check_name: r.violations for r in DQ.star_checks(s.fact, s.readings, corridor, s.time, some).collect()}
    assert found["fk_fact_grower"] == s.fact.join(lost, "kpin").count() > 0
    assert found["fk_grower_corridor"] == some.where("kpin % 5 = 0").count() > 0


def test_audit_trail_without_another_scan(spark, scratch):
    tms = T.tms_15min(spark, SF_SMALL)
    for run in ("a", "b"):
        T.audited_traffic(tms, f"{scratch}/audit", run)
    trail = spark.read.schema(DQ.AUDIT).parquet(f"{scratch}/audit")
    assert {r.run_id: r["count"] for r in trail.groupBy("run_id").count().collect()} == {"a": 4, "b": 4}
    steps = {r.step: (r.rows_in, r.rows_out, r.status) for r in trail.where("run_id = 'a'").collect()}
    assert steps["read"] == (tms.count(),) * 2 + ("OK",)
    assert steps["region"][0] == steps["read"][1] and steps["highway"][0] == steps["region"][1]
    assert {r.step for r in DQ.steps_violating(trail.where("run_id = 'a'"), {"region": 0.0, "dated": 0.0, "read": 0.0}).collect()} == {"region"}
    T.audited_traffic(tms.limit(0), f"{scratch}/none", "c")
    assert [r.status for r in spark.read.schema(DQ.AUDIT).parquet(f"{scratch}/none").collect()] == ["WARN"] * 4


def test_distinct_sketches_count_unions_once(spark):
    df = spark.range(40000).select((F.col("id") % 7).alias("season"), (F.col("id") % 20000).alias("grower"))
    parts = A.distinct_sketches(df, ["grower"], ["season"])
    total = A.distinct_of_sketches(parts, ["grower"]).first().grower
    assert abs(total - 20000) <= 20000 * A.HLL_BOUND
    exact = {r.season: r.n for r in df.groupBy("season").agg(F.countDistinct("grower").alias("n")).collect()}
    assert all(abs(r.grower - exact[r.season]) <= exact[r.season] * A.HLL_BOUND for r in A.distinct_of_sketches(parts, ["grower"], ["season"]).collect())


def test_quantile_sketches_keep_the_rank_bound(spark):
    df = spark.range(60000).select((F.col("id") % 30).alias("day"), F.exp(F.randn(5) * 3).alias("v"))
    daily = A.quantile_sketches(df, "v", ["day"])
    ranks = {"low": 0.1, "median": 0.5, "high": 0.95}
    (q,) = A.quantiles_of_sketches(daily, [], ranks).collect()
    assert q.n == 60000
    for name, rank in ranks.items():
        assert abs(df.where(F.col("v") <= q[name]).count() / 60000 - rank) <= 2 * A.KLL_BOUND


def test_saved_results_of_the_six_queries(spark, s, scratch):
    star.star_views(spark, SF_SMALL)
    figures = sql.save_results(spark, scratch)
    assert {r.query for r in figures.select("query").distinct().collect()} == set(sql.QUERIES)
    saved = spark.read.parquet(f"{scratch}/results/q1")
    assert sorted(map(str, saved.collect())) == sorted(map(str, Q.q1_compliance(s.fact).collect()))
    assert sorted(os.listdir(f"{scratch}/texts"))[-6:] == [f"query=q{k}" for k in range(1, 7)]


def test_sql_over_a_stored_star(spark, s, scratch):
    sinks.build_star(spark, SF_SMALL, scratch)
    sinks.read_star(spark, scratch)
    for name, rows in (("q1", Q.q1_compliance(s.fact)), ("q5", Q.q5_risk_bands(s.fact))):
        assert [str(r) for r in sql.run_sql(spark, name).collect()] == [str(r) for r in rows.collect()]


def test_scenarios_multiply_no_row(s):
    plan = Q.rescore(s.fact)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert [r.scenario for r in Q.rescore(s.fact).collect()] == [k[0] for k in Q.SCENARIOS]


def test_statistics_of_large_totals(spark, scratch):
    """A year's cents times 1000 are beyond a long."""
    rows = [(y, p, 9.0e13) for y in ("1995-03-01", "1996-03-01") for p in stats.PRODUCTS for _ in range(200)] + [("1996-04-01", "5-LOW", 9.0e13)] * 500
    orders = spark.createDataFrame(rows, "d string, o_orderpriority string, o_totalprice double")
    orders.select(F.to_date("d").alias("o_orderdate"), "o_orderpriority", "o_totalprice").write.parquet(f"{scratch}/orders.parquet")
    found = {r.year: (r.total_fob_nzd_m, r.total_index) for r in stats.export_statistics(spark, scratch).collect()}
    assert found == {1995: (9.0e10, 100.0), 1996: (13.5e10, 150.0)}


@pytest.mark.parametrize("data,name", [
    ("naïve,�\n�,café\n".encode(), "naïve"), (b"\xef\xbb\xbfab,c\n1,\xc3\xa9\n", "ab"),
    ("naïve,b\n1,café\n".encode("latin-1"), "naïve"), (b"", None)])
def test_encoding_by_valid_bytes(spark, scratch, data, name):
    """A genuine U+FFFD is no sign of another encoding."""
    with open(f"{scratch}/x.csv", "wb") as f:
        f.write(data)
    df = FS.read_csv(spark, f"{scratch}/x.csv")
    assert df.columns[:1] == ([name] if name else [])
    if data.startswith(b"na") and b"\xef\xbf\xbd" in data:
        assert tuple(df.first()) == ("�", "café")
    valid, _ = FS.judge_encodings(spark, f"{scratch}/x.csv")
    assert valid["latin-1"] and valid["utf-8"] == (b"\xefve" not in data)


def test_windows_bytes_that_are_undefined(spark, scratch):
    for data, ok in ((b"a\n\x80\n", True), (b"a\n\x81\n", False), (b"a\n \x18\x12\n", True)):
        with open(f"{scratch}/x.csv", "wb") as f:
            f.write(data)
        assert FS.judge_encodings(spark, f"{scratch}/x.csv")[0]["cp1252"] is ok


def test_saved_model_reports(spark, s, stored, scratch):
    from harvestline.plans import models as ML
    coefs = ML.save_reports(spark, stored[1], stored[0], scratch)
    assert {r.model: r.n for r in coefs.groupBy("model").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "m1_mts_fail": 5, "m2_otif_below_88": 8, "m2_otif_below_88_leak_free": 7}
    rows = coefs.where("model = 'm1_mts_fail'").orderBy("rank").collect()
    assert [abs(r.coefficient) for r in rows] == sorted((abs(r.coefficient) for r in rows), reverse=True)
    assert all((r.coefficient >= 0) == (r.direction == "+") for r in rows)
    confusion = spark.read.parquet(f"{scratch}/confusion")
    metrics = {r.model: r for r in spark.read.parquet(f"{scratch}/metrics").collect()}
    assert all(r.rows == metrics[r.model].n_test for r in confusion.groupBy("model").agg(F.sum("rows").alias("rows")).collect())
