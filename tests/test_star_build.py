"""The stored star: one read and one shuffle of the submissions, dense keys, no row lost."""

import os
import re

import pytest
from pyspark.sql import functions as F

from harvestline.operators.keys import prefix_sums
from harvestline.plans import queries as Q
from harvestline.plans import star
from harvestline.sources import bindings, sinks

from .conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("star"))
    sinks.build_star(spark, SF_SMALL, out)
    return sinks.read_star(spark, out)


def test_one_scan_and_two_shuffles_of_the_submissions(spark, scratch):
    """Without broadcasts: the join to part and the buckets move the lineitems; nothing does after that."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = plan_of(bindings.submissions(spark, SF_SMALL, numbered=True))
        assert raw.count("l_shipdate") and len(re.findall(r"Scan parquet \[l_orderkey", raw)) == 1
        moved = [line for line in raw.split("\n") if "Exchange" in line]
        assert len(moved) == 2 and sum("l_partkey" in line for line in moved) == 1  # the other one is of part
        staged = sinks.stage_submissions(spark, SF_SMALL, "stage_test", f"{scratch}/stage")
        growers = star.dim_grower(spark, SF_SMALL).withColumn("grower_key", F.lit(1).cast("long"))
        cells = plan_of(staged.groupBy(*sinks.CELL).agg(F.sum("dm_centi")))
        assert "Exchange" not in cells and "Bucketed: true" in cells
        _, starts = sinks.star_keys(staged, growers)
        fact = plan_of(sinks.star_fact(spark, SF_SMALL, staged, starts, star.dim_time(spark, staged)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS stage_test")
    assert "lineitem" not in fact.split("Scan parquet")[0]
    # the branch of the fact rows: from the window down to the bucketed scan without an exchange
    branch = fact[fact.index("Window [row_number()"):fact.index("Bucketed: true")]
    assert "Exchange" not in branch


def test_keys_are_dense_and_refer(spark, built):
    fact, fruit, growers = built["fact_export_transactions"], built["dim_fruit_quality"], built["dim_grower"]
    for table, key in ((fact, "export_id"), (fruit, "fruit_key"), (growers, "grower_key")):
        n, least, most, distinct = table.agg(F.count(F.lit(1)), F.min(key), F.max(key), F.countDistinct(key)).first()
        assert (least, most, distinct) == (1, n, n)
    subs = bindings.submissions(spark, SF_SMALL)
    assert fact.count() == subs.count() and fruit.count() == star.readings(subs).count()
    assert fact.join(fruit, "fruit_key", "left_anti").isEmpty() and fact.join(growers, "grower_key", "left_anti").isEmpty()
    same = fact.join(fruit.select("fruit_key", F.col("kpin").alias("k"), F.col("season").alias("s"), F.col("pack_week").alias("w")), "fruit_key")
    assert same.where("kpin <> k or season <> s or pack_week <> w").isEmpty()


def test_stored_rows_are_those_of_the_views(spark, built):
    cols = ["kpin", "submission_date", "season", "subzone", "variety", "trays_submitted", "total_return_nzd", "otif_pct", "risk_score", "season_phase", "corridor_key"]
    views = star.fact(spark, SF_SMALL)
    assert sorted(map(str, built["fact_export_transactions"].select(*cols).collect())) == sorted(map(str, views.select(*cols).collect()))


def moved_dates(spark, folder, **when):
    """The tables with other ship dates for the lineitems of some orders."""
    for name in os.listdir(SF_SMALL):
        if name != "lineitem.parquet":
            os.symlink(f"{SF_SMALL}/{name}", f"{folder}/{name}")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    date = F.col("l_shipdate")
    for condition, to in when.values():
        date = F.when(F.expr(condition), F.lit(to).cast(li.schema["l_shipdate"].dataType)).otherwise(date)
    li.withColumn("l_shipdate", date).write.parquet(f"{folder}/lineitem.parquet")
    return li.count()


def test_the_stored_calendar_reaches_as_far_as_the_data(spark, scratch):
    """Dates after the spine's end get a day; a stray one far out makes no calendar of millions; null dates stay."""
    n = moved_dates(spark, scratch, late=("l_orderkey % 7 = 0", "2031-05-02"), stray=("l_orderkey % 11 = 0", "9999-12-31"), none=("l_orderkey % 13 = 0", None))
    sinks.build_star(spark, scratch, f"{scratch}/star")
    t = sinks.read_star(spark, f"{scratch}/star")
    fact, calendar = t["fact_export_transactions"], t["dim_time"]
    assert fact.count() == n and calendar.count() < 60_000
    assert fact.where("submission_date = '2031-05-02' and season_phase is null").isEmpty()
    assert fact.where("submission_date is null").where("export_id is null or grower_key is null or subzone is null").isEmpty()
    counted = Q.q2_otif_by_week(fact, calendar).agg(F.sum("submissions")).first()[0]
    assert counted == fact.where("submission_date <= '2099-12-31'").count() > 0
    from harvestline.operators.quality import star_checks
    found = {r.check_name: r.violations for r in star_checks(fact, t["dim_fruit_quality"], t["dim_corridor"], calendar).collect()}
    assert found["fk_fact_time"] == fact.where("submission_date = '9999-12-31'").count() > 0


def test_a_hot_reading_is_many_cells(spark, scratch):
    """A third of all submissions are of one reading."""
    for name in os.listdir(SF_SMALL):
        if name != "lineitem.parquet":
            os.symlink(f"{SF_SMALL}/{name}", f"{scratch}/{name}")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot, row = F.col("l_orderkey") % 3 == 0, li.orderBy("l_orderkey", "l_linenumber").first()
    li.withColumns({c: F.when(hot, F.lit(row[c])).otherwise(F.col(c)) for c in ("l_partkey", "l_suppkey", "l_shipdate")}).write.parquet(f"{scratch}/lineitem.parquet")
    staged = sinks.stage_submissions(spark, scratch, "stage_hot", f"{scratch}/stage")
    sizes = sorted((r["count"] for r in staged.groupBy(*sinks.CELL).count().collect()), reverse=True)
    spark.sql("DROP TABLE stage_hot")
    assert sum(sizes[:16]) > staged.count() / 4 and sizes[0] < sum(sizes) / 30
    sinks.build_star(spark, scratch, f"{scratch}/star")
    ids = spark.read.parquet(f"{scratch}/star/fact_export_transactions").agg(F.min("export_id"), F.max("export_id"), F.countDistinct("export_id")).first()
    assert tuple(ids) == (1, li.count(), li.count())


def test_prefix_sums(spark):
    rows = [(i * 7 % 50, i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, w int")
    found = prefix_sums(df, ["k", "w"], {"before": "w", "twice": "k"}, 5).orderBy("before", "k", "w").collect()
    total_w = total_k = 0
    for r in sorted(found, key=lambda r: (r.k, r.w, r.before, r.twice)):
        assert (r.before, r.twice) == (total_w, total_k)
        total_w, total_k = total_w + r.w, total_k + r.k


def test_readings_and_starts_move_once_and_stay(spark, scratch):
    """What is staged is what the rest follows from, and nothing is shuffled after the ranges are numbered."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = sinks.stage_submissions(spark, SF_SMALL, "stage_narrow", f"{scratch}/stage")
        assert len(spark.read.parquet(f"{scratch}/stage").columns) == 11 < len(staged.columns)
        raw = bindings.submissions(spark, SF_SMALL, numbered=True)
        assert sorted(map(str, staged.select(raw.columns).collect())) == sorted(map(str, raw.collect()))
        growers = star.dim_grower(spark, SF_SMALL).withColumn("grower_key", F.lit(1).cast("long"))
        for keys in sinks.star_keys(staged, growers):
            moved = [line for line in plan_of(keys).split("\n") if "Exchange hashpartitioning(" in line or "Exchange rangepartitioning(" in line]
            assert all("_pid" in line and "_all_" not in line and "kpin" not in line for line in moved), moved  # totals of partitions
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS stage_narrow")
