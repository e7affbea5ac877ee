"""Nothing is dropped or changed by the shape, size or order of the input."""

import random

from pyspark.sql import functions as F

from harvestline.functions.scalars import int_div
from harvestline.operators.cleaning import dedupe_names
from harvestline.plans import queries as Q
from harvestline.plans import star
from harvestline.registry import star_for
from harvestline.sources import files as FS
from harvestline.sources import tables
from harvestline.streaming import streams as STR

from .conftest import SF_SMALL


def test_integer_division_is_exact(spark):
    rnd = random.Random(1)
    pairs = [(270006134240464464, 2078953264964)] + [(rnd.randrange(10**17, 10**18), rnd.randrange(1, 10**rnd.randint(1, 17))) for _ in range(500)]
    pairs += [(b * rnd.randrange(1, 10**6), b) for _, b in pairs if b < 10**12]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert all(r.q == r.a // r.b for r in df.withColumn("q", int_div("a", "b")).collect())
    assert spark.createDataFrame([(1, 0)], "a long, b long").select(int_div("a", "b").alias("q")).first().q is None


def test_repaired_names_are_distinct():
    assert dedupe_names(["a", "a", "a"]) == ["a", "a_1", "a_2"]
    assert dedupe_names(["a", "a_1", "a"]) == ["a", "a_1", "a_2"]
    assert len(set(dedupe_names(["a", "a", "a_1", "a_1", "a"]))) == 5


def test_encoding_is_chosen_from_the_whole_file(spark, scratch):
    path = f"{scratch}/late.csv"
    with open(path, "wb") as f:
        f.write(b"name,n\n" + b"plain,1\n" * 2000 + "café,2\n".encode("latin-1"))
    assert FS.read_csv(spark, path).where("n = '2'").first().name == "café"


def test_each_file_keeps_its_own_header(spark, scratch):
    for name, text in (("a.csv", "x,y\n1,2\n"), ("b.csv", "y,x\n20,10\n")):
        with open(f"{scratch}/{name}", "w") as f:
            f.write(text)
    got = {(r.x, r.y) for r in FS.read_csv_glob(spark, f"{scratch}/*.csv").collect()}
    assert got == {("1", "2"), ("10", "20")}


def test_files_of_several_layouts_are_one_scan(spark, scratch):
    texts = {"a.csv": 'x,y\n1,2\n"a,b",3\n', "b.csv": "y,z,x\n20,9,10\n", "c.csv": "x,y\n7\n", "d.csv": "x,x,y\n4,5,6\n", "e.csv": ""}
    for name, text in texts.items():
        with open(f"{scratch}/{name}", "w") as f:
            f.write(text)
    df = FS.read_csv_glob(spark, f"{scratch}/*.csv")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    got = {(r._file, r.x, r.y, r.z, r.x_1) for r in df.collect()}
    assert got == {("a.csv", "1", "2", None, None), ("a.csv", "a,b", "3", None, None), ("b.csv", "10", "20", "9", None), ("c.csv", "7", None, None, None),
                   ("d.csv", "4", "6", None, "5")}


def test_the_latest_landing_counts(spark):
    feed = spark.createDataFrame([([1.0], (0.5, 80.0), "2026-01-01", 1), ([2.0], (0.6, 81.0), "2026-02-01", 1)], FS.FEED_SCHEMA)
    agg = spark.createDataFrame([(18.0,)], "rain_avg double")
    for f in (feed, feed.orderBy(F.desc("date"))):
        r = FS.enrich_feed(agg, f).first()
        assert (r.rain_avg, r.fx_date) == (2.0, "2026-02-01")


def test_no_date_falls_off_the_calendar(spark):
    s = star_for(spark, SF_SMALL)
    short = star.dim_time(spark, s.subs, "1995-01-01", "1995-12-31")
    assert Q.q2_otif_by_week(s.fact, short).agg(F.sum("submissions")).first()[0] == s.fact.count()


def test_missing_tables_are_left_out_and_found_by_any_path(spark):
    got = tables.load_sources(spark, f"file:{SF_SMALL}", ["region", "no_such_table"])
    assert set(got) == {"region"} and got["region"].count() == 5


def test_streams_read_a_table_of_part_files(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(3).write.parquet(f"{scratch}/events.parquet")
    whole, parts = (sorted(map(str, STR.rain_7d_stream_batch(spark, d).collect())) for d in (SF_SMALL, scratch))
    assert whole and whole == parts


def test_a_restarted_stream_goes_on(spark, scratch):
    for run, name in ((STR.dedupe_stream_batch, "dedupe"), (STR.live_state_batch, "live"), (STR.rain_7d_stream_batch, "rain")):
        first, again = (sorted(map(str, run(spark, SF_SMALL, f"{scratch}/{name}").collect())) for _ in range(2))
        assert first and first == again


def test_rewritten_tables_are_read_anew(spark, scratch):
    import os
    for name in os.listdir(SF_SMALL):
        if name != "lineitem.parquet":
            os.symlink(f"{SF_SMALL}/{name}", f"{scratch}/{name}")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    li.write.parquet(f"{scratch}/lineitem.parquet")
    assert star_for(spark, scratch) is star_for(spark, scratch)
    assert star_for(spark, scratch).fact.count() == li.count()
    li.where("l_orderkey % 2 = 0").write.mode("overwrite").parquet(f"{scratch}/lineitem.parquet")
    assert star_for(spark, scratch).fact.count() == li.where("l_orderkey % 2 = 0").count()
