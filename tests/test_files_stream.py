"""File sources on small fixtures, stream = batch."""
import os

from pyspark.sql import functions as F

from harvestline.sources import files as FS

from .conftest import SF_SMALL


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)
    return path


def test_read_csv_encodings_and_duplicate_headers(spark, scratch):
    p = write(os.path.join(scratch, "a.csv"), "Region,Region,Ōpōtiki\nx,y,z\n", "utf-8")
    df = FS.read_csv(spark, p)
    assert df.columns == ["Region", "Region_1", "Ōpōtiki"]
    q = os.path.join(scratch, "b.csv")
    with open(q, "wb") as fh:
        fh.write("name,v\nÓpōtiki,1\n".encode("utf-8"))
    assert FS.read_csv(spark, q).first()["name"] == "Ópōtiki"


def test_stat_table_drops_metadata_and_footer(spark, scratch):
    text = 'Title\n"Units"\n,\n,\n2014,1,2\n2015,"..",4\nFootnote 1\n"Source: x"\n'
    df = FS.read_stat_table(spark, write(os.path.join(scratch, "s.csv"), text), ["year", "q", "fob"])
    assert [r.year for r in df.collect()] == ["2014", "2015"]


def test_first_parsable_and_stub(spark, scratch):
    p = write(os.path.join(scratch, "t.tsv"), "a;b\n1;2\n3;4\n")
    df = FS.read_first_parsable(spark, p, [("utf-8", ","), ("utf-8", ";")])
    assert df.columns == ["a", "b"] and df.count() == 2
    empty = write(os.path.join(scratch, "e.csv"), "only\n")
    stub = spark.createDataFrame([("Bay of Plenty", 1)], "region string, ha int")
    assert FS.read_first_parsable(spark, empty, [("utf-8", ",")], stub).collect() == stub.collect()


def test_weather_two_sections(spark, scratch):
    text = ("latitude,longitude,elevation\n-37.8,176.3,2.0\n\ntime,precipitation_sum (mm),temperature_2m_max (°C)\n"
            "2026-04-22,0.20,14.7\n2026-04-23,0.00,14.8\n")
    df = FS.read_weather(spark, write(os.path.join(scratch, "w.csv"), text))
    assert [(str(r.date), r.precipitation_sum_mm) for r in df.collect()] == [("2026-04-22", 0.2), ("2026-04-23", 0.0)]


def test_enrich_feed_parts_optional(spark, scratch):
    agg = spark.createDataFrame([("2025/26", 18.0)], "season string, rain_avg double")
    p = write(os.path.join(scratch, "feed.json"),
              '{"precipitation_sum": [1.0, null, 2.5], "rates": {"EUR": 0.53211}, "date": "2026-01-01"}\n')
    out = FS.enrich_feed(agg, FS.read_feed(spark, p)).first()
    assert (out.rain_avg, out.rain_source, out.nzd_eur, out.nzd_jpy, out.corridors_verified) == (3.5, "feed", 0.5321, None, None)
    none = FS.enrich_feed(agg, spark.createDataFrame([], FS.FEED_SCHEMA)).first()
    assert (none.rain_avg, none.rain_source) == (18.0, "etl")


def test_payload_structure(spark):
    from harvestline.registry import star_for
    from harvestline.plans import feed
    s = star_for(spark, SF_SMALL)
    p = feed.payloads(s.fact, s.readings)
    rows = p.collect()
    seasons = {r.season for r in feed.season_aggregate(s.fact).collect()}
    assert {r.season for r in rows} == seasons
    r0 = rows[0]
    assert r0.data_quality.health_score >= 0 and isinstance(r0.subzones, dict) and len(r0.weekly_risk_arc) > 0
    comb = feed.combined_payload(p).first().seasons
    assert set(comb) == seasons


def test_glob_scan_and_payload_files(spark, scratch):
    d = os.path.join(scratch, "tms")
    os.makedirs(d)
    write(os.path.join(d, "tms_03.csv"), "REGION_NAME,SITE_REFERENCE\n01 - Northland,00100001\n")
    write(os.path.join(d, "tms_04.csv"), "REGION_NAME,SITE_REFERENCE\n04 - Bay of Plenty,00200002\n04 - Bay of Plenty,00100003\n")
    df = FS.read_csv_glob(spark, os.path.join(d, "*.csv"), F.col("REGION_NAME").contains("04"))
    assert sorted((r.SITE_REFERENCE, r._file) for r in df.collect()) == [("00100003", "tms_04.csv"), ("00200002", "tms_04.csv")]

    from harvestline.sources.sinks import write_payloads
    p = spark.createDataFrame([("2024/25", '{"a": 1}'), ("2025/26", '{"a": 2}')], "season string, payload string")
    out = write_payloads(p, os.path.join(scratch, "payloads"))
    assert sorted(x for x in os.listdir(out) if x.startswith("season_file=")) == [
        "season_file=2024-25", "season_file=2025-26"]
