"""Streams in append mode: closed and open windows, late rows, changing feeds, the publish log."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from harvestline.operators import windows as W
from harvestline.operators.joins import as_of
from harvestline.plans import traffic as T
from harvestline.sources import files as FS
from harvestline.sources import tables
from harvestline.streaming import epochs as E
from harvestline.streaming import streams as STR

from .conftest import SF_MED, SF_SMALL

START = dt.datetime(2024, 3, 1)


def put_file(spark, folder, rows, k):
    """One file of events (minutes since START, value), as a source would drop it."""
    data = [(START + dt.timedelta(minutes=m), v) for m, v in rows]
    part = f"{folder}/_part{k}"
    spark.createDataFrame(data, "ts timestamp, value double").coalesce(1).write.parquet(part)
    (name,) = [n for n in os.listdir(part) if n.endswith(".parquet")]
    os.makedirs(f"{folder}/rain.parquet", exist_ok=True)
    os.replace(f"{part}/{name}", f"{folder}/rain.parquet/{k:03d}.parquet")


def rain_rows(minutes):
    return [(m, (m * 7 % 100) / 10) for m in minutes]


def windows_of(rows):
    """7-day windows that start at midnight: {start day: (sum in hundredths, rows)}."""
    out = {}
    for m, v in rows:
        day = (START + dt.timedelta(minutes=m)).date()
        for back in range(7):
            c, n = out.get(day - dt.timedelta(days=back), (0, 0))
            out[day - dt.timedelta(days=back)] = (c + round(v * 100), n + 1)
    return out


def rain_run(spark, folder, base):
    stream = STR.read_stream(spark, folder, "rain")
    STR.run_gate(stream, "1 day", STR.day_end("ts"), STR.day_end("ts") + F.expr("interval 6 days"), base)
    windows = STR.rain_windows(E.stream_in_time(spark, base, STR.RAIN))
    return windows, STR.run_windows(windows, base)


def result(windows, base):
    return {r.start: (r.c, r.readings) for r in STR.read_windows(windows, base).select(
        F.to_date("window.start").alias("start"), "c", "readings").collect()}


def test_out_of_order_files_give_the_batch_rows_and_a_bounded_state(spark, scratch):
    """40 days in eight files, rows up to 20 hours out of order, a run for every file."""
    rnd = random.Random(1)
    order = sorted(range(0, 40 * 1440, 30), key=lambda m: m + rnd.randrange(20 * 60))
    folder, base, size = f"{scratch}/in", f"{scratch}/out", len(order) // 8
    state = []
    for k in range(8):
        put_file(spark, folder, rain_rows(order[k * size:(k + 1) * size if k < 7 else None]), k)
        windows, query = rain_run(spark, folder, base)
        state += [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators][-1:]
    assert result(windows, base) == windows_of(rain_rows(order))
    assert max(state) <= 7 + 1 + 5 + 7 and len(windows_of(rain_rows(order))) == 46  # days of a file, of the delay and of a window
    marks = E.read_marks(spark, base).agg(F.sum("rows"), F.sum("late"), F.sum("partly_late")).first()
    assert tuple(marks) == (len(order), 0, 0)
    closed = STR.read_windows(windows, base).where("closed").count()
    assert 30 < closed < 46 and E.read_late(spark, base, STR.RAIN).count() == 0


def test_late_rows_are_kept_apart_and_counted(spark, scratch):
    folder, base = f"{scratch}/in", f"{scratch}/out"
    first, second = list(range(0, 20 * 1440, 60)), [5, 10 * 1440 + 5, 17 * 1440 + 5, 20 * 1440 + 5]
    for k, rows in enumerate((first, second)):
        put_file(spark, folder, rain_rows(rows), k)
        windows, query = rain_run(spark, folder, base)
    # the watermark stands at 18 days and 23 hours: a row of day 0 has no open window left, one of day 10 none of its
    # windows but the last ones, one of day 17 lacks those that closed
    late = {(r.arrival, (r.ts - START).days) for r in E.read_late(spark, base, STR.RAIN).collect()}
    assert late == {("late", 0), ("late", 10), ("partly", 17)}
    assert tuple(E.read_marks(spark, base).where("epoch = 1").select("rows", "late", "partly_late").first()) == (4, 2, 1)
    expect, edge = windows_of(rain_rows(first)), (START + dt.timedelta(days=18)).date()
    for start, (c, n) in windows_of(rain_rows(second[2:])).items():
        if start + dt.timedelta(days=7) > edge:
            expect[start] = tuple(map(sum, zip(expect.get(start, (0, 0)), (c, n))))
    assert result(windows, base) == expect


def test_a_repeated_epoch_changes_nothing(spark, scratch):
    batch = spark.createDataFrame([(START, 1.0), (None, 2.0)], STR.RAIN)
    gate = E.sort_out_late("ts", "1 day", STR.day_end("ts"), STR.day_end("ts"), scratch)
    for _ in range(2):
        gate(batch, 0)
    assert E.read_marks(spark, scratch).count() == 1
    assert E._with_arrival(spark, scratch, STR.RAIN).count() == 1


def test_daily_traffic_in_parts_equals_the_batch_form(spark, scratch):
    """Null counts filled with the history's medians, events in five files by time, a stop and a restart."""
    events = spark.read.parquet(f"{SF_MED}/events.parquet")
    medians = tables.put_table(STR.traffic_medians(STR.traffic_stream(events)), f"{scratch}/medians")
    events.repartitionByRange(5, "ts").sortWithinPartitions("ts").write.parquet(f"{scratch}/events.parquet")
    stream = STR.traffic_stream(STR.read_stream(spark, scratch, "events", 1))
    base = f"{scratch}/out"
    STR.run_gate(stream, "1 day", STR.day_end("ts"), STR.day_end("ts"), base)
    windows = STR.traffic_windows(E.stream_in_time(spark, base, STR.TRAFFIC), "1 day", medians)
    for _ in range(2):
        STR.run_windows(windows, base)
    late = E.read_late(spark, base, STR.TRAFFIC).count()
    cols = ["date", "site_reference", "heavy_count", "light_count", "congestion_index"]
    found = {tuple(r) for r in STR.traffic_result(STR.read_windows(windows, base)).select(*cols).collect()}
    batch = {tuple(r) for r in T.traffic_daily(T.tms_15min(spark, SF_MED)).select(*cols).collect()}
    assert late == E.read_marks(spark, base).agg(F.sum("late")).first()[0]
    assert batch and (found == batch if late == 0 else found)


def landing(date, eur, rain=(1.0, None, 2.0)):
    return json.dumps({"precipitation_sum": rain, "rates": {"EUR": eur, "JPY": 80.0}, "date": date, "ways": 1}) + "\n"


def test_stream_rows_take_the_landing_of_their_date(spark, scratch):
    """Two landings, rows on each side; a third one that arrives later counts for later rows only."""
    feed, folder = f"{scratch}/feed", f"{scratch}/in"
    os.makedirs(feed)
    with open(f"{feed}/a.json", "w") as f:
        f.write(landing("2024-03-02", 0.5) + landing("2024-03-04", 0.6) + landing("2024-03-04", 0.55) + landing("soon", 0.9))
    put_file(spark, folder, [(0, 1.0), (1 * 1440, 1.0), (2 * 1440, 1.0), (5 * 1440, 1.0)], 0)
    stream = STR.read_stream(spark, folder, "rain").withColumn("day", F.to_date("ts"))
    STR.enrich_stream(stream, feed, "day", f"{scratch}/out")
    with open(f"{feed}/b.json", "w") as f:
        f.write(landing("2024-03-05", 0.7))
    put_file(spark, folder, [(5 * 1440, 2.0), (2 * 1440, 2.0)], 1)
    STR.enrich_stream(stream, feed, "day", f"{scratch}/out")
    rows = E.read_epochs(spark, f"{scratch}/out", "day date, value double, nzd_eur double, fx_date string").collect()
    assert {(r.epoch, r.day.day, r.nzd_eur) for r in rows} == {(0, 1, None), (0, 2, 0.5), (0, 3, 0.5), (0, 6, 0.6), (1, 6, 0.7), (1, 3, 0.5)}


def test_as_of_by_key(spark):
    rows = spark.createDataFrame([("a", "2024-01-05", 1), ("a", "2024-01-05", 2), ("b", "2024-01-05", 3), (None, "2024-01-09", 4), ("a", None, 5)], "k string, d string, n int")
    versions = spark.createDataFrame([("a", "2024-01-01", 10), ("a", "2024-01-05", 20), ("a", "2024-01-06", 30), ("b", "2024-01-06", 40), ("a", None, 50)], "k string, since string, v int")
    found = {(r.n, r.v) for r in as_of(rows, versions, "d", "since", ["k"]).collect()}
    assert found == {(1, 20), (2, 20), (3, None), (4, None), (5, None)}


def test_season_takes_the_landing_of_its_date(spark):
    feed = spark.createDataFrame([([1.0], (0.5, 80.0), "2026-01-01", 1), (None, (0.6, 81.0), "2026-02-01", None)], FS.FEED_SCHEMA)
    agg = spark.createDataFrame([("x", "2026-01-15", 18.0), ("y", "2026-02-15", 19.0), ("z", "2025-12-31", 20.0)], "season string, d string, rain_avg double")
    found = {r.season: (r.rain_avg, r.rain_source, r.nzd_eur, r.corridors_verified) for r in FS.enrich_feed(agg, feed, "d").collect()}
    assert found == {"x": (1.0, "feed", 0.5, True), "y": (19.0, "etl", 0.6, None), "z": (20.0, "etl", None, None)}


def audit(score, **checks):
    return lambda df: df.agg(F.lit(score).alias("health_score"), *[F.lit(v).alias(k) for k, v in checks.items()])


def test_publish_log_over_epochs(spark, scratch):
    batch = spark.createDataFrame([(1,), (2,)], "n int")
    for epoch, (score, checks) in enumerate(((90.0, {}), (70.0, {}), (95.0, {"bad_trays": 1}), (None, {}), (80.0, {"bad_trays": 0}))):
        for _ in range(2):  # replayed
            E.publish_epoch(batch, epoch, scratch, audit(score, **checks))
    log = {r.epoch: (r.status, r.rows, r.violated) for r in E.read_log(spark, scratch).collect()}
    assert log == {0: ("OK", 2, ""), 1: ("ALERT", 2, ""), 2: ("ALERT", 2, "bad_trays"), 3: ("ALERT", 2, ""), 4: ("OK", 2, "")}
    assert sorted((r.epoch, r.n) for r in E.read_committed(spark, scratch, "n int").collect()) == [(0, 1), (0, 2), (4, 1), (4, 2)]


@pytest.mark.parametrize("step", ["commit", "put_epoch"])
def test_killed_between_write_and_commit(spark, scratch, monkeypatch, step):
    """The stream dies after the data is written, or after it is published but not logged; it then starts over."""
    real, died = getattr(E, step), []

    def die(*args, **kwargs):
        if not died:
            died.append(1)
            raise RuntimeError("killed")
        return real(*args, **kwargs)

    monkeypatch.setattr(E, step, die)
    with pytest.raises(Exception):
        STR.publish_stream(spark, SF_SMALL, scratch)
    assert E.read_log(spark, scratch).count() == 0 and E.read_committed(spark, scratch, "season string").count() == 0
    STR.publish_stream(spark, SF_SMALL, scratch)
    (line,) = E.read_log(spark, scratch).collect()
    assert line.status == "OK" and E.read_committed(spark, scratch, "season string").count() == line.rows > 0
    assert len([n for n in os.listdir(f"{scratch}/data") if n.startswith("epoch=")]) == 1


def test_median_of_a_hot_group_is_many_tasks(spark, monkeypatch):
    """One site holds half of all rows; its values lie in several partitions."""
    rnd = random.Random(3)
    rows = [("hot" if i % 2 else f"s{i % 40}", rnd.choice([None, rnd.random() * 1e6, float(i % 50)])) for i in range(20000)]
    rows += [("none", None), ("one", 3.0), ("two", 1.0), ("two", 2.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "site string, v double")
    from harvestline.operators import keys as K
    stored = []
    monkeypatch.setattr(K, "scratch_table", lambda d, name: stored.append(tables.scratch_table(d, name)) or stored[-1])
    found = {r.site: r["median"] for r in W.group_medians(df, "v", ["site"]).collect()}
    import statistics
    values = {}
    for site, v in rows:
        if v is not None and site is not None:
            values.setdefault(site, []).append(v)
    assert {k: v for k, v in found.items() if k is not None} == {k: statistics.median(v) for k, v in values.items()}
    assert stored[0].where("site = 'hot'").select("_pid").distinct().count() >= 4
    filled = W.impute_group_median(df, "v", ["site"]).where("site = 'hot'")
    assert filled.count() == 10000 and filled.where("v is null").count() == 0


def test_traffic_reads_the_events_once(spark):
    from harvestline.sources.tables import read_table  # noqa: F401
    plan = T.traffic_daily(T.tms_15min(spark, SF_MED))._jdf.queryExecution().optimizedPlan().toString()
    assert "event_id" not in plan and "user_id" not in plan  # all that follows starts from the stored cells
