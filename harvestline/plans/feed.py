"""Season payload feed (P1–P5, AGG16–17, AGG26, SRT3–4, DF24–DF29, SNK5–6).

The published feed loops over seasons and runs four SQL statements per
season.  Here one aggregate of the fact by season, week and subzone carries
exact sums for every part, and is folded to weeks and seasons — one scan of
the fact regardless of the number of seasons and parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import formulas as DF
from ..functions.scalars import half_up_div
from ..operators.aggregates import avg_fixed, avg_round, count_if, fixed_int, money_scaled, money_sum, pct
from ..operators.ordering import latest, top_per_group
from ..operators.quality import HARD_CHECKS, health_counts, health_score

NZ_OFFSET = "+12:00"


def season_aggregate(f: DataFrame) -> DataFrame:
    """P1/AGG16: the simulator inputs and totals for every season."""
    return f.groupBy("season").agg(
        avg_fixed("dm_pct_avg", 2, 2).alias("dm_avg"),
        avg_round("congestion_index", 1).alias("cong_avg"),
        avg_fixed("rainfall_mm_7d", 1, 1).alias("rain_avg"),
        avg_fixed("vol_index", 0, 1).alias("vol_avg"),
        avg_round("reg_index", 1).alias("reg_avg"),
        avg_fixed("otif_pct", 2, 2).alias("otif_avg"),
        avg_fixed("risk_score", 0, 1).alias("risk_avg"),
        pct(count_if(F.col("mts_pass")), F.count(F.lit(1)), 3).alias("mts_pass_pct"),
        money_scaled(money_sum("total_return_nzd"), 1_000_000, 3).alias("total_return_nzd_m"),
        money_scaled(money_sum("submit_payment_nzd", ~F.col("mts_pass")), 1_000_000, 3).alias("payments_reversed_nzd_m"),
        F.sum("trays_submitted").cast("long").alias("total_trays"),
        F.count(F.lit(1)).alias("submissions"),
        F.min("pack_week").alias("first_pack_week"),
        F.max("pack_week").alias("last_pack_week"))


def subzone_breakdown(readings: DataFrame) -> DataFrame:
    """P2/AGG17: dry-matter mean, population std, fail % and pass rate by
    season × subzone (the published self-join becomes ``stddev_pop``)."""
    g = readings.groupBy("season", "subzone").agg(
        avg_fixed("dm_pct", 2, 3).alias("dm_mean"),
        F.round(F.stddev_pop("dm_pct"), 3).alias("dm_std"),
        count_if(~F.col("mts_pass")).alias("_fails"),
        F.count(F.lit(1)).alias("readings"))
    g = g.withColumn("mts_fail_pct", pct("_fails", "readings", 1))
    # DF26 on the rounded fail %: (100 − pct)/100 has at most 3 decimals
    g = g.withColumn("mts_pass_rate", (F.lit(1000) - F.round(F.col("mts_fail_pct") * 10).cast("long")) / 1000.0)
    return g.drop("_fails")


def worst_week(f: DataFrame) -> DataFrame:
    """P3/SRT3: highest-risk pack week × subzone of every season.  The
    ranking window runs over the aggregated (season, week, subzone) rows."""
    g = f.groupBy("season", "pack_week", "subzone").agg(
        avg_fixed("risk_score", 0, 1).alias("avg_risk"),
        avg_fixed("dm_pct_avg", 2, 3).alias("avg_dm"),
        avg_fixed("otif_pct", 2, 2).alias("avg_otif"),
        count_if(~F.col("mts_pass")).alias("mts_fails"),
        F.count(F.lit(1)).alias("submissions"))
    return top_per_group(g, ["season"], [F.desc("avg_risk"), "pack_week", "subzone"], 1)


def weekly_risk_arc(f: DataFrame) -> DataFrame:
    """P4/AGG26: average risk per pack week as an array ordered by week."""
    g = f.groupBy("season", "pack_week").agg(avg_fixed("risk_score", 0, 1).alias("r"))
    arc = F.transform(F.array_sort(F.collect_list(F.struct("pack_week", "r"))), lambda s: s["r"])
    return g.groupBy("season").agg(arc.alias("weekly_risk_arc"))


def live_state(f: DataFrame) -> DataFrame:
    """P5/SRT4: season and pack week of the most recent submission; the published
    default while there is none."""
    season, week = C.LIVE_DEFAULT
    found = latest(f.filter(F.col("date_key").isNotNull()), "date_key", ["season", "pack_week"])
    return found.withColumns({"season": F.coalesce("season", F.when(F.col("date_key").isNull(), F.lit(season))),
                              "pack_week": F.coalesce("pack_week", F.when(F.col("date_key").isNull(), F.lit(week)))})


def feed_as_of(f: DataFrame, feed: DataFrame) -> DataFrame:
    """JN12: every season with the landing valid on its last submission date."""
    from ..sources.files import enrich_feed
    seasons = f.groupBy("season").agg(F.max("submission_date").alias("last_date"), avg_fixed("rainfall_mm_7d", 1, 1).alias("rain_avg"))
    return enrich_feed(seasons, feed, "last_date")


def _profile() -> Column:
    fail_pct = F.lit(100.0) - F.col("mts_pass_pct")
    return F.struct(
        F.round(F.col("mts_pass_pct") / 100.0, 3).alias("mtsPassRate"),
        F.round("total_return_nzd_m", 2).alias("totalReturnM"),
        F.round(F.least(F.lit(100.0), fail_pct * 2.5), 0).alias("pestBase"),
        F.round("vol_avg", 1).alias("volIndex"),
        F.round("dm_avg", 2).alias("dmAvg"),
        F.lit(C.CLIMATE_NOTE_DEFAULT).alias("climateNote"),
        F.round("otif_avg", 2).alias("otifAvg"),
        F.round("payments_reversed_nzd_m", 3).alias("paymentsReversedM")).alias("season_profile")


def with_notes(profiles: DataFrame, notes: DataFrame | None) -> DataFrame:
    """Climate notes by season from a table (season, note) where it has one."""
    if notes is None:
        return profiles
    found = profiles.join(notes.select("season", F.col("note").alias("_note")), "season", "left")
    note = F.coalesce("_note", F.col("season_profile")["climateNote"])
    return found.withColumn("season_profile", F.col("season_profile").withField("climateNote", note)).drop("_note")


def season_profile(agg: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """DF27: the simulator's season object."""
    return with_notes(agg.select("season", _profile()), notes)


def subzone_profile(subzones: DataFrame) -> DataFrame:
    """DF29: subzone constants (distance, vibration stress) next to the ETL values."""
    vsi = F.create_map(*[x for k, v in C.SUBZONES.items() for x in (F.lit(k), F.lit(float(v["vsi"])))])
    dist = F.create_map(*[x for k, v in C.SUBZONES.items() for x in (F.lit(k), F.lit(int(v["distance_port_km"])))])
    return subzones.select("season", "subzone", "dm_mean", "dm_std", "mts_fail_pct",
                           F.coalesce(dist[F.col("subzone")], F.lit(30)).alias("distanceKm"),
                           F.coalesce(vsi[F.col("subzone")], F.lit(1.5)).alias("vsi"))


# measure: (column, decimals it holds); averages come from exact sums and counts of these
MEASURES = {"dm": ("dm_pct_avg", 2), "cong": ("congestion_index", 4), "rain": ("rainfall_mm_7d", 1), "vol": ("vol_index", 0),
            "reg": ("reg_index", 4), "otif": ("otif_pct", 2), "risk": ("risk_score", 0)}
ADDED = ["trays", "fails", "return_nzd", "reversed_nzd"]


def _average(measure: str, dp: int, at=F.col) -> Column:
    """The average of a measure, half up, from its sum and count."""
    held = MEASURES[measure][1]
    total, count = at(f"{measure}_sum"), at(f"{measure}_n")
    q = half_up_div(total * 10 ** max(dp - held, 0), count * 10 ** max(held - dp, 0))
    return F.when(count > 0, q / float(10 ** dp))


def payload_cells(f: DataFrame) -> DataFrame:
    """The one scan of the fact: exact sums by season, pack week and subzone, for
    every part of the payload, the health checks included."""
    sums = [x for k, (c, dp) in MEASURES.items() for x in (F.sum(fixed_int(c, dp)).alias(f"{k}_sum"), F.count(c).alias(f"{k}_n"))]
    fail = ~F.col("mts_pass")
    return f.groupBy("season", "pack_week", "subzone").agg(
        *sums, F.sum("trays_submitted").cast("long").alias("trays"), count_if(fail).alias("fails"),
        money_sum("total_return_nzd").alias("return_nzd"), money_sum("submit_payment_nzd", fail).alias("reversed_nzd"),
        *[F.sum(v).alias(f"check_{k}") for k, v in health_counts().items()],
        F.max("submission_date").alias("last_date"), F.max(F.struct("date_key", "season", "pack_week")).alias("latest"))


def _merged(cells: DataFrame) -> list:
    """Sums of sums, for a coarser grouping."""
    added = [c for c in cells.columns if c.endswith(("_sum", "_n")) or c.startswith("check_") or c in ADDED]
    return [F.sum(c).cast(cells.schema[c].dataType).alias(c) for c in added] + [F.max("last_date").alias("last_date"), F.max("latest").alias("latest")]


def payload_seasons(f: DataFrame) -> DataFrame:
    """One row a season with all its parts: the fact is aggregated once and the
    aggregate folded to weeks and seasons; arrays are bounded by the calendar."""
    cells = payload_cells(f)
    zone = F.struct(F.coalesce(-_average("risk", 1), F.lit(float("inf"))).alias("order"), "pack_week", "subzone", _average("risk", 1).alias("avg_risk"),
                    _average("dm", 3).alias("avg_dm"), _average("otif", 2).alias("avg_otif"), F.col("fails").alias("mts_fails"), F.col("check_rows").alias("submissions"))
    weeks = cells.withColumn("zone", zone).groupBy("season", "pack_week").agg(F.min("zone").alias("worst"), *_merged(cells))
    week = F.struct("pack_week", _average("risk", 1).alias("r"))
    seasons = weeks.withColumn("week", week).groupBy("season").agg(
        F.min("worst").alias("worst"), F.transform(F.array_sort(F.collect_list("week")), lambda w: w["r"]).alias("weekly_risk_arc"),
        F.min("pack_week").alias("first_pack_week"), F.max("pack_week").alias("last_pack_week"), *_merged(cells))
    every = Window.partitionBy()  # over a row a season
    overall = {k: F.sum(f"check_{k}").over(every) for k in health_counts()}
    out = seasons.select(
        "season", "weekly_risk_arc", "first_pack_week", "last_pack_week", "last_date",
        F.struct(*[F.col(f"worst.{c}").alias(c) for c in ("pack_week", "subzone", "avg_risk", "avg_dm", "avg_otif", "mts_fails", "submissions")]).alias("worst_week"),
        _average("dm", 2).alias("dm_avg"), _average("cong", 1).alias("cong_avg"), _average("rain", 1).alias("rain_avg"),
        _average("vol", 1).alias("vol_avg"), _average("reg", 1).alias("reg_avg"), _average("otif", 2).alias("otif_avg"),
        _average("risk", 1).alias("risk_avg"),
        pct(F.col("check_rows") - F.col("fails"), "check_rows", 3).alias("mts_pass_pct"),
        money_scaled(F.col("return_nzd"), 1_000_000, 3).alias("total_return_nzd_m"),
        money_scaled(F.col("reversed_nzd"), 1_000_000, 3).alias("payments_reversed_nzd_m"),
        F.col("trays").alias("total_trays"), F.col("check_rows").alias("submissions"),
        F.max("latest").over(every).alias("live"), F.max("last_date").over(every).alias("last_of_all"), *[v.alias(k) for k, v in overall.items()])
    out = out.withColumn("pass_rate", pct("passed", "rows", 3))
    return out.withColumn("health_score", health_score()).drop("passed", "rows", "pass_rate", *HARD_CHECKS[1:])


def payloads(f: DataFrame, readings: DataFrame, as_of: str | Column | None = None, feed: DataFrame | None = None,
             notes: DataFrame | None = None, live: bool = False) -> DataFrame:
    """DF28: one nested payload row per season; the fact is scanned once.

    ``as_of`` is the payload timestamp (ISO text, +12:00), a parameter so that
    output is reproducible; by default it is the latest submission date in the
    data.  ``feed`` (landed records) overrides the rain and adds exchange rates,
    each season taking the landing valid on its last submission date (JN12).
    ``notes`` are climate notes.  ``live`` gives the live season alone, at the
    pack week of its latest submission and with the latest landing (P5).
    """
    agg = payload_seasons(f)
    week = F.col("last_pack_week")
    if live:
        agg, week = agg.where(F.col("season") == F.col("live.season")), F.col("live.pack_week")
    sz = subzone_breakdown(readings)
    sub_map = sz.groupBy("season").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        "subzone", F.struct("dm_mean", "dm_std", "mts_fail_pct", "mts_pass_rate", "readings"))))).alias("subzones"))
    extras = []
    if feed is not None:
        from ..sources.files import enrich_feed
        agg = enrich_feed(agg, feed, None if live else "last_date")
        extras = ["nzd_eur", "nzd_jpy", "fx_date", "corridors_verified", "rain_source"]
    if as_of is None:
        stamp = F.concat(F.date_format("last_of_all", "yyyy-MM-dd'T'00:00:00"), F.lit(NZ_OFFSET))
    else:
        stamp = as_of if isinstance(as_of, Column) else F.lit(as_of)
    fail_pct = F.lit(100.0) - F.col("mts_pass_pct")
    core = agg.select(
        "season",
        F.col("dm_avg").alias("dm"),
        F.round(DF.pest_estimate(fail_pct, 5.0), 0).alias("pest"),
        DF.congestion_estimate(week).alias("congestion"),
        F.col("rain_avg").alias("rainfall"),
        F.col("vol_avg").alias("vol"),
        F.col("reg_avg").alias("regulatory"),
        stamp.alias("timestamp"),
        F.lit("star_schema").alias("source"),
        week.alias("pack_week"),
        F.struct(
            F.col("nulls"), F.col("health_score"),
            F.round(F.col("mts_pass_pct") / 100.0, 3).alias("mts_pass_rate"),
            F.round(fail_pct, 1).alias("mts_fail_pct"),
            F.col("otif_avg"), F.col("risk_avg"), F.col("total_return_nzd_m"),
            F.col("payments_reversed_nzd_m"), F.col("total_trays"), F.col("submissions"),
            stamp.alias("last_etl_run"),
            F.lit("Estimated from pack_week position").alias("congestion_note"),
        ).alias("data_quality"),
        "weekly_risk_arc", "worst_week", _profile(), *extras)
    order = ["season", "dm", "pest", "congestion", "rainfall", "vol", "regulatory", "timestamp", "source", "pack_week", "data_quality",
             "subzones", "weekly_risk_arc", "worst_week", "season_profile", *extras]
    return with_notes(core, notes).join(sub_map, "season", "left").select(*order)


def payload_json(p: DataFrame) -> DataFrame:
    """FN14: each season's payload serialised as JSON text."""
    return p.select("season", F.to_json(F.struct(*[c for c in p.columns])).alias("payload"))


PAYLOAD_FIELDS = """dm double, pest double, congestion int, rainfall double, vol double, regulatory double, timestamp string, source string, pack_week int,
data_quality struct<nulls: bigint, health_score: double, mts_pass_rate: double, mts_fail_pct: double, otif_avg: double, risk_avg: double,
 total_return_nzd_m: double, payments_reversed_nzd_m: double, total_trays: bigint, submissions: bigint>,
subzones map<string, struct<dm_mean: double, dm_std: double, mts_fail_pct: double, readings: bigint>>, weekly_risk_arc array<double>,
worst_week struct<pack_week: int, subzone: string, avg_risk: double, avg_dm: double, mts_fails: bigint>,
season_profile struct<mtsPassRate: double, pestBase: double, totalReturnM: double>, nzd_eur double, fx_date string, rain_source string"""


def payload_fields(documents: DataFrame) -> DataFrame:
    """The published documents read back: one flat row a season."""
    p = documents.select("season", F.from_json("payload", PAYLOAD_FIELDS).alias("p")).select("season", "p.*")
    zones = F.array_sort(F.map_entries("subzones"))
    return p.select(
        "season", "dm", "pest", "congestion", "rainfall", "vol", "regulatory", "timestamp", "source", "pack_week", "data_quality.*",
        F.transform(zones, lambda z: z["key"]).alias("zones"), F.transform(zones, lambda z: z["value"]["dm_mean"]).alias("zone_dm"),
        F.transform(zones, lambda z: z["value"]["readings"]).alias("zone_readings"), "weekly_risk_arc",
        F.col("worst_week.pack_week").alias("worst_pack_week"), F.col("worst_week.subzone").alias("worst_subzone"),
        F.col("worst_week.avg_risk").alias("worst_risk"), F.col("worst_week.avg_dm").alias("worst_dm"), F.col("worst_week.mts_fails").alias("worst_fails"),
        F.col("season_profile.pestBase").alias("pest_base"), F.col("season_profile.totalReturnM").alias("total_return_m"),
        "nzd_eur", "fx_date", "rain_source")


def combined_payload(p: DataFrame) -> DataFrame:
    """SNK6: all seasons keyed by label in one document (bounded by the
    number of seasons, not by data volume)."""
    return p.agg(F.map_from_entries(F.collect_list(F.struct("season", F.struct(*[c for c in p.columns if c != "season"]))))
                 .alias("seasons"))
