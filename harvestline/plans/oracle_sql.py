"""Reference SQL for every registered query, runnable by DuckDB on the
driver's parquet tables (views ``region nation supplier part lineitem orders
events …``).  It restates the bindings and formulas independently of the
Spark code; the correctness check runs both and compares.

Rounding helpers produce the same exact half-up results as
``operators.aggregates`` (integer arithmetic), so both sides agree on ties.
"""

from __future__ import annotations

from .. import config as C


def pct(num: str, den: str, dp: int) -> str:
    s = 10 ** dp
    return (f"CASE WHEN ({den}) > 0 THEN CAST((2 * CAST({num} AS BIGINT) * {100 * s} + ({den})) // (2 * ({den})) "
            f"AS DOUBLE) / {s} END")


def fixed(x: str, dp: int) -> str:
    return f"CAST(ROUND(({x}) * {10 ** dp}) AS BIGINT)"


def avg_fixed(x: str, dp_in: int, dp_out: int) -> str:
    """ROUND(AVG(x), dp_out) for a column with dp_in decimals, exact."""
    s = f"SUM({fixed(x, dp_in)})"
    n = f"COUNT({x})"
    if dp_out >= dp_in:
        num, den = f"{s} * {10 ** (dp_out - dp_in)}", n
    else:
        num, den = s, f"{n} * {10 ** (dp_in - dp_out)}"
    return f"CASE WHEN {n} > 0 THEN CAST((2 * {num} + {den}) // (2 * {den}) AS DOUBLE) / {10 ** dp_out} END"


def money(sum_expr: str, divisor: int, dp: int) -> str:
    factor = {1000: "0.001", 1_000_000: "0.000001"}[divisor]
    return f"CAST(ROUND(({sum_expr}) * {factor}, {dp}) AS DOUBLE)"


def count_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _case(expr: str, mapping: dict, default: str | None = None, quote=True) -> str:
    parts = " ".join(
        f"WHEN {expr} = {repr(k) if isinstance(k, str) else k} THEN {repr(v) if quote else v}"
        for k, v in mapping.items())
    return f"CASE {parts}" + (f" ELSE {default}" if default is not None else "") + " END"


def _size_case(u: str) -> str:
    acc, parts = 0, []
    for code, p in zip(C.SIZE_CODES[:-1], C.SIZE_PROBS[:-1]):
        acc += int(round(p * 100))
        parts.append(f"WHEN {u} < {acc} THEN '{code}'")
    return "CASE " + " ".join(parts) + f" ELSE '{C.SIZE_CODES[-1]}' END"


def _rate_case() -> str:
    rates = {k: v for k, v in C.SUBMIT_RATES.items() if k != "Green_sz42"}
    inner = " ".join(f"WHEN variety = '{k}' THEN CAST({v:.2f} AS DECIMAL(6,2))" for k, v in rates.items())
    return (f"CASE WHEN variety = 'Green' AND size_code = '42' THEN CAST({C.SUBMIT_RATES['Green_sz42']:.2f} AS DECIMAL(6,2)) "
            f"ELSE CASE {inner} ELSE CAST({C.SUBMIT_RATES['Green']:.2f} AS DECIMAL(6,2)) END END")


GOLD = "(variety LIKE '%SunGold%' OR variety LIKE '%Gold%')"
MTS_CENTI = f"CASE WHEN {GOLD} THEN 1610 WHEN variety LIKE '%Ruby%' THEN 1720 ELSE 1550 END"
TASTE_MAX = f"CASE WHEN {GOLD} THEN 860 ELSE 1000 END"
RAIN = ("CASE WHEN pack_week < 14 THEN 28.0 WHEN pack_week < 17 THEN 32.0 WHEN pack_week < 20 THEN 22.0 "
        "WHEN pack_week < 23 THEN 18.0 ELSE 15.0 END")
JAM = ("CASE WHEN {w} < 13 THEN 15 WHEN {w} < 16 THEN 22 WHEN {w} < 20 THEN 38 WHEN {w} < 23 THEN 32 ELSE 18 END")
PHASE = "CASE WHEN {w} < 14 THEN 'KiwiStart' WHEN {w} <= 22 THEN 'MainPack' WHEN {w} IS NOT NULL THEN 'Late' END"


def season_label(d: str) -> str:
    sy = f"(CASE WHEN month({d}) >= 4 THEN year({d}) ELSE year({d}) - 1 END)"
    return f"CAST({sy} AS VARCHAR) || '/' || lpad(CAST(({sy} + 1) % 100 AS VARCHAR), 2, '0')"


def prelude(congestion: float = C.CONGESTION_DEFAULT, reg: float = C.REG_INDEX_DEFAULT,
            pest: float = C.PEST_DEFAULT, km: float = C.DISTANCE_DEFAULT_KM) -> str:
    """CTEs: sz (supplier subzone), subs (submissions), fact, readings."""
    variety = _case("p.p_type", C.PART_TYPE_VARIETY)
    subzone = _case("n.n_regionkey", C.REGION_SUBZONE)
    d = "CAST(l.l_shipdate AS DATE)"
    return f"""
sz AS (
  SELECT s.s_suppkey, {subzone} AS subzone
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
b0 AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, 100000 + l.l_suppkey AS kpin, sz.subzone, {variety} AS variety,
         {d} AS submission_date,
         CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER) AS date_key,
         CAST(weekofyear({d}) AS INTEGER) AS pack_week,
         {season_label(d)} AS season,
         {_size_case("((3 * l.l_orderkey + 7 * l.l_linenumber + l.l_partkey) % 100)")} AS size_code,
         CAST(trunc(l.l_quantity) AS BIGINT) * 10 AS trays_submitted,
         CAST(ROUND(l.l_discount * 100) AS BIGINT) AS disc_pct,
         CAST(1300 + (7 * l.l_orderkey + 13 * l.l_partkey + 31 * l.l_suppkey + 101 * l.l_linenumber) % 701 AS INTEGER) AS dm_centi,
         (7 * l.l_orderkey + 13 * l.l_linenumber) % 100 AS loss_draw,
         CASE WHEN l.l_suppkey % 5 = 0 THEN 1 ELSE 0 END AS pest_indicator,
         CAST(95 + year({d}) % 10 AS DOUBLE) AS vol_index
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN sz ON l.l_suppkey = sz.s_suppkey
),
b1 AS (
  SELECT *, (trays_submitted * disc_pct) // 100 AS trays_lost,
         {MTS_CENTI} AS mts_centi, {TASTE_MAX} AS taste_max
  FROM b0
),
b2 AS (
  SELECT *, trays_submitted - trays_lost AS trays_exported,
         CAST(dm_centi AS DOUBLE) / 100 AS dm_pct_avg,
         dm_centi >= mts_centi AS mts_pass,
         CASE WHEN dm_centi < mts_centi THEN 0
              ELSE LEAST((2 * GREATEST(dm_centi - mts_centi, 0) * taste_max + (2000 - mts_centi)) // (2 * (2000 - mts_centi)), taste_max)
         END AS tzg_milli,
         CAST({_rate_case()} * CAST(trays_submitted AS DECIMAL(18,0)) AS DECIMAL(18,2)) AS submit_payment_nzd
  FROM b1
),
subs AS (
  SELECT *, CAST(tzg_milli AS DOUBLE) / 1000 AS tzg_score,
         CAST(CASE WHEN mts_pass THEN ROUND(CAST(tzg_milli AS DECIMAL(18,0)) * 0.001 * 0.95 * CAST(trays_exported AS DECIMAL(18,0)), 2)
              ELSE 0 END AS DECIMAL(18,2)) AS taste_payment_nzd
  FROM b2
),
fact AS (
  SELECT *,
    CAST(CASE WHEN mts_pass THEN submit_payment_nzd + taste_payment_nzd ELSE 0 END AS DECIMAL(18,2)) AS total_return_nzd,
    ROUND(GREATEST(52.0, 97.5 - (POW(congestion_index / 100.0, 1.3) * 8.5 + POW(LEAST(rainfall_mm_7d, 120.0) / 120.0, 1.2) * 5.5
          + POW(reg_index / 100.0, 1.2) * 3.0 + CASE WHEN mts_pass THEN 0.0 ELSE 12.0 END)), 2) AS otif_pct,
    CAST(LEAST(GREATEST(ROUND(((1 - 1.0 / (1.0 + EXP((dm_pct_avg - 15.5) * -2.2))) * 0.35
          + POW(LEAST(CAST({pest} AS DOUBLE), 100.0) / 100.0, 1.4) * 0.25 + POW(congestion_index / 100.0, 1.3) * 0.15
          + POW(LEAST(rainfall_mm_7d, 120.0) / 120.0, 1.2) * 0.15 + POW(reg_index / 100.0, 1.2) * 0.10) * 100), 1), 100) AS INTEGER) AS risk_score,
    CAST(ROUND(CAST(trays_exported AS DECIMAL(18,0)) * 0.0085 * CAST({km} AS DECIMAL(10,2))
          * (1 + CAST(congestion_index AS DECIMAL(10,2)) * 0.005), 2) AS DECIMAL(18,2)) AS freight_cost_nzd
  FROM (SELECT *, CAST({congestion} AS DOUBLE) AS congestion_index, CAST({RAIN} AS DOUBLE) AS rainfall_mm_7d,
               CAST({reg} AS DOUBLE) AS reg_index,
               {PHASE.format(w='pack_week')} AS season_phase,
               {_case("subzone", {z: i + 1 for i, z in enumerate(C.SUBZONES)}, quote=False)} AS corridor_key
        FROM subs)
),
factm AS (
  SELECT *, ROUND(CASE WHEN me IS NOT NULL THEN LEAST(GREATEST(me, 0.0), 100.0) END, 2) AS margin_erosion_pct
  FROM (SELECT *, (1 - CAST(total_return_nzd AS DOUBLE)
            / NULLIF(CAST(CAST(trays_submitted AS DECIMAL(18,0)) * 4.15 AS DOUBLE), 0)) * 100 AS me FROM fact)
),
rd0 AS (
  SELECT kpin, season, pack_week, variety, subzone, pest_indicator, MIN(submission_date) AS reading_date,
         CAST((2 * SUM(dm_centi) + COUNT(*)) // (2 * COUNT(*)) AS INTEGER) AS dm_centi, COUNT(*) * 90 AS sample_size
  FROM subs GROUP BY kpin, season, pack_week, variety, subzone, pest_indicator
),
readings AS (
  SELECT *, CAST(dm_centi AS DOUBLE) / 100 AS dm_pct,
         CASE WHEN dm_centi >= {MTS_CENTI} THEN 'PASS' ELSE 'FAIL' END AS mts_status,
         CAST(CASE WHEN dm_centi < {MTS_CENTI} THEN 0
              ELSE LEAST((2 * GREATEST(dm_centi - {MTS_CENTI}, 0) * {TASTE_MAX} + (2000 - {MTS_CENTI})) // (2 * (2000 - {MTS_CENTI})), {TASTE_MAX})
         END AS DOUBLE) / 1000 AS tzg_score
  FROM rd0
)"""


FAIL = "NOT mts_pass"


def _q(body: str, **kw) -> str:
    return "WITH " + prelude(**kw) + "\n" + body


def traffic_prelude() -> str:
    region = ("CASE WHEN (user_id % 14) + 1 = 4 THEN '" + C.REGION_LABEL + "' "
              "ELSE lpad(CAST((user_id % 14) + 1 AS VARCHAR), 2, '0') || ' - Region' END")
    site = "lpad(CAST((user_id % 3 + 1) * 100000 + user_id AS VARCHAR), 8, '0')"
    cls = "CASE WHEN event_type IN ('purchase', 'error') THEN 'Heavy' ELSE 'Light' END"
    return f"""
tms AS (
  SELECT ts AS start_date, {region} AS region_name, {site} AS site_reference,
         'Site ' || CAST(user_id AS VARCHAR) AS site_description, {cls} AS class_weight,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS traffic_count
  FROM events),
tf AS (
  SELECT * FROM tms
  WHERE COALESCE(lower(region_name) LIKE '%{C.REGION_NAME.lower()}%' OR region_name LIKE '%{C.REGION_CODE}%', FALSE)
    AND site_reference LIKE '{C.SH2_PREFIX}%' AND start_date IS NOT NULL),
ti AS (
  SELECT *, COALESCE(traffic_count, MEDIAN(traffic_count) OVER (PARTITION BY site_reference, class_weight)) AS cnt
  FROM tf),
tp AS (
  SELECT CAST(start_date AS DATE) AS date, site_reference, site_description, region_name,
         COALESCE(SUM(CASE WHEN class_weight = 'Heavy' THEN CAST(ROUND(cnt * 1000) AS BIGINT) END), 0) AS hm,
         COALESCE(SUM(CASE WHEN class_weight = 'Light' THEN CAST(ROUND(cnt * 1000) AS BIGINT) END), 0) AS lm
  FROM ti GROUP BY 1, 2, 3, 4),
daily AS (
  SELECT date, site_reference, site_description, region_name,
         CAST(hm AS DOUBLE) / 1000 AS heavy_count, CAST(lm AS DOUBLE) / 1000 AS light_count,
         CAST(hm + lm AS DOUBLE) / 1000 AS total_count,
         CAST(LEAST(GREATEST((2 * (3 * hm + lm) + 880) // (2 * 880), 0), 10000) AS DOUBLE) / 100 AS congestion_index,
         CAST(weekofyear(date) AS INTEGER) AS iso_week, CAST(weekofyear(date) AS INTEGER) AS pack_week,
         {PHASE.format(w='weekofyear(date)')} AS season_phase
  FROM tp),
mm AS (SELECT MIN(CAST(ROUND(congestion_index * 100) AS BIGINT)) AS lo,
              MAX(CAST(ROUND(congestion_index * 100) AS BIGINT)) AS hi FROM daily),
scaled AS (
  SELECT d.*, CASE WHEN hi > lo THEN CAST((2 * (CAST(ROUND(congestion_index * 100) AS BIGINT) - lo) * 1000 + (hi - lo))
                                          // (2 * (hi - lo)) AS DOUBLE) / 10 ELSE 25.0 END AS congestion_index_scaled
  FROM daily d, mm)"""


def _payload_sql(q: dict, live: bool = False) -> str:
    """The payload's fields from the parts' own SQL; the feed's landing by date, or the latest one."""
    week = "l.pack_week" if live else "a.last_pack_week"
    fx = "SELECT * FROM landings ORDER BY month DESC LIMIT 1" if live else "SELECT * FROM landings"
    join = "CROSS JOIN fx" if live else "ASOF LEFT JOIN fx ON d.last_date >= fx.month"
    return f"""
WITH a AS ({q["p1_season_aggregate"]}), z AS ({q["p2_subzone_breakdown"]}), w AS ({q["p3_worst_week"]}), arc AS ({q["p4_weekly_risk_arc"]}),
l AS ({q["p5_live_state"]}), h AS ({q["dq_fact_health"]}),
d AS ({_q("SELECT season, MAX(submission_date) AS last_date FROM factm GROUP BY season")}),
zs AS (SELECT season, list(subzone ORDER BY subzone) AS zones, list(dm_mean ORDER BY subzone) AS zone_dm, list(readings ORDER BY subzone) AS zone_readings FROM z GROUP BY season),
months AS (SELECT date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS month, COUNT(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
landings AS (SELECT month, CAST(ROUND(n % 5 + (n % 7) / 2.0, 1) AS DOUBLE) AS rain, CAST(ROUND((n % 100 + 500) / 1000.0, 4) AS DOUBLE) AS eur FROM months),
fx AS ({fx})
SELECT a.season, dm_avg AS dm, ROUND(LEAST(100.0, GREATEST(5.0, (100.0 - mts_pass_pct) * 2.5)), 0) AS pest, {JAM.format(w=week)} AS congestion,
  COALESCE(fx.rain, rain_avg) AS rainfall, vol_avg AS vol, reg_avg AS regulatory,
  strftime((SELECT MAX(last_date) FROM d), '%Y-%m-%dT00:00:00+12:00') AS timestamp, 'star_schema' AS source, {week} AS pack_week,
  h.nulls, h.health_score, ROUND(mts_pass_pct / 100.0, 3) AS mts_pass_rate, ROUND(100.0 - mts_pass_pct, 1) AS mts_fail_pct, otif_avg, a.risk_avg,
  total_return_nzd_m, payments_reversed_nzd_m, total_trays, a.submissions, zones, zone_dm, zone_readings, weekly_risk_arc,
  w.pack_week AS worst_pack_week, w.subzone AS worst_subzone, w.avg_risk AS worst_risk, w.avg_dm AS worst_dm, w.mts_fails AS worst_fails,
  ROUND(LEAST(100.0, (100.0 - mts_pass_pct) * 2.5), 0) AS pest_base, ROUND(total_return_nzd_m, 2) AS total_return_m,
  fx.eur AS nzd_eur, CAST(fx.month AS VARCHAR) AS fx_date, CASE WHEN fx.rain IS NULL THEN 'etl' ELSE 'feed' END AS rain_source
FROM a JOIN w ON w.season = a.season JOIN arc ON arc.season = a.season JOIN zs ON zs.season = a.season CROSS JOIN h CROSS JOIN l JOIN d ON d.season = a.season
{join}{" WHERE a.season = l.season" if live else ""}"""


def queries_sql() -> dict:
    q = {}
    q["q1_compliance"] = _q(f"""
SELECT season, variety, COUNT(*) AS total_submissions, {count_if(FAIL)} AS mts_fails,
  {pct(f"SUM(CASE WHEN {FAIL} THEN 1 ELSE 0 END)", "COUNT(*)", 2)} AS mts_fail_pct,
  {avg_fixed("dm_pct_avg", 2, 3)} AS avg_dm_pct,
  ROUND(MIN(dm_pct_avg), 2) AS min_dm_pct,
  {money(f"SUM(CASE WHEN {FAIL} THEN submit_payment_nzd ELSE 0 END)", 1000, 2)} AS payment_reversed_nzd_k
FROM factm GROUP BY season, variety ORDER BY season, mts_fail_pct DESC, variety""")
    q["q2_otif_by_week"] = _q(f"""
SELECT pack_week, season_phase, {avg_fixed("otif_pct", 2, 2)} AS avg_otif, ROUND(MIN(otif_pct), 2) AS min_otif,
  ROUND(AVG(congestion_index), 2) AS avg_congestion, {avg_fixed("rainfall_mm_7d", 1, 1)} AS avg_rainfall_mm,
  COUNT(*) AS submissions, {count_if("otif_pct < 88")} AS below_target_count,
  {pct("SUM(CASE WHEN otif_pct < 88 THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS below_target_pct
FROM factm WHERE date_key IS NOT NULL GROUP BY pack_week, season_phase ORDER BY pack_week""")
    q["q3_dm_elasticity"] = _q(f"""
SELECT CAST((2 * {fixed("dm_pct_avg", 2)} + 10) // 20 AS DOUBLE) / 10 AS dm_pct_band, COUNT(*) AS submissions,
  {avg_fixed("tzg_score", 3, 3)} AS avg_tzg,
  ROUND(AVG(CAST(taste_payment_nzd AS DOUBLE) / NULLIF(trays_exported, 0)), 4) AS avg_taste_per_tray,
  ROUND(AVG(CAST(total_return_nzd AS DOUBLE) / NULLIF(trays_submitted, 0)), 4) AS avg_return_per_tray,
  {money("SUM(total_return_nzd)", 1_000_000, 2)} AS total_return_nzd_m,
  {avg_fixed("margin_erosion_pct", 2, 2)} AS avg_margin_erosion_pct
FROM factm WHERE mts_pass GROUP BY 1 ORDER BY 1""")
    q["q4_dm_variance"] = _q(f"""
SELECT subzone, season, COUNT(*) AS readings, {avg_fixed("dm_pct", 2, 3)} AS dm_mean,
  ROUND(STDDEV_POP(dm_pct), 3) AS dm_std, ROUND(MIN(dm_pct), 2) AS dm_min, ROUND(MAX(dm_pct), 2) AS dm_max,
  CAST(MAX(dm_centi) - MIN(dm_centi) AS DOUBLE) / 100 AS dm_range,
  {pct("SUM(CASE WHEN mts_status = 'FAIL' THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS mts_fail_pct
FROM readings GROUP BY subzone, season ORDER BY subzone, season""")
    q["q5_risk_bands"] = _q(f"""
SELECT risk_band, total, otif_below_88, {pct("otif_below_88", "total", 1)} AS detection_rate_pct,
  otif_above_88, {pct("otif_above_88", "total", 1)} AS false_alarm_rate_pct
FROM (SELECT CASE WHEN risk_score < 30 THEN '1_LOW (0-29)' WHEN risk_score < 45 THEN '2_MODERATE (30-44)'
                  WHEN risk_score < 60 THEN '3_ELEVATED (45-59)' ELSE '4_HIGH (60+)' END AS risk_band,
             COUNT(*) AS total, {count_if("otif_pct < 88")} AS otif_below_88, {count_if("otif_pct >= 88")} AS otif_above_88
      FROM factm GROUP BY 1) ORDER BY risk_band""")
    week_sub = f"""
SELECT season, pack_week, season_phase, subzone,
  {avg_fixed("risk_score", 0, 1)} AS avg_risk_score, CAST(MAX(risk_score) AS DOUBLE) AS max_risk_score,
  {avg_fixed("dm_pct_avg", 2, 3)} AS avg_dm, {avg_fixed("otif_pct", 2, 2)} AS avg_otif,
  ROUND(AVG(congestion_index), 1) AS avg_congestion, {avg_fixed("rainfall_mm_7d", 1, 1)} AS avg_rainfall,
  COUNT(*) AS submissions, {count_if(FAIL)} AS mts_fails,
  {money("SUM(total_return_nzd)", 1_000_000, 3)} AS return_nzd_m,
  {money(f"SUM(CASE WHEN {FAIL} THEN submit_payment_nzd ELSE 0 END)", 1000, 2)} AS payments_reversed_nzd_k
FROM factm WHERE date_key IS NOT NULL GROUP BY season, pack_week, season_phase, subzone"""
    q["q6_worst_weeks"] = _q(week_sub + "\nORDER BY avg_risk_score DESC, season, pack_week, subzone LIMIT 20")
    q["v1_mts_fail_rate"] = _q(f"""
SELECT {pct(f"SUM(CASE WHEN {FAIL} THEN 1 ELSE 0 END)", "COUNT(*)", 2)} AS mts_fail_pct FROM factm""")
    q["v2_returns_by_season"] = _q(f"""
SELECT season, {money("SUM(total_return_nzd)", 1_000_000, 2)} AS return_nzd_m, COUNT(*) AS submissions
FROM factm GROUP BY season ORDER BY season""")
    q["v3_dm_by_subzone"] = _q(f"""
SELECT subzone, {avg_fixed("dm_pct", 2, 3)} AS dm_mean, {avg_fixed("tzg_score", 3, 3)} AS tzg_mean, COUNT(*) AS readings
FROM readings GROUP BY subzone ORDER BY dm_mean DESC, subzone""")
    q["v4_risk_distribution"] = _q(f"""
SELECT risk_band, submissions, {pct("submissions", "SUM(submissions) OVER ()", 1)} AS pct
FROM (SELECT CASE WHEN risk_score < 30 THEN 'LOW (0-29)' WHEN risk_score < 55 THEN 'ELEVATED (30-54)'
                  WHEN risk_score < 70 THEN 'HIGH (55-69)' ELSE 'CRITICAL (70+)' END AS risk_band,
             COUNT(*) AS submissions, MIN(risk_score) AS mn
      FROM factm GROUP BY 1) ORDER BY mn""")
    q["v5_orphans"] = _q("""
SELECT COUNT(*) AS orphan_rows FROM factm f
WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.kpin = f.kpin AND r.season = f.season
                  AND r.pack_week = f.pack_week AND r.variety = f.variety)""")
    q["v6_otif_by_season"] = _q(f"""
SELECT season, {avg_fixed("otif_pct", 2, 2)} AS avg_otif, ROUND(MIN(otif_pct), 2) AS min_otif, COUNT(*) AS submissions
FROM factm GROUP BY season ORDER BY season""")
    q["m3_seasonal_breakdown"] = _q(f"""
SELECT season, COUNT(*) AS total, {avg_fixed("risk_score", 0, 1)} AS avg_risk, {avg_fixed("otif_pct", 2, 2)} AS avg_otif,
  {pct(f"SUM(CASE WHEN {FAIL} THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS mts_fail_pct,
  {pct("SUM(CASE WHEN otif_pct < 88 THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS otif_fail_pct,
  {money("SUM(total_return_nzd)", 1_000_000, 2)} AS return_nzd_m,
  {money(f"SUM(CASE WHEN {FAIL} THEN submit_payment_nzd ELSE 0 END)", 1_000_000, 3)} AS reversed_nzd_m
FROM factm GROUP BY season ORDER BY season""")
    q["p1_season_aggregate"] = _q(f"""
SELECT season, {avg_fixed("dm_pct_avg", 2, 2)} AS dm_avg, ROUND(AVG(congestion_index), 1) AS cong_avg,
  {avg_fixed("rainfall_mm_7d", 1, 1)} AS rain_avg, {avg_fixed("vol_index", 0, 1)} AS vol_avg,
  ROUND(AVG(reg_index), 1) AS reg_avg, {avg_fixed("otif_pct", 2, 2)} AS otif_avg, {avg_fixed("risk_score", 0, 1)} AS risk_avg,
  {pct("SUM(CASE WHEN mts_pass THEN 1 ELSE 0 END)", "COUNT(*)", 3)} AS mts_pass_pct,
  {money("SUM(total_return_nzd)", 1_000_000, 3)} AS total_return_nzd_m,
  {money(f"SUM(CASE WHEN {FAIL} THEN submit_payment_nzd ELSE 0 END)", 1_000_000, 3)} AS payments_reversed_nzd_m,
  CAST(SUM(trays_submitted) AS BIGINT) AS total_trays, COUNT(*) AS submissions,
  MIN(pack_week) AS first_pack_week, MAX(pack_week) AS last_pack_week
FROM factm GROUP BY season""")
    q["p2_subzone_breakdown"] = _q(f"""
SELECT season, subzone, dm_mean, dm_std, readings, mts_fail_pct,
  CAST(1000 - CAST(ROUND(mts_fail_pct * 10) AS BIGINT) AS DOUBLE) / 1000 AS mts_pass_rate
FROM (SELECT season, subzone, {avg_fixed("dm_pct", 2, 3)} AS dm_mean, ROUND(STDDEV_POP(dm_pct), 3) AS dm_std,
        COUNT(*) AS readings, {pct("SUM(CASE WHEN mts_status = 'FAIL' THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS mts_fail_pct
      FROM readings GROUP BY season, subzone)""")
    q["p3_worst_week"] = _q(f"""
SELECT * FROM (
  SELECT season, pack_week, subzone, {avg_fixed("risk_score", 0, 1)} AS avg_risk, {avg_fixed("dm_pct_avg", 2, 3)} AS avg_dm,
    {avg_fixed("otif_pct", 2, 2)} AS avg_otif, {count_if(FAIL)} AS mts_fails, COUNT(*) AS submissions
  FROM factm GROUP BY season, pack_week, subzone)
QUALIFY ROW_NUMBER() OVER (PARTITION BY season ORDER BY avg_risk DESC, pack_week, subzone) = 1""")
    q["p4_weekly_risk_arc"] = _q(f"""
SELECT season, LIST(r ORDER BY pack_week) AS weekly_risk_arc
FROM (SELECT season, pack_week, {avg_fixed("risk_score", 0, 1)} AS r FROM factm GROUP BY season, pack_week)
GROUP BY season""")
    q["p5_live_state"] = _q("""
SELECT date_key, season, pack_week FROM factm WHERE date_key IS NOT NULL
ORDER BY date_key DESC, season DESC, pack_week DESC LIMIT 1""")
    q["p7_subzone_profile"] = _q(f"""
SELECT season, subzone, {avg_fixed("dm_pct", 2, 3)} AS dm_mean, ROUND(STDDEV_POP(dm_pct), 3) AS dm_std,
  {pct("SUM(CASE WHEN mts_status = 'FAIL' THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS mts_fail_pct,
  {_case("subzone", {k: int(v["distance_port_km"]) for k, v in C.SUBZONES.items()}, "30", quote=False)} AS distanceKm,
  {_case("subzone", {k: float(v["vsi"]) for k, v in C.SUBZONES.items()}, "1.5", quote=False)} AS vsi
FROM readings GROUP BY season, subzone""")
    spine = (f"(SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key "
             f"FROM (SELECT CAST(generate_series AS DATE) AS d FROM generate_series(DATE '{C.SPINE_START}', "
             f"DATE '{C.SPINE_END}', INTERVAL 1 DAY)))")
    q["dq_star_checks"] = _q(f"""
SELECT 'pk_dim_fruit_quality' AS check_name,
  (SELECT COUNT(*) FROM (SELECT 1 FROM readings GROUP BY kpin, season, pack_week, variety HAVING COUNT(*) > 1))
  + (SELECT COALESCE(SUM(CASE WHEN kpin IS NULL OR season IS NULL OR pack_week IS NULL OR variety IS NULL THEN 1 ELSE 0 END), 0) FROM readings)
  AS violations
UNION ALL SELECT 'pk_dim_corridor', 0
UNION ALL SELECT 'pk_dim_time', (SELECT COUNT(*) FROM (SELECT date_key FROM {spine} GROUP BY date_key HAVING COUNT(*) > 1))
UNION ALL SELECT 'fk_fact_fruit', (SELECT COUNT(*) FROM factm f WHERE NOT EXISTS (SELECT 1 FROM readings r
   WHERE r.kpin = f.kpin AND r.season = f.season AND r.pack_week = f.pack_week AND r.variety = f.variety))
UNION ALL SELECT 'fk_fact_time', (SELECT COUNT(*) FROM factm f WHERE f.date_key IS NOT NULL
   AND f.date_key NOT IN (SELECT date_key FROM {spine}))
UNION ALL SELECT 'fk_fact_corridor', (SELECT COUNT(*) FROM factm WHERE subzone IS NULL
   OR subzone NOT IN ({", ".join(repr(z) for z in C.SUBZONES)}))
UNION ALL SELECT 'pk_dim_grower', (SELECT COUNT(*) FROM (SELECT 1 FROM supplier GROUP BY s_suppkey HAVING COUNT(*) > 1)) + (SELECT COUNT(*) FROM supplier WHERE s_suppkey IS NULL)
UNION ALL SELECT 'fk_fact_grower', (SELECT COUNT(*) FROM factm WHERE kpin IS NULL OR kpin - 100000 NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'fk_grower_corridor', (SELECT COUNT(*) FROM sz WHERE subzone IS NULL OR subzone NOT IN ({", ".join(repr(z) for z in C.SUBZONES)}))""")
    checks = ["nulls = 0", "no_date = 0", "bad_trays = 0", "bad_return = 0", "bad_otif = 0", "bad_risk = 0",
              "pass_rate BETWEEN 85.0 AND 97.0"]
    passed = " + ".join(f"CAST(COALESCE({c}, FALSE) AS INTEGER)" for c in checks)
    key_cols = ["season", "subzone", "variety", "pack_week", "dm_pct_avg", "otif_pct", "risk_score",
                "total_return_nzd", "trays_submitted", "trays_exported", "trays_lost", "mts_pass"]
    nulls = " + ".join(f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in key_cols)
    q["dq_fact_health"] = _q(f"""
SELECT CAST(nulls AS BIGINT) AS nulls, CAST(({passed}) * 100 AS DOUBLE) / {len(checks)} AS health_score,
  pass_rate, no_date, bad_trays, bad_return, bad_otif, bad_risk
FROM (SELECT {nulls} AS nulls,
        {count_if("date_key IS NULL")} AS no_date,
        {count_if("trays_exported + trays_lost <> trays_submitted")} AS bad_trays,
        {count_if("NOT mts_pass AND total_return_nzd <> 0")} AS bad_return,
        {count_if("NOT (otif_pct BETWEEN 52.0 AND 97.5)")} AS bad_otif,
        {count_if("NOT (risk_score BETWEEN 1 AND 100)")} AS bad_risk,
        {pct("SUM(CASE WHEN mts_pass THEN 1 ELSE 0 END)", "COUNT(*)", 3)} AS pass_rate
      FROM factm)""")
    q["str6_publish_stream"] = f"""
SELECT CAST(0 AS INTEGER) AS epoch, CASE WHEN health_score >= {C.HEALTH_GATE} AND violated = '' THEN 'OK' ELSE 'ALERT' END AS status, health_score, rows,
  violated, CASE WHEN health_score >= {C.HEALTH_GATE} AND violated = '' THEN rows ELSE 0 END AS published
FROM (SELECT health_score, CASE WHEN nulls + no_date + bad_trays + bad_return + bad_otif + bad_risk = 0 THEN '' ELSE '?' END AS violated,
        (SELECT COUNT(*) FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey) AS rows
      FROM ({q["dq_fact_health"]}))"""
    for name in ("q1_compliance", "q2_otif_by_week", "q3_dm_elasticity", "q4_dm_variance", "q5_risk_bands", "q6_worst_weeks"):
        q[f"{name}_sql"] = q[name]
    numbers = {
        "q1_compliance": "total_submissions mts_fails mts_fail_pct avg_dm_pct min_dm_pct payment_reversed_nzd_k",
        "q2_otif_by_week": "pack_week avg_otif min_otif avg_congestion avg_rainfall_mm submissions below_target_count below_target_pct",
        "q3_dm_elasticity": "dm_pct_band submissions avg_tzg avg_taste_per_tray avg_return_per_tray total_return_nzd_m avg_margin_erosion_pct",
        "q4_dm_variance": "readings dm_mean dm_std dm_min dm_max dm_range mts_fail_pct",
        "q5_risk_bands": "total otif_below_88 detection_rate_pct otif_above_88 false_alarm_rate_pct",
        "q6_worst_weeks": "pack_week avg_risk_score max_risk_score avg_dm avg_otif avg_congestion avg_rainfall submissions mts_fails return_nzd_m payments_reversed_nzd_k"}
    q["snk9_query_results"] = "\nUNION ALL\n".join(
        f"SELECT '{name[:2]}' AS query, '{c}' AS \"column\", ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max, "
        f"ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS avg FROM ({q[name]})" for name, cols in numbers.items() for c in cols.split())
    q["agg9_dm_by_variety"] = _q(f"""
SELECT variety, COUNT(*) AS readings, {avg_fixed("dm_pct", 2, 2)} AS dm_mean, ROUND(STDDEV_SAMP(dm_pct), 2) AS dm_std,
  ROUND(MIN(dm_pct), 1) AS dm_min, ROUND(MAX(dm_pct), 1) AS dm_max FROM readings GROUP BY variety""")
    q["agg14_distinct_counts"] = _q("""
SELECT season, COUNT(DISTINCT kpin) AS growers, COUNT(DISTINCT variety) AS varieties, COUNT(DISTINCT submission_date) AS days FROM factm GROUP BY season""")
    q["agg14_distinct_sketches"] = _q("""
SELECT COUNT(DISTINCT kpin) AS kpin_exact, COUNT(DISTINCT variety) AS variety_exact, COUNT(DISTINCT submission_date) AS submission_date_exact,
  TRUE AS kpin_within_bound, TRUE AS variety_within_bound, TRUE AS submission_date_within_bound FROM factm""")
    q["agg22_season_validation"] = _q(f"""
SELECT season, pass_pct, pass_pct BETWEEN 85 AND 97 AS expected, return_nzd_m, trays_submitted
FROM (SELECT season, {pct("SUM(CASE WHEN mts_status = 'PASS' THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS pass_pct FROM readings GROUP BY season)
JOIN (SELECT season, {money("SUM(total_return_nzd)", 1_000_000, 1)} AS return_nzd_m, CAST(SUM(trays_submitted) AS BIGINT) AS trays_submitted
      FROM factm GROUP BY season) USING (season)""")
    q["agg22_dm_by_subzone"] = _q(f"""
SELECT subzone, {avg_fixed("dm_pct", 2, 2)} AS dm_mean, ROUND(STDDEV_SAMP(dm_pct), 2) AS dm_std FROM readings GROUP BY subzone ORDER BY dm_std, subzone""")
    q["agg25_fact_totals"] = _q(f"""
SELECT COUNT(*) AS rows, {money("SUM(total_return_nzd)", 1_000_000, 1)} AS total_return_nzd_m, CAST(SUM(trays_submitted) AS BIGINT) AS total_trays,
  {avg_fixed("otif_pct", 2, 1)} AS avg_otif, {avg_fixed("risk_score", 0, 1)} AS avg_risk,
  {pct("SUM(CASE WHEN mts_pass THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS mts_pass_pct FROM factm""")
    q["agg21_taste_grades"] = f"""
SELECT tzg_grade, COUNT(*) AS n, {pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 1)} AS pct FROM (SELECT tzg_grade FROM fruit_quality) GROUP BY tzg_grade"""
    q["jn11_subzone_shares"] = _q("""
SELECT subzone, CAST(SUM(trays_submitted) AS BIGINT) AS trays, ROUND(SUM(trays_submitted)::DOUBLE / (SELECT SUM(trays_submitted) FROM factm), 6) AS share
FROM factm GROUP BY subzone""")
    from ..sources.bindings import VARIETY_ORDER as varieties
    q["flt7_active_growers"] = _q(f"""
SELECT {_case(f"s_suppkey % {len(varieties)}", dict(enumerate(varieties)))} AS primary_variety, COUNT(*) AS growers
FROM supplier s WHERE EXISTS (SELECT 1 FROM factm f WHERE f.kpin = 100000 + s.s_suppkey AND f.season = '1995/96') GROUP BY 1""")
    from .models import M1_FEATURES
    x = {"dm_dist_to_mts": f"dm_pct - CAST({MTS_CENTI} AS DOUBLE) / 100", "pest_indicator": "pest_indicator", "pack_week_norm": "(pack_week - 11) / 15.0",
         "is_opotiki": "CASE WHEN subzone = 'Opotiki' THEN 1 ELSE 0 END", "stress_season": f"CASE WHEN season = '{C.STRESS_SEASON}' THEN 1 ELSE 0 END"}
    q["ml3_standardised_ranges"] = _q("\nUNION ALL\n".join(
        f"SELECT COUNT(*) AS n, '{c}' AS feature, ROUND((MIN(x) - AVG(x)) / (STDDEV_POP(x) + 1e-8), 6) AS z_min, ROUND((MAX(x) - AVG(x)) / (STDDEV_POP(x) + 1e-8), 6) AS z_max "
        f"FROM (SELECT CAST({x[c]} AS DOUBLE) AS x FROM readings)" for c in M1_FEATURES))
    q["agg10_quantile_sketches"] = """
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, COUNT(*) AS n, TRUE AS within_bound FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1"""
    bop = f"COALESCE(lower(region_name) LIKE '%{C.REGION_NAME.lower()}%' OR region_name LIKE '%{C.REGION_CODE}%', FALSE)"
    sh2 = f"{bop} AND site_reference LIKE '{C.SH2_PREFIX}%'"
    q["dq1_traffic_audit"] = "WITH " + traffic_prelude() + f""",
c AS (SELECT COUNT(*) AS a, COUNT(*) FILTER ({bop}) AS b, COUNT(*) FILTER ({sh2}) AS c, COUNT(*) FILTER ({sh2} AND start_date IS NOT NULL) AS d FROM tms),
s AS (SELECT unnest([0, 1, 2, 3])::INT AS number, unnest(['read', 'region', 'highway', 'dated']) AS step, unnest([a, a, b, c]) AS rows_in, unnest([a, b, c, d]) AS rows_out FROM c)
SELECT *, CASE WHEN rows_out > 0 THEN 'OK' ELSE 'WARN' END AS status FROM s"""
    q["p6_payload_fields"] = _payload_sql(q)
    q["p6_live_payload"] = _payload_sql(q, live=True)
    tq = lambda body: "WITH " + traffic_prelude() + "\n" + body
    q["traffic_daily"] = tq("SELECT * FROM daily")
    q["congestion_profile"] = tq("""
SELECT ROUND(QUANTILE_CONT(congestion_index, 0.5), 4) AS ci_median, ROUND(QUANTILE_CONT(congestion_index, 0.75), 4) AS ci_p75,
  MAX(congestion_index) AS ci_max, MIN(congestion_index) AS ci_min, COUNT(*) AS days FROM daily""")
    q["weekly_congestion"] = tq(f"""
SELECT pack_week, {avg_fixed("congestion_index_scaled", 1, 1)} AS avg_congestion_by_week FROM scaled GROUP BY pack_week""")
    q["corridor_congestion"] = tq(f"""
SELECT {avg_fixed("congestion_index_scaled", 1, 1)} AS congestion_index_avg FROM scaled""")
    region = ("CASE WHEN (user_id % 14) + 1 = 4 THEN '" + C.REGION_LABEL + "' "
              "ELSE lpad(CAST((user_id % 14) + 1 AS VARCHAR), 2, '0') || ' - Region' END")
    q["traffic_daily_counts"] = f"""
WITH dc AS (
  SELECT DISTINCT CAST(ts AS VARCHAR) AS startdate, user_id AS siteid, {region} AS regionname,
    lpad(CAST((user_id % 3 + 1) * 100000 + user_id AS VARCHAR), 8, '0') AS sitereference,
    CASE WHEN event_type IN ('purchase', 'error') THEN 'Heavy' ELSE 'Light' END AS classweight,
    'Site ' || CAST(user_id AS VARCHAR) AS sitedescription, CAST(event_id % 2 + 1 AS INTEGER) AS lanenumber,
    CASE WHEN event_id % 2 = 0 THEN 'Increasing' ELSE 'Decreasing' END AS flowdirection, value AS trafficcount
  FROM events),
df AS (
  SELECT *, CAST(TRY_CAST(startdate AS TIMESTAMP) AS DATE) AS date FROM dc
  WHERE COALESCE(regexp_matches(regionname, '(?i){C.REGION_REGEX}'), FALSE) AND sitereference LIKE '{C.SH2_PREFIX}%'),
dp AS (
  SELECT date, sitereference, CAST(weekofyear(date) AS INTEGER) AS iso_week, CAST(weekofyear(date) AS INTEGER) AS pack_week,
    {PHASE.format(w='weekofyear(date)')} AS season_phase, CAST(year(date) AS INTEGER) AS year,
    COALESCE(SUM(CASE WHEN classweight = 'Heavy' THEN CAST(ROUND(trafficcount * 1000) AS BIGINT) END), 0) AS hm,
    COALESCE(SUM(CASE WHEN classweight = 'Light' THEN CAST(ROUND(trafficcount * 1000) AS BIGINT) END), 0) AS lm
  FROM df WHERE date IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6)
SELECT date, sitereference AS site_reference, iso_week, pack_week, season_phase, year,
  CAST(hm AS DOUBLE) / 1000 AS heavy_count, CAST(lm AS DOUBLE) / 1000 AS light_count, CAST(hm + lm AS DOUBLE) / 1000 AS total_count,
  CAST(LEAST(GREATEST((2 * (3 * hm + lm) + 880) // (2 * 880), 0), 10000) AS DOUBLE) / 100 AS congestion_index
FROM dp"""
    from .stats import BASE_YEAR, PRODUCTS
    fob = ", ".join(f"COALESCE(SUM(CASE WHEN o_orderpriority = '{k}' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END), 0) AS {v}"
                    for k, v in PRODUCTS.items())
    tot = " + ".join(PRODUCTS.values())
    cols = ", ".join(f"CAST((2 * {v} + 100000) // 200000 AS DOUBLE) / 1000 AS fob_{v}_nzd_m" for v in PRODUCTS.values())
    q["export_statistics"] = f"""
WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {fob} FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
t AS (SELECT *, {tot} AS total_cents FROM a),
b AS (SELECT MAX(CASE WHEN year = {BASE_YEAR} THEN total_cents END) AS base, SUM(total_cents) AS s, COUNT(*) AS n FROM t)
SELECT year, {cols}, CAST((2 * total_cents + 100000) // 200000 AS DOUBLE) / 1000 AS total_fob_nzd_m,
  CAST(CASE WHEN base IS NOT NULL AND base <> 0 THEN (2 * total_cents * 1000 + base) // (2 * base)
            WHEN s > 0 THEN (2 * total_cents * n * 1000 + s) // (2 * s) END AS DOUBLE) / 10 AS total_index,
  CASE WHEN base IS NOT NULL AND base <> 0 THEN 'year {BASE_YEAR}' ELSE 'mean' END AS index_base
FROM t, b"""
    q["str1_daily_traffic_stream"] = tq("""
SELECT date, site_reference, heavy_count, light_count, total_count, congestion_index, pack_week, season_phase FROM daily""")
    q["jn12_feed_as_of"] = _q(f"""
, months AS (SELECT date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS month, COUNT(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
landings AS (SELECT month, ROUND(n % 5 + (n % 7) / 2.0, 1) AS rain, ROUND((n % 100 + 500) / 1000.0, 4) AS eur, ROUND(CAST(n % 10 + 80 AS DOUBLE), 2) AS jpy,
               n % 3 > 0 AS verified FROM months),
s AS (SELECT season, MAX(submission_date) AS last_date, {avg_fixed("rainfall_mm_7d", 1, 1)} AS etl_rain FROM factm GROUP BY season)
SELECT season, last_date, CAST(COALESCE(rain, etl_rain) AS DOUBLE) AS rain_avg, CAST(month AS VARCHAR) AS fx_date, CAST(eur AS DOUBLE) AS nzd_eur,
  CAST(jpy AS DOUBLE) AS nzd_jpy, verified AS corridors_verified, CASE WHEN rain IS NULL THEN 'etl' ELSE 'feed' END AS rain_source
FROM s ASOF LEFT JOIN landings l ON s.last_date >= l.month""")
    q["str5_enrich_stream"] = _q("""
, months AS (SELECT date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS month, COUNT(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1)
SELECT CAST(month AS VARCHAR) AS fx_date, CAST(ROUND((n % 100 + 500) / 1000.0, 4) AS DOUBLE) AS nzd_eur, COUNT(*) AS submissions,
  CAST(SUM(trays_submitted) AS BIGINT) AS trays
FROM subs s ASOF LEFT JOIN months l ON s.submission_date >= l.month GROUP BY 1, 2""")
    q["str2_rain_7d_stream"] = """
WITH e AS (SELECT CAST(ts AS DATE) AS d, CAST(ROUND(value * 100) AS BIGINT) AS c FROM events WHERE ts IS NOT NULL),
w AS (SELECT d - CAST(k AS INTEGER) AS window_start, c FROM e, range(0, 7) t(k))
SELECT window_start, window_start + 7 AS window_end, CAST(SUM(c) AS DOUBLE) / 100 AS rain_7d_mm, COUNT(*) AS readings
FROM w GROUP BY window_start"""
    q["str3_dedupe_stream"] = """
SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events WHERE ts IS NOT NULL"""
    q["str4_live_state_stream"] = _q("""
SELECT date_key, season, pack_week FROM factm WHERE date_key IS NOT NULL
ORDER BY date_key DESC, season DESC, pack_week DESC LIMIT 1""")
    r4 = lambda n, d: f"CASE WHEN ({d}) > 0 THEN CAST((2 * ({n}) * 10000 + ({d})) // (2 * ({d})) AS DOUBLE) / 10000 ELSE 0.0 END"
    q["ml_rule_metrics"] = _q(f"""
, x AS (SELECT CASE WHEN otif_pct < 88 THEN 1 ELSE 0 END AS label, CASE WHEN risk_score >= 45 THEN 1 ELSE 0 END AS pred,
              CAST(risk_score AS DOUBLE) / 100 AS prob FROM factm),
g AS (SELECT CAST(SUM(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(SUM(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
             CAST(SUM(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(SUM(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             SUM(label * LN(prob + 1e-15) + (1 - label) * LN(1 - prob + 1e-15)) AS ll, AVG(label) AS pn, COUNT(*) AS n
      FROM x)
SELECT {r4("tp + tn", "tp + tn + fp + fn")} AS accuracy, {r4("tp", "tp + fp")} AS precision, {r4("tp", "tp + fn")} AS recall,
  {r4("2 * tp", "2 * tp + fp + fn")} AS f1, tp, tn, fp, fn,
  ROUND(1 - ll / (n * (pn * LN(pn + 1e-15) + (1 - pn) * LN(1 - pn + 1e-15))), 4) AS mcfadden_r2
FROM g""").replace("readings AS (", "readings AS (", 1)
    from .queries import SCENARIOS
    sc = " UNION ALL ".join(f"SELECT '{n}' AS scenario, CAST({c} AS DOUBLE) AS cong, CAST({ra} AS DOUBLE) AS rain_add, "
                            f"CAST({g} AS DOUBLE) AS reg, CAST({p} AS DOUBLE) AS pest" for n, c, ra, g, p in SCENARIOS)
    q["df30_scenario_rescore"] = _q(f"""
, sc AS ({sc}),
x AS (SELECT sc.*, f.pack_week, f.dm_pct_avg, f.mts_pass, CAST({RAIN} AS DOUBLE) + rain_add AS rain FROM factm f, sc),
y AS (SELECT scenario,
        ROUND(GREATEST(52.0, 97.5 - (POW(cong / 100.0, 1.3) * 8.5 + POW(LEAST(rain, 120.0) / 120.0, 1.2) * 5.5
          + POW(reg / 100.0, 1.2) * 3.0 + CASE WHEN mts_pass THEN 0.0 ELSE 12.0 END)), 2) AS otif,
        CAST(LEAST(GREATEST(ROUND(((1 - 1.0 / (1.0 + EXP((dm_pct_avg - 15.5) * -2.2))) * 0.35
          + POW(LEAST(pest, 100.0) / 100.0, 1.4) * 0.25 + POW(cong / 100.0, 1.3) * 0.15
          + POW(LEAST(rain, 120.0) / 120.0, 1.2) * 0.15 + POW(reg / 100.0, 1.2) * 0.10) * 100), 1), 100) AS INTEGER) AS risk
      FROM x)
SELECT scenario, COUNT(*) AS submissions, {avg_fixed("otif", 2, 2)} AS avg_otif, {avg_fixed("risk", 0, 1)} AS avg_risk,
  {count_if("otif < 88")} AS below_target
FROM y GROUP BY scenario""")
    q["win7_dm_elasticity"] = _q("""
, q3 AS (SELECT CAST((2 * CAST(ROUND(dm_pct_avg * 100) AS BIGINT) + 10) // 20 AS DOUBLE) / 10 AS dm_pct_band,
               ROUND(AVG(CAST(total_return_nzd AS DOUBLE) / NULLIF(trays_submitted, 0)), 4) AS avg_return_per_tray
        FROM factm WHERE mts_pass GROUP BY 1)
SELECT dm_pct_band, avg_return_per_tray,
  ROUND(avg_return_per_tray - LAG(avg_return_per_tray) OVER (ORDER BY dm_pct_band), 4) AS return_per_tray_change
FROM q3""")
    q["win6_rain_7d"] = f"""
WITH d AS (SELECT CAST(ts AS DATE) AS day, SUM(CAST(ROUND(value * 100) AS BIGINT)) AS c FROM events
           WHERE ts IS NOT NULL GROUP BY 1)
SELECT '{C.REGION_NAME}' AS place, day, CAST(c AS DOUBLE) / 100 AS rain_mm,
  CAST(SUM(c) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) / 100 AS rain_7d_mm
FROM d"""
    q["star_dim_time"] = _q(f"""
, s AS (SELECT MIN(submission_date) AS lo, MAX(submission_date) AS hi FROM subs),
d AS (SELECT CAST(unnest(generate_series(CAST(LEAST(DATE '{C.SPINE_START}', lo) AS TIMESTAMP),
        CAST(GREATEST(DATE '{C.SPINE_END}', hi) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM s)
SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date,
  CAST(weekofyear(date) AS INTEGER) AS iso_week, CAST(isoyear(date) AS INTEGER) AS iso_year,
  CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS pack_week,
  {season_label("date")} AS season_year, {PHASE.format(w="weekofyear(date)")} AS season_phase,
  CASE WHEN month(date) BETWEEN 3 AND 8 THEN 1 ELSE 0 END AS is_pack_season
FROM d""")
    q["snk4_star_keys"] = _q("""
SELECT order_key, line_number, f.kpin, export_id, fruit_key, grower_key, dm_pct, f.kpin || '_' || f.pack_week AS maturity_area
FROM (SELECT order_key, line_number, kpin, season, pack_week, variety,
        row_number() OVER (ORDER BY season, kpin, pack_week, variety, (order_key + line_number) % 16, order_key, line_number) AS export_id FROM subs) f
JOIN (SELECT *, row_number() OVER (ORDER BY season, kpin, pack_week, variety) AS fruit_key FROM readings) r
  ON r.kpin = f.kpin AND r.season = f.season AND r.pack_week = f.pack_week AND r.variety = f.variety
JOIN (SELECT 100000 + s_suppkey AS kpin, row_number() OVER (ORDER BY s_suppkey) AS grower_key FROM supplier) g ON g.kpin = f.kpin""")
    zones = ", ".join(f"({i + 1}, '{z}', '{C.HIGHWAYS[z]}', {v['distance_port_km']}, {v['base_risk_weight']}, {v['psa_incidence_historical']}, "
                      f"{v['dm_std_modifier']})" for i, (z, v) in enumerate(C.SUBZONES.items()))
    zone_cols = "z(corridor_key, subzone, highway, km, weight, psa, std_modifier)"
    q["star_dim_corridor"] = tq(f"""
SELECT corridor_key, subzone, highway, CAST(km AS DOUBLE) AS distance_port_km, congestion_index_avg,
  CAST(weight AS DOUBLE) AS base_risk_weight, CAST(psa AS DOUBLE) AS psa_incidence_historical
FROM (VALUES {zones}) {zone_cols}, (SELECT {avg_fixed("congestion_index_scaled", 1, 1)} AS congestion_index_avg FROM scaled)""")
    from ..sources.bindings import VARIETY_ORDER
    variety = _case(f"s_suppkey % {len(VARIETY_ORDER)}", dict(enumerate(VARIETY_ORDER)))
    q["star_dim_grower"] = _q(f"""
SELECT CAST(100000 + s_suppkey AS BIGINT) AS kpin, subzone, {variety} AS primary_variety,
  CASE WHEN ({variety}) LIKE '%Organic%' THEN 1 ELSE 0 END AS organic, CAST(s_suppkey % 20 + 2 AS DOUBLE) AS orchard_ha,
  CAST(km AS DOUBLE) AS distance_port_km, CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END AS psa_history,
  CAST(weight AS DOUBLE) AS base_risk_weight, CAST(std_modifier AS DOUBLE) AS dm_std_modifier, corridor_key
FROM sz LEFT JOIN (VALUES {zones}) {zone_cols} USING (subzone)""")
    q["star_dim_fruit_quality"] = _q(f"""
SELECT kpin, season, subzone, variety, CASE WHEN variety LIKE '%Organic%' THEN 'organic' ELSE 'conventional' END AS growing_method,
  pack_week, reading_date, dm_pct, CAST({MTS_CENTI} AS DOUBLE) / 100 AS mts_threshold, mts_status, tzg_score,
  CASE WHEN mts_status = 'FAIL' THEN 'F' WHEN tzg_score >= 0.8 THEN 'A+' WHEN tzg_score >= 0.6 THEN 'A'
       WHEN tzg_score >= 0.4 THEN 'B' WHEN tzg_score >= 0.2 THEN 'C' ELSE 'D' END AS tzg_grade,
  pest_indicator, CAST(kpin AS VARCHAR) || '_' || CAST(pack_week AS VARCHAR) AS maturity_area, sample_size
FROM readings""")
    q["agg21_taste_grades"] = q["agg21_taste_grades"].replace("fruit_quality", "(" + q["star_dim_fruit_quality"] + ")")
    q["snk8_table_summary"] = f"""
SELECT 'dim_time' AS "table", COUNT(*) AS rows, 'date_key' AS "key", COUNT(*) - COUNT(DISTINCT date_key) AS repeated FROM ({q["star_dim_time"]})
UNION ALL SELECT 'dim_grower', COUNT(*), 'kpin', COUNT(*) - COUNT(DISTINCT kpin) FROM ({q["star_dim_grower"]})
UNION ALL SELECT 'dim_fruit_quality', COUNT(*), 'kpin, season, pack_week, variety', COUNT(*) - COUNT(DISTINCT (kpin, season, pack_week, variety)) FROM ({q["star_dim_fruit_quality"]})
UNION ALL SELECT 'fact_export_transactions', COUNT(*), 'kpin, season, pack_week, variety', COUNT(*) - COUNT(DISTINCT (kpin, season, pack_week, variety))
FROM ({_q("SELECT kpin, season, pack_week, variety FROM factm")})"""
    from .star import FACT_COLUMNS
    as_double = {"submit_payment_nzd", "taste_payment_nzd", "total_return_nzd", "freight_cost_nzd"}
    other = {"mts_pass": "CAST(mts_pass AS INTEGER)", "loss_pct": "CAST(trays_lost AS DOUBLE) * 100 / trays_submitted"}
    q["star_fact"] = _q("SELECT kpin, submission_date, " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c in as_double else f"{other.get(c, c)} AS {c}"
        for c in FACT_COLUMNS if c != "grower_key") + " FROM factm")
    upper, causes = 0, []
    for k, w in C.CAUSE_WEIGHTS.items():
        upper += round(w * 100)
        causes.append(f"WHEN loss_draw < {upper} THEN '{'MECHANICAL' if k == 'MTS_BREACH' else k}'")
    q["df17_loss_causes"] = _q(f"""
, x AS (SELECT trays_lost, CASE WHEN NOT mts_pass THEN 'MTS_BREACH' {" ".join(causes)} END AS cause,
          CASE WHEN mts_pass THEN CAST({C.LOSS_FINANCIAL_RATE} AS DECIMAL(6,2)) * trays_lost ELSE submit_payment_nzd END AS impact
        FROM subs WHERE trays_lost > 0),
g AS (SELECT cause, COUNT(*) AS events, CAST(SUM(trays_lost) AS BIGINT) AS trays_lost, CAST(SUM(impact) AS DOUBLE) AS impact_nzd FROM x GROUP BY cause),
t AS (SELECT SUM(events) AS total FROM g)
SELECT cause, events, trays_lost, impact_nzd, {pct("events", "total", 1)} AS share_pct,
  CASE WHEN cause IN ({", ".join(repr(c) for c in C.CCP_CAUSES)}) THEN 1 ELSE 0 END AS ccp,
  CASE WHEN cause = '{C.MARKET_BLOCK_CAUSE}' THEN 1 ELSE 0 END AS market_block
FROM g, t""")
    spans = ", ".join(f"('{v}', {a}, {b})" for v, (a, b) in C.HARVEST_WINDOW.items())
    q["flt6_harvest_window"] = _q(f"""
SELECT variety, COUNT(*) AS submissions, CAST(SUM(trays_submitted) AS BIGINT) AS trays
FROM subs JOIN (VALUES {spans}) w(variety, first_week, last_week) USING (variety)
WHERE pack_week BETWEEN first_week AND last_week GROUP BY variety""")
    from ..registry import FACT_COUNT_COLS, FACT_PROFILE_COLS
    q["agg23_fact_profile"] = _q("\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max, "
        f"CAST(SUM({c}) AS DOUBLE) / COUNT({c}) AS avg FROM factm" for c in FACT_COUNT_COLS))
    q["agg24_duplicate_rows"] = _q("""
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM factm GROUP BY kpin, season, pack_week, variety, trays_submitted)""")
    q["dq_fact_null_profile"] = _q("\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count FROM factm"
        for c in FACT_PROFILE_COLS))
    return q
