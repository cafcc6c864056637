"""Independent DuckDB formulations of the registered queries (the correctness oracle).

``CTES`` holds named sub-queries (adapters, Silver, Gold, features, alerts)
written directly in DuckDB SQL; ``build(final, deps)`` prefixes a final SELECT
with the CTEs it needs in dependency order.
"""

from __future__ import annotations

from ..functions import constants as K

RUN_DATE = "1998-06-15"
RUN_DATE_KEY = 19980615
RUN_MONTH = 6
LO_30D = "1998-05-16"
LO_7D = "1998-06-09"
YESTERDAY = "1998-06-14"


def num(c: str) -> str:
    """coerce_numeric: unparsable / null -> 0.0 (strings ending in d/f/l rejected)."""
    return (f"COALESCE(CASE WHEN regexp_matches(lower(trim(CAST({c} AS VARCHAR))), '[dfl]$') THEN NULL "
            f"ELSE TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE) END, 0.0)")


def intg(c: str) -> str:
    return f"CAST(trunc({num(c)}) AS BIGINT)"


def ladder(col: str, pairs, otherwise, op=">=") -> str:
    parts = " ".join(f"WHEN {col} {op} {t} THEN {v}" for t, v in pairs)
    return f"CASE {parts} ELSE {otherwise} END"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STATUS = lambda c: ladder(c, [(90.0, q("CRITICAL")), (75.0, q("HIGH")), (40.0, q("NORMAL"))], q("LOW"))
FILLING = lambda c: (f"CASE WHEN {c} > 3.0 THEN 'FAST' WHEN {c} > 0.0 THEN 'MODERATE' "
                     f"WHEN {c} >= -1.0 THEN 'STABLE' ELSE 'DRAINING' END")
RAIN = lambda c: ladder(c, [(0.1, q("ไม่มีฝน")), (10.0, q("ฝนเล็กน้อย")), (35.0, q("ฝนปานกลาง")),
                            (90.0, q("ฝนหนัก"))], q("ฝนหนักมาก"), op="<")
WEATHER_PTS = lambda c: ladder(c, [(90.0, "35.0"), (35.0, "25.0"), (10.0, "15.0"), (1.0, "5.0")], "0.0")
ALERT = lambda c: ladder(c, [(75.0, q("วิกฤต")), (50.0, q("เตือนภัย")), (25.0, q("เฝ้าระวัง"))], q("ปกติ"))
LEVEL_EN = lambda c: (f"CASE {c} WHEN 'วิกฤต' THEN 'CRISIS' WHEN 'เตือนภัย' THEN 'ALERT' "
                      f"WHEN 'เฝ้าระวัง' THEN 'WATCH' ELSE 'NORMAL' END")
REGION = lambda c: (f"CASE WHEN {c} BETWEEN 10 AND 19 THEN 'C' WHEN {c} BETWEEN 20 AND 27 THEN 'E' "
                    f"WHEN {c} BETWEEN 30 AND 49 THEN 'NE' WHEN {c} BETWEEN 50 AND 69 THEN 'N' "
                    f"WHEN {c} BETWEEN 70 AND 79 THEN 'W' WHEN {c} BETWEEN 80 AND 99 THEN 'S' ELSE 'Unknown' END")
REGION_EN = lambda c: (f"CASE WHEN {c} BETWEEN 10 AND 19 THEN 'Central' WHEN {c} BETWEEN 20 AND 27 THEN 'Eastern' "
                       f"WHEN {c} BETWEEN 30 AND 49 THEN 'Northeastern' WHEN {c} BETWEEN 50 AND 69 THEN 'Northern' "
                       f"WHEN {c} BETWEEN 70 AND 79 THEN 'Western' WHEN {c} BETWEEN 80 AND 99 THEN 'Southern' "
                       f"ELSE 'Unknown' END")
MD5KEY = lambda k: f"md5({k})"
DKEY = lambda d: f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"
CLIP = lambda c: f"greatest(0.0, least(100.0, {c}))"
ROWSCORE = lambda s, f: (f"least(40.0, greatest(0.0, (CASE {s} WHEN 'CRITICAL' THEN 30.0 WHEN 'HIGH' THEN 18.0 "
                         f"WHEN 'NORMAL' THEN 5.0 WHEN 'LOW' THEN 0.0 ELSE 5.0 END) + (CASE {f} WHEN 'FAST' THEN 10.0 "
                         f"WHEN 'MODERATE' THEN 5.0 WHEN 'STABLE' THEN 0.0 WHEN 'DRAINING' THEN -5.0 ELSE 0.0 END)))")
DAY = lambda ts: f"strftime(CAST({ts} AS DATE), '%Y-%m-%d')"

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


cte("bronze_readings", [], f"""
SELECT l.l_orderkey * 8 + l.l_linenumber AS _offset,
  CASE WHEN l.l_returnflag = 'R' THEN 'dam' ELSE 'reservoir' END AS source,
  CASE WHEN l.l_orderkey % 97 = 0 THEN ' ' ELSE 'R' || lpad(CAST(s.s_suppkey AS VARCHAR), 5, '0') END AS reservoir_id,
  CASE WHEN l.l_orderkey % 89 = 0 THEN NULL ELSE 'dam ' || CAST(s.s_suppkey AS VARCHAR) || ' of ' || lower(n.n_name) END AS reservoir_name,
  CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE list_extract(['C','E','NE','N','W','S'], CAST(s.s_nationkey % 6 + 1 AS INTEGER)) END AS region,
  CASE WHEN s.s_suppkey % 5 = 0 THEN NULL ELSE 'owner ' || CAST(s.s_nationkey % 3 AS VARCHAR) END AS owner,
  CASE WHEN l.l_orderkey % 17 = 0 THEN 'n/a' WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE {DAY('l.l_shipdate')} END AS record_date,
  CASE WHEN s.s_acctbal < 0 THEN 'N/A' ELSE CAST(s.s_acctbal AS VARCHAR) END AS capacity_mcm,
  CAST(l.l_quantity * 100 AS VARCHAR) AS volume_mcm,
  CASE WHEN l.l_discount = 0 THEN '0' WHEN l.l_orderkey % 13 = 0 THEN 'N/A' ELSE CAST(l.l_quantity * 2 AS VARCHAR) END AS percent_storage,
  CAST(l.l_quantity / 4 AS VARCHAR) AS inflow_mcm,
  CAST(CAST(l.l_linenumber AS DOUBLE) AS VARCHAR) AS outflow_mcm,
  CAST(l.l_quantity * 80 AS VARCHAR) AS active_storage_mcm,
  CAST(CAST(l.l_linenumber * 10 AS DOUBLE) AS VARCHAR) AS dead_storage_mcm,
  CASE WHEN l.l_orderkey % 19 = 0 THEN NULL ELSE {DAY('l.l_shipdate')} || 'T' || lpad(CAST(l.l_linenumber AS VARCHAR), 2, '0') || ':00:00+07:00' END AS fetched_at,
  {DAY('l.l_shipdate')} AS dt
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""")

cte("silver_reservoir", ["bronze_readings"], f"""
SELECT reservoir_id, reservoir_name, region, source, owner, record_date, capacity_mcm, volume_mcm,
  {CLIP('CASE WHEN pct = 0 AND capacity_mcm > 0 THEN round(' + CLIP('volume_mcm / capacity_mcm * 100') + ', 2) ELSE pct END')} AS percent_storage,
  inflow_mcm, outflow_mcm, active_storage_mcm, dead_storage_mcm, fetched_at, dt
FROM (
  SELECT *, row_number() OVER (PARTITION BY reservoir_id, record_date, source, dt
                               ORDER BY fetched_at DESC NULLS LAST, _offset DESC) AS rn
  FROM (
    SELECT _offset, trim(COALESCE(reservoir_id, '')) AS reservoir_id,
      trim(COALESCE(reservoir_name, 'Unknown')) AS reservoir_name,
      COALESCE(NULLIF(trim(COALESCE(region, '')), ''), 'Unknown') AS region, source,
      trim(COALESCE(owner, 'กรมชลประทาน')) AS owner,
      COALESCE(TRY_CAST(record_date AS DATE), CAST(dt AS DATE)) AS record_date,
      {num('capacity_mcm')} AS capacity_mcm, {num('volume_mcm')} AS volume_mcm, {num('percent_storage')} AS pct,
      {num('inflow_mcm')} AS inflow_mcm, {num('outflow_mcm')} AS outflow_mcm,
      {num('active_storage_mcm')} AS active_storage_mcm, {num('dead_storage_mcm')} AS dead_storage_mcm,
      fetched_at, dt
    FROM bronze_readings) c
  WHERE reservoir_id <> '') d
WHERE rn = 1""")

cte("dim_reservoir", ["silver_reservoir"], f"""
SELECT {MD5KEY("reservoir_id || '_' || source")} AS reservoir_key, reservoir_id, max(reservoir_name) AS reservoir_name,
  max(region) AS region, max(owner) AS owner, source AS reservoir_type, max(capacity_mcm) AS capacity_mcm,
  max(dead_storage_mcm) AS dead_storage_mcm
FROM silver_reservoir GROUP BY reservoir_id, source""")

cte("dim_date", [], f"""
SELECT {DKEY('d')} AS date_key, d AS full_date, year(d) AS year, month(d) AS month,
  list_extract(['มกราคม','กุมภาพันธ์','มีนาคม','เมษายน','พฤษภาคม','มิถุนายน','กรกฎาคม','สิงหาคม','กันยายน','ตุลาคม','พฤศจิกายน','ธันวาคม'], month(d)) AS month_name_th,
  day(d) AS day, quarter(d) AS quarter, dayofweek(d) + 1 AS day_of_week, strftime(d, '%A') AS day_name_en,
  dayofweek(d) IN (0, 6) AS is_weekend, year(d) + 543 AS thai_year
FROM (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS d) t""")

cte("fact_water", ["silver_reservoir", "dim_reservoir"], f"""
SELECT {MD5KEY("sr.reservoir_id || '_' || CAST(sr.record_date AS VARCHAR) || '_' || sr.source")} AS fact_key,
  {DKEY('sr.record_date')} AS date_key, dr.reservoir_key, sr.record_date, sr.volume_mcm,
  CASE WHEN sr.percent_storage = 0 AND sr.capacity_mcm > 0 THEN round(sr.volume_mcm / sr.capacity_mcm * 100.0, 2)
       ELSE sr.percent_storage END AS percent_storage,
  sr.inflow_mcm, sr.outflow_mcm, sr.capacity_mcm AS storage_mcm, sr.active_storage_mcm, sr.dt
FROM silver_reservoir sr JOIN dim_reservoir dr ON sr.reservoir_id = dr.reservoir_id AND sr.source = dr.reservoir_type""")


def build(final: str, deps: list[str]) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + final


ORACLES: dict[str, str] = {}


def oracle(name: str, deps: list[str], final: str) -> None:
    ORACLES[name] = build(final, deps)


oracle("silver_reservoir", ["silver_reservoir"], "SELECT * FROM silver_reservoir")
oracle("dim_reservoir", ["dim_reservoir"], "SELECT * FROM dim_reservoir")
oracle("dim_date", ["dim_date", "silver_reservoir"],
       "SELECT * FROM dim_date WHERE full_date BETWEEN (SELECT min(record_date) FROM silver_reservoir) "
       "AND (SELECT max(record_date) FROM silver_reservoir)")
oracle("fact_water", ["fact_water"], "SELECT * FROM fact_water")
oracle("mart_30d_trend", ["fact_water", "dim_reservoir", "dim_date"], f"""
SELECT dr.reservoir_id, dr.reservoir_name, dr.reservoir_type, dr.region, round(dr.capacity_mcm, 2) AS capacity_mcm,
  dd.full_date, round(f.volume_mcm, 2) AS volume_mcm, round(f.percent_storage, 1) AS pct_storage,
  round(f.inflow_mcm, 2) AS inflow_mcm, round(f.outflow_mcm, 2) AS outflow_mcm,
  round(f.inflow_mcm - f.outflow_mcm, 2) AS net_flow_mcm,
  round(avg(f.percent_storage) OVER (PARTITION BY f.reservoir_key ORDER BY dd.full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 1) AS ma7_pct_storage,
  round(f.percent_storage - lag(f.percent_storage, 1) OVER (PARTITION BY f.reservoir_key ORDER BY dd.full_date), 2) AS daily_change_pct
FROM fact_water f JOIN dim_reservoir dr ON f.reservoir_key = dr.reservoir_key JOIN dim_date dd ON f.date_key = dd.date_key
WHERE dd.full_date >= DATE '{LO_30D}' AND dd.full_date <= DATE '{RUN_DATE}'
ORDER BY dr.reservoir_name, dd.full_date""")

# ---------------------------------------------------------------- weather / hazard / map

cte("bronze_weather", [], f"""
SELECT o.o_orderkey AS _offset,
  CASE WHEN o.o_orderkey % 53 = 0 THEN 'x' ELSE CAST(n.n_nationkey AS VARCHAR) END AS prov_code,
  'prov-' || CAST(n.n_nationkey AS VARCHAR) AS prov_th, n.n_name AS prov_en, r.r_name AS region,
  CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE {DAY('o.o_orderdate')} END AS forecast_date,
  CAST(CAST(30 + o.o_orderkey % 8 AS DOUBLE) AS VARCHAR) AS temp_max_c,
  CAST(CAST(20 + o.o_orderkey % 5 AS DOUBLE) AS VARCHAR) AS temp_min_c,
  CAST(rain AS VARCHAR) AS rainfall_forecast_mm, {RAIN('rain')} AS rain_intensity,
  CAST(CAST(50 + o.o_custkey % 50 AS DOUBLE) AS VARCHAR) AS humidity_pct,
  CAST((o.o_orderkey % 30) * 3.6::DOUBLE AS VARCHAR) AS wind_speed_kmh,
  CASE WHEN o.o_orderkey % 9 = 0 THEN NULL
       WHEN rain >= 35.0 THEN list_extract(['True', '1', ' yes ', 't'], CAST(o.o_orderkey % 4 + 1 AS INTEGER))
       ELSE list_extract(['False', '0', 'no', 'f'], CAST(o.o_orderkey % 4 + 1 AS INTEGER)) END AS is_heavy_rain_24h,
  CASE WHEN o.o_orderstatus = 'F' THEN 'tmd_api' ELSE 'mock_tmd' END AS data_source,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE {DAY('o.o_orderdate')} || 'T' || lpad(CAST(o.o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00+07:00' END AS generated_at,
  {DAY('o.o_orderdate')} AS dt
FROM (SELECT *, CAST(CAST(floor(o_totalprice) AS BIGINT) % 1200 AS DOUBLE) / 10.0::DOUBLE AS rain FROM orders) o
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("silver_weather", ["bronze_weather"], f"""
SELECT prov_code, prov_th, prov_en, region, forecast_date, temp_max_c, temp_min_c, rainfall_forecast_mm,
  rain_intensity, humidity_pct, wind_speed_kmh, is_heavy_rain_24h, data_source, dt
FROM (
  SELECT *, row_number() OVER (PARTITION BY prov_code, forecast_date, dt ORDER BY generated_at DESC NULLS LAST, _offset DESC) AS rn
  FROM (
    SELECT _offset, {intg('prov_code')} AS prov_code, trim(COALESCE(prov_th, '')) AS prov_th,
      trim(COALESCE(prov_en, '')) AS prov_en, trim(COALESCE(region, '')) AS region,
      COALESCE(TRY_CAST(forecast_date AS DATE), CAST(dt AS DATE)) AS forecast_date,
      {num('temp_max_c')} AS temp_max_c, {num('temp_min_c')} AS temp_min_c,
      {num('rainfall_forecast_mm')} AS rainfall_forecast_mm, trim(COALESCE(rain_intensity, '')) AS rain_intensity,
      {num('humidity_pct')} AS humidity_pct, {num('wind_speed_kmh')} AS wind_speed_kmh,
      COALESCE(lower(trim(is_heavy_rain_24h)) IN ('true', '1', 'yes', 't'), false) AS is_heavy_rain_24h,
      trim(COALESCE(data_source, '')) AS data_source, generated_at, dt
    FROM bronze_weather) c) d
WHERE rn = 1""")

cte("hazard", [], """
SELECT p_partkey AS _offset,
  CASE WHEN p_partkey % 37 = 0 THEN '' ELSE CAST(p_size % 12 + 1 AS VARCHAR) END AS "Month",
  CAST(p_partkey // 3 AS VARCHAR) AS "GEOCODE",
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE ' tambon ' || CAST(p_partkey // 3 AS VARCHAR) END AS "TAMBON_T",
  p_name AS "TAMBON_E", CAST(p_partkey // 30 AS VARCHAR) AS "AMPHOE_CODE",
  'amphoe ' || CAST(p_partkey // 30 AS VARCHAR) AS "AMPHOE_T", p_type AS "AMPHOE_E",
  CAST((p_partkey // 3) % 25 AS VARCHAR) AS "PROV_CODE", 'prov-' || CAST((p_partkey // 3) % 25 AS VARCHAR) AS "PROV_T",
  'NATION_' || CAST((p_partkey // 3) % 25 AS VARCHAR) AS "PROV_E", CAST(p_size % 18 AS VARCHAR) AS "COUNT 17 YEAR",
  p_brand AS "CRITERIA",
  CASE WHEN p_size <= 12 THEN 'เสี่ยงต่ำ' WHEN p_size <= 25 THEN 'เสี่ยงปานกลาง' WHEN p_size <= 37 THEN 'เสี่ยงสูง'
       WHEN p_size <= 48 THEN 'เสี่ยงสูงมาก' END AS "RISK"
FROM part""")

cte("silver_flood_risk", ["hazard"], f"""
SELECT geocode, month, tambon_th, tambon_en, amphoe_code, amphoe_th, amphoe_en, prov_code, prov_th, prov_en,
  flood_count_17yr, flood_criteria, risk_level,
  CAST(CASE risk_level WHEN 'เสี่ยงต่ำ' THEN 1 WHEN 'เสี่ยงปานกลาง' THEN 2 WHEN 'เสี่ยงสูง' THEN 3
       WHEN 'เสี่ยงสูงมาก' THEN 4 ELSE 0 END AS BIGINT) AS risk_score
FROM (
  SELECT *, row_number() OVER (PARTITION BY geocode, month ORDER BY geocode, month, _offset) AS rn
  FROM (
    SELECT _offset, {intg('"Month"')} AS month,
      CASE WHEN length("GEOCODE") < 6 THEN lpad("GEOCODE", 6, '0') ELSE "GEOCODE" END AS geocode,
      trim(COALESCE("TAMBON_T", '')) AS tambon_th, trim(COALESCE("TAMBON_E", '')) AS tambon_en,
      {intg('"AMPHOE_CODE"')} AS amphoe_code, "AMPHOE_T" AS amphoe_th, "AMPHOE_E" AS amphoe_en,
      {intg('"PROV_CODE"')} AS prov_code, "PROV_T" AS prov_th, "PROV_E" AS prov_en,
      {intg('"COUNT 17 YEAR"')} AS flood_count_17yr, "CRITERIA" AS flood_criteria,
      trim(COALESCE("RISK", 'ไม่ระบุ')) AS risk_level
    FROM hazard) c) d
WHERE rn = 1""")

cte("downstream_map", [], """
SELECT CASE WHEN n.n_nationkey = 0 THEN '' ELSE 'dam ' || CAST(n.n_nationkey AS VARCHAR) END AS reservoir_name_th,
  n.n_name AS reservoir_name_en, r.r_name AS river_basin_th, lower(r.r_name) AS river_basin_en,
  n.n_nationkey AS dam_province_code, 'prov-' || CAST(n.n_nationkey AS VARCHAR) AS dam_province_th,
  5.0::DOUBLE + n.n_nationkey * 0.5::DOUBLE AS lat, 97.0::DOUBLE + n.n_regionkey * 0.5::DOUBLE AS lon,
  c.codes || ', x,,' AS downstream_prov_codes, '' AS downstream_prov_th, n.n_nationkey * 100.0::DOUBLE AS capacity_mcm_ref,
  CASE WHEN n.n_nationkey % 2 = 0 THEN 'dam' ELSE 'reservoir' END AS source_type
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN (SELECT n_regionkey, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY CAST(n_nationkey AS VARCHAR)) AS codes
      FROM nation GROUP BY n_regionkey) c ON n.n_regionkey = c.n_regionkey""")

cte("map_edges", ["downstream_map"], """
SELECT map_id, CAST(trim(code) AS INTEGER) AS prov_code
FROM (SELECT reservoir_name_en AS map_id, unnest(string_split(downstream_prov_codes, ',')) AS code FROM downstream_map) t
WHERE regexp_full_match(trim(code), '[0-9]+')""")

cte("dim_location", ["silver_flood_risk"], f"""
SELECT TRY_CAST(geocode AS INTEGER) AS location_key, geocode, max(tambon_th) AS tambon_th, max(tambon_en) AS tambon_en,
  CAST(max(amphoe_code) AS INTEGER) AS amphoe_code, max(amphoe_th) AS amphoe_th, max(amphoe_en) AS amphoe_en,
  CAST(max(prov_code) AS INTEGER) AS prov_code, max(prov_th) AS prov_th, max(prov_en) AS prov_en,
  {REGION('CAST(max(prov_code) AS INTEGER)')} AS region
FROM silver_flood_risk GROUP BY geocode""")

cte("dim_weather", ["silver_weather"], f"""
SELECT CAST(prov_code AS INTEGER) AS weather_key, {DKEY('forecast_date')} AS date_key, CAST(prov_code AS INTEGER) AS prov_code,
  prov_th, prov_en, region, temp_max_c, temp_min_c, rainfall_forecast_mm, rain_intensity, humidity_pct,
  wind_speed_kmh, is_heavy_rain_24h, data_source, dt
FROM silver_weather WHERE dt = '{RUN_DATE}'""")

cte("fact_flood_risk", ["silver_flood_risk", "dim_location", "dim_weather"], f"""
SELECT {MD5KEY("sfr.geocode || '_' || CAST(sfr.month AS VARCHAR)")} AS fact_key,
  CAST(strftime(TRY_CAST('{RUN_DATE[:4]}-' || lpad(CAST(sfr.month AS VARCHAR), 2, '0') || '-01' AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
  dl.location_key, dw.weather_key, sfr.geocode, sfr.month AS risk_month, sfr.flood_count_17yr AS historical_flood_count,
  sfr.risk_level, sfr.risk_score, sfr.flood_criteria, dw.rainfall_forecast_mm AS rain_forecast_mm,
  dw.is_heavy_rain_24h AS is_heavy_rain_forecast, '{RUN_DATE}' AS dt
FROM silver_flood_risk sfr JOIN dim_location dl ON sfr.geocode = dl.geocode JOIN dim_weather dw ON dl.prov_code = dw.prov_code
WHERE sfr.month = {RUN_MONTH}""")

# ---------------------------------------------------------------- features / alerts

FEATURE_SELECT = f"""reservoir_id, reservoir_name, source, region, capacity_mcm, volume_mcm, percent_storage,
  inflow_mcm, outflow_mcm, inflow_mcm - outflow_mcm AS net_flow_mcm, storage_trend_7d,
  COALESCE(delta, 0.0) AS storage_delta_1d,
  CASE WHEN abs(inflow_mcm - outflow_mcm) >= 0.001 THEN greatest(-365.0, least(365.0, (capacity_mcm - volume_mcm) / (inflow_mcm - outflow_mcm))) END AS days_to_full,
  {STATUS('percent_storage')} AS reservoir_status, {FILLING('COALESCE(delta, 0.0)')} AS filling_rate"""

cte("feat_window", ["silver_reservoir"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY reservoir_id, source, dt ORDER BY record_date DESC NULLS LAST, fetched_at DESC NULLS LAST) AS rn
  FROM silver_reservoir WHERE dt BETWEEN '""" + LO_7D + "' AND '" + RUN_DATE + """') t WHERE rn = 1""")

cte("features", ["feat_window"], f"""
SELECT '{RUN_DATE}' AS feature_date, {FEATURE_SELECT}
FROM (
  SELECT t.*, t.percent_storage - y.pct_y AS delta, tr.storage_trend_7d
  FROM (SELECT * FROM feat_window WHERE record_date = (
          SELECT COALESCE(max(CASE WHEN record_date = DATE '{RUN_DATE}' THEN record_date END), max(record_date)) FROM feat_window)) t
  LEFT JOIN (SELECT reservoir_id, source, percent_storage AS pct_y FROM feat_window WHERE record_date = DATE '{YESTERDAY}') y
    ON t.reservoir_id = y.reservoir_id AND t.source = y.source
  LEFT JOIN (SELECT reservoir_id, source, avg(percent_storage) AS storage_trend_7d FROM feat_window GROUP BY 1, 2) tr
    ON t.reservoir_id = tr.reservoir_id AND t.source = tr.source) x""")

cte("features_daily", ["silver_reservoir"], f"""
SELECT dt AS feature_date, {FEATURE_SELECT}
FROM (
  SELECT *,
    CASE WHEN lag(_day) OVER w = _day - INTERVAL 1 DAY THEN percent_storage - lag(percent_storage) OVER w END AS delta,
    avg(percent_storage) OVER (PARTITION BY reservoir_id, source ORDER BY _day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS storage_trend_7d
  FROM (SELECT *, CAST(dt AS DATE) AS _day FROM (
          SELECT *, row_number() OVER (PARTITION BY reservoir_id, source, dt ORDER BY record_date DESC NULLS LAST, fetched_at DESC NULLS LAST) AS rn
          FROM silver_reservoir) a WHERE rn = 1) b
  WINDOW w AS (PARTITION BY reservoir_id, source ORDER BY _day)) x
WHERE record_date = _day""")

NAME_MATCH = """(
  (length(trim(m.reservoir_name_th)) > 0 AND length(trim(f.reservoir_name)) > 0 AND
   (contains(trim(f.reservoir_name), trim(m.reservoir_name_th)) OR contains(trim(m.reservoir_name_th), trim(f.reservoir_name))))
  OR
  (length(trim(m.reservoir_name_en)) > 0 AND length(trim(f.reservoir_name)) > 0 AND
   (contains(lower(trim(f.reservoir_name)), lower(trim(m.reservoir_name_en))) OR contains(lower(trim(m.reservoir_name_en)), lower(trim(f.reservoir_name))))))"""

cte("matched", ["features", "downstream_map", "map_edges"], f"""
SELECT DISTINCT e.prov_code, p.reservoir_id, p.source
FROM (SELECT DISTINCT f.reservoir_id, f.source, m.reservoir_name_en AS map_id FROM features f, downstream_map m WHERE {NAME_MATCH}) p
JOIN map_edges e ON p.map_id = e.map_id""")

cte("alerts", ["silver_weather", "silver_flood_risk", "features", "matched"], f"""
SELECT row_number() OVER (ORDER BY p.prov_code, p.prov_th) AS alert_key, {RUN_DATE_KEY} AS date_key, -1 AS location_key,
  -1 AS weather_key, DATE '{RUN_DATE}' AS alert_date, p.prov_code, p.prov_th,
  {ALERT('(r + w + h)')} AS alert_level, round(r + w + h, 2) AS alert_score, round(r, 2) AS reservoir_score,
  round(w, 2) AS weather_score, round(h, 2) AS historical_risk_score,
  COALESCE(triggers, '') AS trigger_reservoirs, COALESCE(statuses, '') AS trigger_reservoir_statuses,
  round(COALESCE(max_pct, 0.0), 2) AS max_reservoir_pct, round(COALESCE(rain, 0.0), 2) AS rainfall_forecast_mm,
  COALESCE(risk_level, 'เสี่ยงต่ำ') AS historical_risk_level, COALESCE(subd, 0) AS affected_subdistricts_count,
  '{RUN_DATE}' AS dt
FROM (
  SELECT p.prov_code, p.prov_th, COALESCE(res.reservoir_score, 0.0) AS r,
    {WEATHER_PTS('COALESCE(rn.rain, 0.0)')} AS w,
    CASE WHEN hi.max_risk IS NULL THEN 5.0
         ELSE CASE CAST(hi.max_risk AS INTEGER) WHEN 4 THEN 25.0 WHEN 3 THEN 18.0 WHEN 2 THEN 10.0 WHEN 1 THEN 5.0 ELSE 0.0 END END AS h,
    res.triggers, res.statuses, res.max_pct, rn.rain, hm.risk_level, hi.subd
  FROM (SELECT DISTINCT CAST(prov_code AS INTEGER) AS prov_code, prov_th FROM silver_weather WHERE dt = '{RUN_DATE}') p
  LEFT JOIN (
    SELECT prov_code, COALESCE(rainfall_forecast_mm, 0.0) AS rain FROM (
      SELECT CAST(prov_code AS INTEGER) AS prov_code, rainfall_forecast_mm,
        row_number() OVER (PARTITION BY CAST(prov_code AS INTEGER) ORDER BY forecast_date DESC NULLS LAST, prov_th, rainfall_forecast_mm DESC) AS k
      FROM silver_weather WHERE dt = '{RUN_DATE}') z WHERE k = 1) rn ON p.prov_code = rn.prov_code
  LEFT JOIN (
    SELECT prov_code, max(rscore) AS reservoir_score, max(percent_storage) AS max_pct,
      string_agg(reservoir_name, ',' ORDER BY rk) FILTER (WHERE rk <= 3) AS triggers,
      string_agg(reservoir_status, ',' ORDER BY rk) FILTER (WHERE rk <= 3) AS statuses
    FROM (
      SELECT m.prov_code, f.reservoir_name, f.reservoir_status, f.percent_storage, s.rscore,
        row_number() OVER (PARTITION BY m.prov_code ORDER BY s.rscore DESC, f.reservoir_name, f.reservoir_id, f.source) AS rk
      FROM matched m JOIN features f ON m.reservoir_id = f.reservoir_id AND m.source = f.source,
      LATERAL (SELECT {ROWSCORE('f.reservoir_status', 'f.filling_rate')} AS rscore) s) q
    GROUP BY prov_code) res ON p.prov_code = res.prov_code
  LEFT JOIN (
    SELECT CAST(prov_code AS INTEGER) AS prov_code, max(COALESCE(CAST(risk_score AS DOUBLE), 1.0)) AS max_risk,
      count(DISTINCT geocode) AS subd
    FROM silver_flood_risk WHERE month = {RUN_MONTH} GROUP BY 1) hi ON p.prov_code = hi.prov_code
  LEFT JOIN (
    SELECT prov_code, risk_level FROM (
      SELECT CAST(prov_code AS INTEGER) AS prov_code, risk_level,
        row_number() OVER (PARTITION BY CAST(prov_code AS INTEGER) ORDER BY count(*) DESC, risk_level) AS k
      FROM silver_flood_risk WHERE month = {RUN_MONTH} GROUP BY 1, 2) z WHERE k = 1) hm ON p.prov_code = hm.prov_code
) p""")

oracle("silver_weather", ["silver_weather"], "SELECT * FROM silver_weather")
oracle("silver_flood_risk", ["silver_flood_risk"], "SELECT * FROM silver_flood_risk")
oracle("dim_location", ["dim_location"], "SELECT * FROM dim_location")
oracle("dim_weather", ["dim_weather"], "SELECT * FROM dim_weather")
oracle("fact_flood_risk", ["fact_flood_risk"], "SELECT * FROM fact_flood_risk")
oracle("reservoir_features", ["features"], "SELECT * FROM features")
oracle("reservoir_features_daily", ["features_daily"], "SELECT * FROM features_daily")
oracle("match_upstream", ["matched"], "SELECT * FROM matched")
cte("part_map", [], """
SELECT CASE WHEN p_partkey % 2 = 1 THEN 'dam ' || CAST(p_partkey AS VARCHAR) || ' of' ELSE '' END AS reservoir_name_th,
  CASE WHEN p_partkey % 2 = 0 THEN 'DAM ' || CAST(p_partkey AS VARCHAR) || ' OF' END AS reservoir_name_en,
  CAST(p_size % 25 AS VARCHAR) || ',' || CAST(p_partkey % 25 AS VARCHAR) AS downstream_prov_codes FROM part""")
oracle("match_upstream_parts", ["features", "part_map"], f"""
SELECT DISTINCT CAST(unnest(string_split(m.downstream_prov_codes, ',')) AS INTEGER) AS prov_code, f.reservoir_id, f.source
FROM features f, part_map m WHERE {NAME_MATCH}""")
oracle("fact_flood_alert", ["alerts"], "SELECT * FROM alerts")

oracle("mart_hot_reservoirs", ["fact_water", "dim_reservoir", "dim_date", "dim_location", "dim_weather"], f"""
SELECT dl.prov_th, dl.prov_en, dl.region, COUNT(DISTINCT dr.reservoir_id) AS hot_reservoirs,
  round(avg(f.percent_storage), 1) AS avg_pct_storage, round(max(f.percent_storage), 1) AS max_pct_storage,
  round(dw.rainfall_forecast_mm, 1) AS rain_forecast_mm, dw.rain_intensity, dd.full_date AS data_date
FROM fact_water f JOIN dim_reservoir dr ON f.reservoir_key = dr.reservoir_key JOIN dim_date dd ON f.date_key = dd.date_key
JOIN dim_location dl ON dr.region = dl.region
JOIN dim_weather dw ON dl.prov_code = dw.prov_code AND f.date_key = dw.date_key
WHERE f.percent_storage > 80 AND dw.is_heavy_rain_24h = TRUE AND f.dt = '{RUN_DATE}'
GROUP BY dl.prov_th, dl.prov_en, dl.region, dw.rainfall_forecast_mm, dw.rain_intensity, dd.full_date""")

_TEXT_TO_CODE = " ".join(f"WHEN '{text}' THEN '{code}'" for text, code in K.REGION_TEXT_TO_CODE.items())
_CODE_TO_TEXT = " ".join(f"WHEN '{code}' THEN '{text}'" for text, code in K.REGION_TEXT_TO_CODE.items())
oracle("mart_hot_reservoirs_crosswalk", ["fact_water", "dim_reservoir", "dim_date", "dim_location", "dim_weather"], f"""
SELECT dl.prov_th, dl.prov_en, dl.region, COUNT(DISTINCT dr.reservoir_id) AS hot_reservoirs,
  round(avg(f.percent_storage), 1) AS avg_pct_storage, round(max(f.percent_storage), 1) AS max_pct_storage,
  round(dw.rainfall_forecast_mm, 1) AS rain_forecast_mm, dw.rain_intensity, dd.full_date AS data_date
FROM fact_water f
JOIN (SELECT reservoir_key, reservoir_id, CASE region {_CODE_TO_TEXT} ELSE region END AS region_th FROM dim_reservoir) dr
  ON f.reservoir_key = dr.reservoir_key
JOIN dim_date dd ON f.date_key = dd.date_key
JOIN dim_location dl ON CASE dr.region_th {_TEXT_TO_CODE} ELSE 'Unknown' END = dl.region
JOIN dim_weather dw ON dl.prov_code = dw.prov_code AND f.date_key = dw.date_key
WHERE f.percent_storage > 80 AND dw.is_heavy_rain_24h = TRUE AND f.dt = '{RUN_DATE}'
GROUP BY dl.prov_th, dl.prov_en, dl.region, dw.rainfall_forecast_mm, dw.rain_intensity, dd.full_date""")

oracle("mart_top10_subdistricts", ["fact_flood_risk", "dim_location", "dim_weather"], f"""
SELECT dl.geocode, dl.tambon_th, dl.amphoe_th, dl.prov_th, dl.region, max(ffr.historical_flood_count) AS flood_count_17yr,
  ffr.risk_level, ffr.flood_criteria, round(avg(dw.rainfall_forecast_mm), 1) AS avg_rain_forecast_mm
FROM fact_flood_risk ffr JOIN dim_location dl ON ffr.location_key = dl.location_key
JOIN dim_weather dw ON dl.prov_code = dw.prov_code
LEFT JOIN (SELECT prov_code, is_heavy_rain_24h FROM dim_weather WHERE date_key = {RUN_DATE_KEY}) lw ON dl.prov_code = lw.prov_code
GROUP BY dl.geocode, dl.tambon_th, dl.amphoe_th, dl.prov_th, dl.region, ffr.risk_level, ffr.flood_criteria
ORDER BY flood_count_17yr DESC, dl.geocode, ffr.risk_level, ffr.flood_criteria LIMIT 10""")

oracle("view_level_summary", ["alerts"], f"""
SELECT alert_level_en, count(*) AS province_count,
  CASE alert_level_en WHEN 'CRISIS' THEN 1 WHEN 'ALERT' THEN 2 WHEN 'WATCH' THEN 3 WHEN 'NORMAL' THEN 4 ELSE 5 END AS level_order
FROM (SELECT {LEVEL_EN('alert_level')} AS alert_level_en FROM alerts) a GROUP BY alert_level_en""")

oracle("view_score_breakdown", ["alerts"], f"""
SELECT prov_code, prov_th, alert_score, alert_level_en, component, points FROM (
  SELECT *, {LEVEL_EN('alert_level')} AS alert_level_en FROM alerts) a
UNPIVOT (points FOR component IN (reservoir_score, weather_score, historical_risk_score))
WHERE alert_level_en <> 'NORMAL'""")

oracle("view_region_slice", ["alerts"], f"""
SELECT * EXCLUDE (dt), dt, {LEVEL_EN('alert_level')} AS alert_level_en, {REGION_EN('prov_code')} AS region_en
FROM alerts WHERE alert_date = DATE '{RUN_DATE}'""")

oracle("view_top_alerts", ["alerts"], "SELECT * FROM alerts ORDER BY alert_score DESC, prov_code LIMIT 10")

# ---------------------------------------------------------------- data quality / exports / aggregates

cte("staged", ["bronze_readings"], f"""
SELECT _offset, reservoir_id, reservoir_name, region, source, owner, record_date, capacity_mcm, volume_mcm,
  {CLIP('CASE WHEN pct = 0 AND capacity_mcm > 0 THEN round(' + CLIP('volume_mcm / capacity_mcm * 100') + ', 2) ELSE pct END')} AS percent_storage,
  inflow_mcm, outflow_mcm, active_storage_mcm, dead_storage_mcm, fetched_at, dt
FROM (
  SELECT _offset, trim(COALESCE(reservoir_id, '')) AS reservoir_id, trim(COALESCE(reservoir_name, 'Unknown')) AS reservoir_name,
    COALESCE(NULLIF(trim(COALESCE(region, '')), ''), 'Unknown') AS region, source,
    trim(COALESCE(owner, 'กรมชลประทาน')) AS owner, COALESCE(TRY_CAST(record_date AS DATE), CAST(dt AS DATE)) AS record_date,
    {num('capacity_mcm')} AS capacity_mcm, {num('volume_mcm')} AS volume_mcm, {num('percent_storage')} AS pct,
    {num('inflow_mcm')} AS inflow_mcm, {num('outflow_mcm')} AS outflow_mcm,
    {num('active_storage_mcm')} AS active_storage_mcm, {num('dead_storage_mcm')} AS dead_storage_mcm, fetched_at, dt
  FROM bronze_readings) c
WHERE reservoir_id <> ''""")

cte("province_catalogue", [], """
SELECT n.n_nationkey AS prov_code, 'prov-' || CAST(n.n_nationkey AS VARCHAR) AS prov_th, n.n_name AS prov_en,
  r.r_name AS region, 5.0::DOUBLE + n.n_nationkey * 0.5::DOUBLE AS lat, 97.0::DOUBLE + n.n_regionkey * 0.5::DOUBLE AS lon
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

_DQ_RULES = [
    ("NULL_CHECK:reservoir_id", True, "reservoir_id IS NULL OR trim(CAST(reservoir_id AS VARCHAR)) = ''"),
    ("NULL_CHECK:record_date", True, "record_date IS NULL OR trim(CAST(record_date AS VARCHAR)) = ''"),
    ("NULL_CHECK:percent_storage", True, "percent_storage IS NULL OR trim(CAST(percent_storage AS VARCHAR)) = ''"),
    ("RANGE_CHECK:percent_storage[0.0,100.0]", True, "percent_storage < 0.0 OR percent_storage > 100.0"),
    ("RANGE_CHECK:volume_mcm[0.0,99999.0]", True, "volume_mcm < 0.0 OR volume_mcm > 99999.0"),
    ("RANGE_CHECK:inflow_mcm[-10.0,9999.0]", False, "inflow_mcm < -10.0 OR inflow_mcm > 9999.0"),
    ("RANGE_CHECK:outflow_mcm[-10.0,9999.0]", False, "outflow_mcm < -10.0 OR outflow_mcm > 9999.0"),
]


def dq_rows(src: str, table: str, by_dt: bool) -> str:
    """DQ result rows over CTE ``src`` (per dt or whole)."""
    g = "dt" if by_dt else "1"
    gsel = "dt, " if by_dt else ""
    gby = "GROUP BY dt" if by_dt else ""
    fails = ", ".join(f"count_if({c}) AS f{i}" for i, (_, _, c) in enumerate(_DQ_RULES))
    parts = []
    for i, (name, crit, _) in enumerate(_DQ_RULES):
        st = "'FAIL'" if crit else "'WARN'"
        parts.append(f"SELECT {gsel}'{name}' AS rule, '{table}' AS \"table\", CASE WHEN f{i} = 0 THEN 'PASS' ELSE {st} END AS status, "
                     f"{str(crit).upper()} AS critical, total AS total_rows, f{i} AS failed_rows, "
                     f"round(100.0 * (1.0 - CAST(f{i} AS DOUBLE) / greatest(total, 1)), 2) AS pass_rate_pct, "
                     f"CASE WHEN f{i} > 0 THEN 'UNCHECKED' ELSE '' END AS details FROM base")
    parts.append(f"SELECT {gsel}'DUPLICATE_CHECK:(reservoir_id, record_date, source)' AS rule, '{table}' AS \"table\", "
                 "CASE WHEN COALESCE(dup, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, TRUE AS critical, total AS total_rows, "
                 "COALESCE(dup, 0) AS failed_rows, round(100.0 * (1.0 - CAST(COALESCE(dup, 0) AS DOUBLE) / greatest(total, 1)), 2) AS pass_rate_pct, "
                 "CASE WHEN COALESCE(dup, 0) > 0 THEN 'Duplicate key examples: [' || array_to_string(list_transform(samp, lambda x: '''' || x || ''''), ', ') || ']' ELSE '' END AS details "
                 "FROM base")
    dsum_join = "LEFT JOIN dsum d ON b.dt = d.dt" if by_dt else "CROSS JOIN (SELECT sum(dup) AS dup, max(samp) AS samp FROM dsum) d"
    return f"""(WITH b0 AS (SELECT {gsel}count(*) AS total, {fails} FROM {src} {gby} HAVING count(*) > 0),
  dups AS (SELECT {gsel}reservoir_id || '|' || CAST(record_date AS VARCHAR) || '|' || source AS k, count(*) AS n
           FROM {src} GROUP BY {gsel}reservoir_id, record_date, source HAVING count(*) > 1),
  dsum AS (SELECT {gsel}sum(n) AS dup, list(k ORDER BY k) FILTER (WHERE r <= 3) AS samp
           FROM (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY k) AS r FROM dups) z {gby}),
  base AS (SELECT b.*, d.dup, d.samp FROM b0 b {dsum_join})
  {' UNION ALL '.join(parts)})"""


cte("dq_staged", ["staged"], "SELECT * FROM " + dq_rows("staged", "staged_reservoir", True) + " q")
cte("dq_silver", ["silver_reservoir"], "SELECT * FROM " + dq_rows("silver_reservoir", "silver_reservoir", True) + " q")
cte("staged_day", ["staged"], f"SELECT * FROM staged WHERE dt = '{RUN_DATE}'")
cte("silver_day", ["silver_reservoir"], f"SELECT * FROM silver_reservoir WHERE dt = '{RUN_DATE}'")
cte("dq_day", ["staged_day"], "SELECT * FROM " + dq_rows("staged_day", "staged_reservoir", False) + " q")
cte("dq_silver_day", ["silver_day"], "SELECT * FROM " + dq_rows("silver_day", "silver_reservoir", False) + " q")

oracle("dq_report_staged", ["dq_staged"], "SELECT * FROM dq_staged")
oracle("dq_report_silver", ["dq_silver"], "SELECT * FROM dq_silver")
oracle("dq_report_day", ["dq_day"], "SELECT * FROM dq_day")
oracle("dq_summary", ["dq_staged"], """
SELECT dt, count_if(status = 'PASS') AS passed, count_if(status = 'WARN') AS warned, count_if(status = 'FAIL') AS failed,
  count(*) AS total_checks, CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS overall
FROM dq_staged GROUP BY dt""")

oracle("dbt_not_null", ["silver_reservoir", "silver_flood_risk", "silver_weather"], """
SELECT "table", column_name, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT 'silver_reservoir' AS "table", 'reservoir_id' AS column_name, count_if(reservoir_id IS NULL) AS failures FROM silver_reservoir
  UNION ALL SELECT 'silver_reservoir', 'record_date', count_if(record_date IS NULL) FROM silver_reservoir
  UNION ALL SELECT 'silver_reservoir', 'percent_storage', count_if(percent_storage IS NULL) FROM silver_reservoir
  UNION ALL SELECT 'silver_flood_risk', 'geocode', count_if(geocode IS NULL) FROM silver_flood_risk
  UNION ALL SELECT 'silver_flood_risk', 'month', count_if(month IS NULL) FROM silver_flood_risk
  UNION ALL SELECT 'silver_weather', 'prov_code', count_if(prov_code IS NULL) FROM silver_weather
  UNION ALL SELECT 'silver_weather', 'forecast_date', count_if(forecast_date IS NULL) FROM silver_weather) t""")

oracle("flag_duplicates", ["staged"], """
SELECT reservoir_id, record_date, source, dt, _offset,
  count(*) OVER (PARTITION BY reservoir_id, record_date, source, dt) > 1 AS is_duplicate FROM staged""")

EXPORT_PCT = (f"CASE WHEN (s.percent_storage IS NULL OR s.percent_storage = 0) AND s.capacity_mcm > 0 "
              f"THEN round({CLIP('s.volume_mcm / s.capacity_mcm * 100.0')}, 1) ELSE s.percent_storage END")

cte("export_reservoirs", ["silver_reservoir", "features"], f"""
SELECT s.reservoir_id, s.reservoir_name, s.source, s.region, s.record_date, s.capacity_mcm, s.volume_mcm,
  {EXPORT_PCT} AS percent_storage, s.inflow_mcm, s.outflow_mcm, f.net_flow_mcm, f.storage_trend_7d, f.storage_delta_1d,
  f.days_to_full, CASE WHEN ({EXPORT_PCT}) IS NULL THEN 'NORMAL' ELSE {STATUS('(' + EXPORT_PCT + ')')} END AS reservoir_status,
  f.filling_rate
FROM silver_reservoir s LEFT JOIN features f ON s.reservoir_id = f.reservoir_id AND s.source = f.source
WHERE s.dt = '{RUN_DATE}'""")

ALERT_EXPORT_GOLD = """SELECT alert_date, COALESCE(CAST(prov_code AS INTEGER), 0) AS prov_code, COALESCE(prov_th, '') AS prov_th,
  COALESCE(alert_level, 'ปกติ') AS alert_level, round(COALESCE(alert_score, 0.0), 1) AS alert_score,
  round(COALESCE(reservoir_score, 0.0), 1) AS reservoir_score, round(COALESCE(weather_score, 0.0), 1) AS weather_score,
  round(COALESCE(historical_risk_score, 0.0), 1) AS historical_risk_score, COALESCE(trigger_reservoirs, '') AS trigger_reservoirs,
  round(COALESCE(max_reservoir_pct, 0.0), 1) AS max_reservoir_pct, round(COALESCE(rainfall_forecast_mm, 0.0), 1) AS rainfall_forecast_mm,
  COALESCE(historical_risk_level, '') AS historical_risk_level,
  COALESCE(CAST(affected_subdistricts_count AS BIGINT), 0) AS affected_subdistricts_count"""

ALERT_EXPORT_WX = f"""SELECT forecast_date AS alert_date, COALESCE(CAST(prov_code AS INTEGER), 0) AS prov_code,
  COALESCE(prov_th, '') AS prov_th, {ALERT('w')} AS alert_level, round(w, 1) AS alert_score, 0.0 AS reservoir_score,
  w AS weather_score, 0.0 AS historical_risk_score, '' AS trigger_reservoirs, 0.0 AS max_reservoir_pct,
  round(rain, 1) AS rainfall_forecast_mm, '' AS historical_risk_level, CAST(0 AS BIGINT) AS affected_subdistricts_count
FROM (SELECT *, {WEATHER_PTS('rain')} AS w FROM (SELECT *, COALESCE(CAST(rainfall_forecast_mm AS DOUBLE), 0.0) AS rain
      FROM silver_weather WHERE dt = '{RUN_DATE}') a) b"""

cte("export_alerts", ["alerts", "silver_weather"], f"""
{ALERT_EXPORT_GOLD} FROM alerts
UNION ALL
SELECT * FROM ({ALERT_EXPORT_WX}) z WHERE NOT EXISTS (SELECT 1 FROM alerts)""")

oracle("export_reservoirs", ["export_reservoirs"], "SELECT * FROM export_reservoirs")
oracle("export_reservoirs_csv", ["export_reservoirs"],
       "SELECT * REPLACE (CASE WHEN abs(days_to_full) < 365.0 THEN days_to_full END AS days_to_full) FROM export_reservoirs")
oracle("export_alerts", ["export_alerts"], "SELECT * FROM export_alerts")
oracle("export_alerts_fallback", ["silver_weather"], ALERT_EXPORT_WX)
oracle("export_alerts_csv", ["export_alerts", "province_catalogue"], f"""
SELECT a.alert_date, a.prov_code, a.prov_th, a.alert_level, {LEVEL_EN('a.alert_level')} AS alert_level_en, a.alert_score,
  a.reservoir_score, a.weather_score, a.historical_risk_score, a.trigger_reservoirs, a.max_reservoir_pct,
  a.rainfall_forecast_mm, a.historical_risk_level, a.affected_subdistricts_count, p.lat, p.lon,
  {REGION_EN('a.prov_code')} AS region_en
FROM export_alerts a LEFT JOIN province_catalogue p ON a.prov_th = p.prov_th""")

oracle("export_meta_row", ["export_reservoirs", "export_alerts", "dq_silver_day"], f"""
SELECT '{RUN_DATE}' AS export_date, r.reservoir_count, r.latest_record_date, n.alert_province_count,
  a.alert_crisis, a.alert_warning, a.alert_watch, a.alert_normal, q.dq_overall, q.dq_passed, q.dq_total
FROM (SELECT count(*) AS reservoir_count, max(record_date) AS latest_record_date FROM export_reservoirs) r,
  (SELECT count(*) AS alert_province_count FROM export_alerts) n,
  (SELECT count_if(alert_level = 'วิกฤต') AS alert_crisis, count_if(alert_level = 'เตือนภัย') AS alert_warning,
          count_if(alert_level = 'เฝ้าระวัง') AS alert_watch, count_if(alert_level = 'ปกติ') AS alert_normal FROM export_alerts) a,
  (SELECT CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS dq_overall,
          count_if(status = 'PASS') AS dq_passed, count(*) AS dq_total FROM dq_silver_day) q""")

oracle("agg_value_counts", ["features_daily"], "SELECT reservoir_status, count(*) AS n FROM features_daily GROUP BY 1")
oracle("agg_pivot_counts", ["silver_weather"], f"""
SELECT forecast_date AS alert_date, count_if(lvl = 'วิกฤต') AS alert_crisis, count_if(lvl = 'เตือนภัย') AS alert_warning,
  count_if(lvl = 'เฝ้าระวัง') AS alert_watch, count_if(lvl = 'ปกติ') AS alert_normal
FROM (SELECT forecast_date, {ALERT(WEATHER_PTS('COALESCE(rainfall_forecast_mm, 0.0)'))} AS lvl FROM silver_weather) t
GROUP BY forecast_date""")
oracle("agg_profile", ["silver_reservoir"], """
SELECT count(*) AS row_count, count_if(reservoir_id IS NULL) AS nulls_reservoir_id, count_if(record_date IS NULL) AS nulls_record_date,
  count_if(percent_storage IS NULL) AS nulls_percent_storage, count_if(capacity_mcm IS NULL) AS nulls_capacity_mcm,
  min(percent_storage) AS min_percent_storage, max(percent_storage) AS max_percent_storage,
  avg(percent_storage) AS mean_percent_storage, count_if(percent_storage = 0) AS zeros_percent_storage
FROM silver_reservoir""")
oracle("agg_profile_weather", ["silver_weather"], """
SELECT count(*) AS row_count, count_if(prov_code IS NULL) AS nulls_prov_code, count_if(forecast_date IS NULL) AS nulls_forecast_date,
  count_if(rainfall_forecast_mm IS NULL) AS nulls_rainfall_forecast_mm, min(rainfall_forecast_mm) AS min_rainfall_forecast_mm,
  max(rainfall_forecast_mm) AS max_rainfall_forecast_mm, avg(rainfall_forecast_mm) AS mean_rainfall_forecast_mm,
  count_if(is_heavy_rain_24h) AS true_is_heavy_rain_24h
FROM silver_weather""")
oracle("agg_count_by_partition", ["silver_reservoir"], "SELECT dt, count(*) AS row_count FROM silver_reservoir GROUP BY dt ORDER BY dt DESC")
oracle("agg_province_risk", ["silver_flood_risk"], f"""
SELECT h.prov_code, h.max_risk_score, m.risk_level, h.subdistrict_count FROM
 (SELECT CAST(prov_code AS INTEGER) AS prov_code, max(COALESCE(CAST(risk_score AS DOUBLE), 1.0)) AS max_risk_score,
         count(DISTINCT geocode) AS subdistrict_count FROM silver_flood_risk WHERE month = {RUN_MONTH} GROUP BY 1) h
 JOIN (SELECT prov_code, risk_level FROM (
         SELECT CAST(prov_code AS INTEGER) AS prov_code, risk_level,
           row_number() OVER (PARTITION BY CAST(prov_code AS INTEGER) ORDER BY count(*) DESC, risk_level) AS k
         FROM silver_flood_risk WHERE month = {RUN_MONTH} GROUP BY 1, 2) z WHERE k = 1) m ON h.prov_code = m.prov_code""")
oracle("distinct_pairs", ["silver_weather"], "SELECT DISTINCT prov_code, prov_th FROM silver_weather")
oracle("union_distinct_dates", ["silver_reservoir", "silver_weather"], f"""
SELECT DISTINCT dt FROM (SELECT dt FROM silver_reservoir UNION ALL SELECT dt FROM silver_weather UNION ALL SELECT '{RUN_DATE}') t
WHERE TRY_CAST(dt AS DATE) IS NOT NULL AND regexp_full_match(dt, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') ORDER BY dt""")
oracle("fallback_per_key", ["silver_weather", "province_catalogue"], f"""
SELECT COALESCE(p.prov_code, s.prov_code) AS prov_code,
  CASE WHEN p.prov_code IS NOT NULL THEN p.rainfall_forecast_mm ELSE s.rainfall_forecast_mm END AS rainfall_forecast_mm,
  CASE WHEN p.prov_code IS NOT NULL THEN p.temp_max_c ELSE s.temp_max_c END AS temp_max_c,
  CASE WHEN p.prov_code IS NOT NULL THEN 'tmd_api' ELSE 'mock_tmd' END AS data_source
FROM (SELECT CAST(prov_code AS INTEGER) AS prov_code, rainfall_forecast_mm, temp_max_c FROM silver_weather WHERE dt = '{RUN_DATE}') p
FULL JOIN (SELECT CAST(prov_code AS INTEGER) AS prov_code, lat * 2.0::DOUBLE AS rainfall_forecast_mm, 30.0::DOUBLE AS temp_max_c
           FROM province_catalogue) s ON p.prov_code = s.prov_code""")

_DELTA = "(inflow_mcm - outflow_mcm)"
_DTF = f"CASE WHEN abs({_DELTA}) >= 0.001 THEN greatest(-365.0, least(365.0, (capacity_mcm - volume_mcm) / {_DELTA})) END"
_RCODE = "(CAST(substring(reservoir_id, 4, 3) AS INTEGER) % 100)"
oracle("fn_classify_battery", ["silver_reservoir"], f"""
SELECT reservoir_id, source, record_date, dt, {STATUS('percent_storage')} AS status, {FILLING(_DELTA)} AS filling,
  {RAIN('(volume_mcm / 50.0)')} AS rain_label, {WEATHER_PTS('(volume_mcm / 50.0)')} AS weather_pts,
  CASE CAST(trunc(fmod(dead_storage_mcm / 10.0, 5.0)) AS INTEGER) WHEN 4 THEN 25.0 WHEN 3 THEN 18.0 WHEN 2 THEN 10.0 WHEN 1 THEN 5.0 ELSE 0.0 END AS hist_pts,
  {ROWSCORE(STATUS('percent_storage'), FILLING(_DELTA))} AS row_score,
  {ALERT('percent_storage')} AS level, {LEVEL_EN(ALERT('percent_storage'))} AS level_en,
  {_DTF} AS days_to_full, CASE WHEN abs({_DTF}) < 365.0 THEN {_DTF} END AS days_to_full_csv,
  {REGION(_RCODE)} AS region_code, {REGION_EN(_RCODE)} AS region_en,
  CASE WHEN trim(region) IN ('C', 'E', 'NE', 'N', 'W', 'S') THEN trim(region) WHEN trim(region) = 'ภาคกลาง' THEN 'C'
       WHEN trim(region) = 'ภาคตะวันออก' THEN 'E' WHEN trim(region) = 'ภาคตะวันออกเฉียงเหนือ' THEN 'NE'
       WHEN trim(region) = 'ภาคเหนือ' THEN 'N' WHEN trim(region) = 'ภาคตะวันตก' THEN 'W' WHEN trim(region) = 'ภาคใต้' THEN 'S'
       ELSE 'Unknown' END AS region_norm
FROM silver_reservoir""")

_PAD_SRC = "CAST(TRY_CAST(substring(reservoir_id, 2, 5) AS INTEGER) AS VARCHAR)"
oracle("fn_string_date_battery", ["bronze_readings"], f"""
SELECT _offset, {num('percent_storage')} AS pct_num, {intg('capacity_mcm')} AS cap_int,
  COALESCE(NULLIF(trim(reservoir_id), ''), NULLIF(trim(reservoir_name), '')) AS first_id,
  COALESCE(NULLIF(trim(COALESCE(owner, 'none')), ''), 'none') AS owner_filled,
  CASE WHEN length({_PAD_SRC}) < 6 THEN lpad({_PAD_SRC}, 6, '0') ELSE {_PAD_SRC} END AS padded,
  {CLIP(num('volume_mcm') + ' / 20.0')} AS clipped,
  list_transform(list_filter(list_transform(string_split(concat_ws(',', CAST(CAST(CAST(outflow_mcm AS DOUBLE) AS INTEGER) AS VARCHAR), ' 63', 'x', source), ','), lambda x: trim(x)),
                 lambda x: regexp_full_match(x, '[0-9]+')), lambda x: CAST(x AS INTEGER)) AS codes,
  {DKEY("COALESCE(TRY_CAST(record_date AS DATE), CAST(dt AS DATE))")} AS date_key,
  CAST(strftime(TRY_CAST(substring(dt, 1, 4) || '-' || lpad(CAST(_offset % 13 AS VARCHAR), 2, '0') || '-01' AS DATE), '%Y%m%d') AS INTEGER) AS month_key,
  list_extract(['มกราคม','กุมภาพันธ์','มีนาคม','เมษายน','พฤษภาคม','มิถุนายน','กรกฎาคม','สิงหาคม','กันยายน','ตุลาคม','พฤศจิกายน','ธันวาคม'], month(CAST(dt AS DATE))) AS month_th,
  {MD5KEY("reservoir_id || '_' || source")} AS rkey, TRY_CAST(substring(reservoir_id, 2, 5) AS INTEGER) AS nat_key,
  CAST(60 AS INTEGER) AS span
FROM bronze_readings""")

# ---------------------------------------------------------------- scans / sinks / payloads / streaming

oracle("scan_partition", ["silver_weather"], f"SELECT * FROM silver_weather WHERE dt = '{RUN_DATE}'")
oracle("scan_latest_partition", ["silver_weather"],
       "SELECT * FROM silver_weather WHERE dt = (SELECT max(dt) FROM silver_weather)")
oracle("scan_all_if_empty", ["silver_weather"], "SELECT * FROM silver_weather")
oracle("scan_window", ["silver_weather"], f"SELECT * FROM silver_weather WHERE dt BETWEEN '{LO_7D}' AND '{RUN_DATE}'")
oracle("scan_partition_dates", ["silver_weather"],
       f"SELECT DISTINCT dt FROM (SELECT dt FROM silver_weather UNION ALL SELECT '{RUN_DATE}') t ORDER BY dt")
oracle("scan_mixed_formats", ["silver_flood_risk"], "SELECT * FROM silver_flood_risk")
oracle("sink_orc_partition", ["alerts"], "SELECT * FROM alerts")
oracle("scan_csv_bom", ["silver_flood_risk"], "SELECT * FROM silver_flood_risk")

_NDJSON = """SELECT _offset, source, reservoir_id, reservoir_name, region, CASE WHEN source = 'dam' THEN NULL ELSE owner END AS owner,
  record_date, capacity_mcm, volume_mcm, percent_storage, inflow_mcm, outflow_mcm, active_storage_mcm, dead_storage_mcm,
  fetched_at, dt
FROM bronze_readings WHERE _offset % 101 <> 0 AND _offset % 103 <> 0"""
oracle("scan_ndjson", ["bronze_readings"], _NDJSON)
oracle("scan_union_sources", ["bronze_readings"], _NDJSON)

oracle("flatten_nested_payload", ["bronze_readings"], f"""
SELECT source, NULLIF(trim(reservoir_id), '') AS reservoir_id,
  CASE WHEN source = 'dam' THEN COALESCE(reservoir_name, '') ELSE COALESCE(NULLIF(trim(reservoir_name), ''), '') END AS reservoir_name,
  COALESCE(region, '') AS region, COALESCE(NULLIF(trim(owner), ''), 'กรมชลประทาน') AS owner,
  COALESCE(NULLIF(trim(record_date), ''), dt) AS record_date,
  {num('capacity_mcm')} AS capacity_mcm, {num('volume_mcm')} AS volume_mcm, {num('percent_storage')} AS percent_storage,
  {num('inflow_mcm')} AS inflow_mcm, {num('outflow_mcm')} AS outflow_mcm, {num('active_storage_mcm')} AS active_storage_mcm,
  {num('dead_storage_mcm')} AS dead_storage_mcm, '{RUN_DATE}T00:00:00+07:00' AS fetched_at
FROM bronze_readings""")

oracle("extract_forecast_payload", ["bronze_weather"], f"""
SELECT _offset, dt, round({num('temp_max_c')}, 1) AS temp_max_c, round({num('temp_min_c')}, 1) AS temp_min_c,
  round({num('rainfall_forecast_mm')}, 1) AS rainfall_forecast_mm, round({num('humidity_pct')}, 1) AS humidity_pct,
  round(CAST(_offset % 20 AS DOUBLE) * 3.6::DOUBLE, 1) AS wind_speed_kmh, 'tmd_api' AS data_source
FROM bronze_weather WHERE _offset % 23 <> 0""")

oracle("stream_ingest", ["bronze_readings"], f"""
SELECT source, reservoir_id, reservoir_name, region, owner, record_date, CAST(NULL AS VARCHAR) AS date, capacity_mcm,
  volume_mcm, percent_storage, inflow_mcm, outflow_mcm, active_storage_mcm, dead_storage_mcm, fetched_at,
  COALESCE(NULLIF(source, ''), 'reservoir') AS bucket_source, COALESCE(NULLIF(record_date, ''), '{RUN_DATE}') AS bucket_date
FROM bronze_readings
WHERE _offset % 101 <> 0 AND _offset % 103 <> 0 AND COALESCE(fetched_at, '') > '1970-01-01T00:00:00+00:00'""")

oracle("watermark_filter", ["bronze_readings"], f"""
SELECT _offset, fetched_at, concat_ws('_', reservoir_id, record_date, source) AS message_key
FROM bronze_readings WHERE COALESCE(fetched_at, '') > '{RUN_DATE}T03:00:00+07:00'""")

oracle("ingest_static_table", ["hazard"], """
SELECT 'flood_risk_area.csv' AS file, count(*) AS row_count, 'Hazard history per sub-district and month' AS description
FROM hazard""")
oracle("export_json_snapshot", ["export_alerts"], f"""
SELECT '{RUN_DATE}' AS date, count(*) AS count, CAST(count(*) AS INTEGER) AS n_data,
  COALESCE(sum(alert_score), 0.0) AS score_sum FROM export_alerts""")
oracle("export_json_document", ["export_alerts"], f"""
SELECT alert_date, prov_code, prov_th, alert_level, alert_score, trigger_reservoirs, '{RUN_DATE}' AS date,
  (SELECT count(*) FROM export_alerts) AS count FROM export_alerts""")
oracle("agg_dq_history", ["dq_silver"], """
SELECT dt AS run_date, count_if(status = 'PASS') AS passed, count(*) AS total,
  CASE WHEN count_if(status = 'FAIL' AND critical) > 0 THEN 'FAIL' ELSE 'PASS' END AS overall
FROM dq_silver GROUP BY dt""")
oracle("bronze_weather_record", ["silver_weather", "province_catalogue"], f"""
SELECT c.prov_code, c.prov_th, c.prov_en, c.region, c.lat AS latitude, c.lon AS longitude, '{RUN_DATE}' AS forecast_date,
  v.temp_max_c, v.temp_min_c, v.rainfall_forecast_mm, {RAIN('v.rainfall_forecast_mm')} AS rain_intensity,
  v.humidity_pct, v.wind_speed_kmh, v.rainfall_forecast_mm >= 35.0 AS is_heavy_rain_24h, v.data_source,
  '{RUN_DATE}T06:00:00+07:00' AS generated_at
FROM province_catalogue c LEFT JOIN (
  SELECT COALESCE(a.prov_code, g.prov_code) AS prov_code,
    CASE WHEN a.prov_code IS NOT NULL THEN a.temp_max_c ELSE g.temp_max_c END AS temp_max_c,
    CASE WHEN a.prov_code IS NOT NULL THEN a.temp_min_c ELSE g.temp_min_c END AS temp_min_c,
    CASE WHEN a.prov_code IS NOT NULL THEN a.rainfall_forecast_mm ELSE g.rainfall_forecast_mm END AS rainfall_forecast_mm,
    CASE WHEN a.prov_code IS NOT NULL THEN a.humidity_pct ELSE g.humidity_pct END AS humidity_pct,
    CASE WHEN a.prov_code IS NOT NULL THEN a.wind_speed_kmh ELSE g.wind_speed_kmh END AS wind_speed_kmh,
    CASE WHEN a.prov_code IS NOT NULL THEN 'tmd_api' ELSE 'mock_tmd' END AS data_source
  FROM (SELECT CAST(prov_code AS INTEGER) AS prov_code, temp_max_c, temp_min_c, rainfall_forecast_mm, humidity_pct,
               wind_speed_kmh FROM silver_weather WHERE dt = '{RUN_DATE}') a
  FULL JOIN (SELECT prov_code, 31.0::DOUBLE AS temp_max_c, 24.0::DOUBLE AS temp_min_c, lat * 3.0::DOUBLE AS rainfall_forecast_mm,
                    70.0::DOUBLE AS humidity_pct, 10.8::DOUBLE AS wind_speed_kmh FROM province_catalogue) g
  ON a.prov_code = g.prov_code) v ON c.prov_code = v.prov_code""")

cte("matched_daily", ["features_daily", "downstream_map", "map_edges"], f"""
SELECT DISTINCT e.prov_code, fd.feature_date, fd.reservoir_id, fd.source
FROM (SELECT DISTINCT f.reservoir_name, m.reservoir_name_en AS map_id
      FROM (SELECT DISTINCT reservoir_name FROM features_daily) f, downstream_map m WHERE {NAME_MATCH}) p
JOIN map_edges e ON p.map_id = e.map_id JOIN features_daily fd ON fd.reservoir_name = p.reservoir_name""")

cte("alerts_daily", ["silver_weather", "silver_flood_risk", "features_daily", "matched_daily"], f"""
SELECT row_number() OVER (PARTITION BY p.dt ORDER BY p.prov_code, p.prov_th) AS alert_key,
  CAST(strftime(CAST(p.dt AS DATE), '%Y%m%d') AS INTEGER) AS date_key, -1 AS location_key, -1 AS weather_key,
  CAST(p.dt AS DATE) AS alert_date, p.prov_code, p.prov_th,
  {ALERT('(r + w + h)')} AS alert_level, round(r + w + h, 2) AS alert_score, round(r, 2) AS reservoir_score,
  round(w, 2) AS weather_score, round(h, 2) AS historical_risk_score,
  COALESCE(triggers, '') AS trigger_reservoirs, COALESCE(statuses, '') AS trigger_reservoir_statuses,
  round(COALESCE(max_pct, 0.0), 2) AS max_reservoir_pct, round(COALESCE(rain, 0.0), 2) AS rainfall_forecast_mm,
  COALESCE(risk_level, 'เสี่ยงต่ำ') AS historical_risk_level, COALESCE(subd, 0) AS affected_subdistricts_count, p.dt
FROM (
  SELECT p.dt, p.prov_code, p.prov_th, COALESCE(res.reservoir_score, 0.0) AS r,
    {WEATHER_PTS('COALESCE(rn.rain, 0.0)')} AS w,
    CASE WHEN hi.max_risk IS NULL THEN 5.0
         ELSE CASE CAST(hi.max_risk AS INTEGER) WHEN 4 THEN 25.0 WHEN 3 THEN 18.0 WHEN 2 THEN 10.0 WHEN 1 THEN 5.0 ELSE 0.0 END END AS h,
    res.triggers, res.statuses, res.max_pct, rn.rain, hm.risk_level, hi.subd
  FROM (SELECT DISTINCT dt, CAST(prov_code AS INTEGER) AS prov_code, prov_th FROM silver_weather) p
  LEFT JOIN (
    SELECT dt, prov_code, COALESCE(rainfall_forecast_mm, 0.0) AS rain FROM (
      SELECT dt, CAST(prov_code AS INTEGER) AS prov_code, rainfall_forecast_mm,
        row_number() OVER (PARTITION BY dt, CAST(prov_code AS INTEGER) ORDER BY forecast_date DESC NULLS LAST, prov_th, rainfall_forecast_mm DESC) AS k
      FROM silver_weather) z WHERE k = 1) rn ON p.dt = rn.dt AND p.prov_code = rn.prov_code
  LEFT JOIN (
    SELECT prov_code, feature_date, max(rscore) AS reservoir_score, max(percent_storage) AS max_pct,
      string_agg(reservoir_name, ',' ORDER BY rk) FILTER (WHERE rk <= 3) AS triggers,
      string_agg(reservoir_status, ',' ORDER BY rk) FILTER (WHERE rk <= 3) AS statuses
    FROM (
      SELECT m.prov_code, f.feature_date, f.reservoir_name, f.reservoir_status, f.percent_storage, s.rscore,
        row_number() OVER (PARTITION BY m.prov_code, f.feature_date ORDER BY s.rscore DESC, f.reservoir_name, f.reservoir_id, f.source) AS rk
      FROM matched_daily m JOIN features_daily f
        ON m.reservoir_id = f.reservoir_id AND m.source = f.source AND m.feature_date = f.feature_date,
      LATERAL (SELECT {ROWSCORE('f.reservoir_status', 'f.filling_rate')} AS rscore) s) q
    GROUP BY prov_code, feature_date) res ON p.prov_code = res.prov_code AND p.dt = res.feature_date
  LEFT JOIN (
    SELECT CAST(prov_code AS INTEGER) AS prov_code, CAST(month AS INTEGER) AS month,
      max(COALESCE(CAST(risk_score AS DOUBLE), 1.0)) AS max_risk, count(DISTINCT geocode) AS subd
    FROM silver_flood_risk GROUP BY 1, 2) hi ON p.prov_code = hi.prov_code AND month(CAST(p.dt AS DATE)) = hi.month
  LEFT JOIN (
    SELECT prov_code, month, risk_level FROM (
      SELECT CAST(prov_code AS INTEGER) AS prov_code, CAST(month AS INTEGER) AS month, risk_level,
        row_number() OVER (PARTITION BY CAST(prov_code AS INTEGER), CAST(month AS INTEGER) ORDER BY count(*) DESC, risk_level) AS k
      FROM silver_flood_risk GROUP BY 1, 2, 3) z WHERE k = 1) hm ON p.prov_code = hm.prov_code AND month(CAST(p.dt AS DATE)) = hm.month
) p""")

oracle("fact_flood_alert_daily", ["alerts_daily"], "SELECT * FROM alerts_daily")
oracle("fact_flood_alert_resolved", ["alerts_daily", "dim_location", "silver_weather"], """
SELECT a.* REPLACE (COALESCE(l.k, -1) AS location_key, COALESCE(w.k, -1) AS weather_key)
FROM alerts_daily a
LEFT JOIN (SELECT prov_code, min(location_key) AS k FROM dim_location GROUP BY prov_code) l ON a.prov_code = l.prov_code
LEFT JOIN (SELECT DISTINCT dt, CAST(prov_code AS INTEGER) AS k FROM silver_weather) w ON a.prov_code = w.k AND a.dt = w.dt""")

oracle("load_downstream_map", ["downstream_map"], """
SELECT reservoir_name_th, reservoir_name_en, downstream_prov_codes,
  list_transform(list_filter(list_transform(string_split(COALESCE(downstream_prov_codes, ''), ','), lambda x: trim(x)),
                 lambda x: regexp_full_match(x, '[0-9]+')), lambda x: CAST(x AS INTEGER)) AS downstream_prov_list
FROM downstream_map""")
oracle("agg_max_watermark", ["bronze_readings"], """
SELECT source, max(fetched_at) AS last_fetched_at, count(*) AS accepted FROM bronze_readings
WHERE COALESCE(fetched_at, '') > '1970-01-01T00:00:00+00:00' GROUP BY source""")
oracle("silver_flood_risk_domain", ["silver_flood_risk"],
       "SELECT * FROM silver_flood_risk WHERE geocode IS NOT NULL AND month BETWEEN 1 AND 12")
oracle("export_csv_bom", ["export_alerts", "province_catalogue"], f"""
SELECT a.alert_date, a.prov_code, a.prov_th, a.alert_level, {LEVEL_EN('a.alert_level')} AS alert_level_en, a.alert_score,
  a.reservoir_score, a.weather_score, a.historical_risk_score, a.trigger_reservoirs, a.max_reservoir_pct,
  a.rainfall_forecast_mm, a.historical_risk_level, a.affected_subdistricts_count, p.lat, p.lon,
  {REGION_EN('a.prov_code')} AS region_en
FROM export_alerts a LEFT JOIN province_catalogue p ON a.prov_th = p.prov_th""")
oracle("process_all_dates", ["silver_reservoir", "silver_weather"], """
SELECT COALESCE(r.dt, w.dt) AS dt, COALESCE(r.n, 0) AS reservoir_rows, COALESCE(w.n, 0) AS weather_rows
FROM (SELECT dt, count(*) AS n FROM silver_reservoir GROUP BY dt) r
FULL JOIN (SELECT dt, count(*) AS n FROM silver_weather GROUP BY dt) w ON r.dt = w.dt""")
oracle("fn_pad_variants", ["hazard"], """
SELECT _offset, CASE WHEN length("GEOCODE") < 6 THEN lpad("GEOCODE", 6, '0') ELSE "GEOCODE" END AS zfill_short,
  CASE WHEN length(lc) < 6 THEN lpad(lc, 6, '0') ELSE lc END AS zfill_long, lpad(lc, 6, '0') AS lpad_long
FROM (SELECT *, "GEOCODE" || '00' || "GEOCODE" AS lc FROM hazard) t""")

oracle("silver_reservoir_sql", ["bronze_readings"], """
SELECT reservoir_id, reservoir_name, region, source, owner, record_date_d AS record_date, capacity_mcm, volume_mcm,
  percent_storage, inflow_mcm, outflow_mcm, dead_storage_mcm, fetched_at, dt
FROM (
  SELECT reservoir_id, reservoir_name, region, source, owner, TRY_CAST(record_date AS DATE) AS record_date_d,
    COALESCE(TRY_CAST(capacity_mcm AS DOUBLE), 0.0) AS capacity_mcm, COALESCE(TRY_CAST(volume_mcm AS DOUBLE), 0.0) AS volume_mcm,
    CASE WHEN TRY_CAST(percent_storage AS DOUBLE) < 0 THEN 0.0 WHEN TRY_CAST(percent_storage AS DOUBLE) > 100 THEN 100.0
         ELSE COALESCE(TRY_CAST(percent_storage AS DOUBLE), 0.0) END AS percent_storage,
    COALESCE(TRY_CAST(inflow_mcm AS DOUBLE), 0.0) AS inflow_mcm, COALESCE(TRY_CAST(outflow_mcm AS DOUBLE), 0.0) AS outflow_mcm,
    COALESCE(TRY_CAST(dead_storage_mcm AS DOUBLE), 0.0) AS dead_storage_mcm, fetched_at, dt,
    row_number() OVER (PARTITION BY reservoir_id, record_date, source ORDER BY fetched_at DESC NULLS LAST, _offset DESC) AS rn
  FROM bronze_readings WHERE reservoir_id IS NOT NULL AND reservoir_id <> '') d
WHERE rn = 1""")

oracle("silver_weather_sql", ["bronze_weather"], """
SELECT prov_code_i AS prov_code, prov_th, prov_en, region, forecast_date_d AS forecast_date, temp_max_c, temp_min_c,
  rainfall_forecast_mm, rain_intensity, humidity_pct, wind_speed_kmh, is_heavy_rain_24h, data_source, dt
FROM (
  SELECT TRY_CAST(prov_code AS INTEGER) AS prov_code_i, prov_th, prov_en, region, TRY_CAST(forecast_date AS DATE) AS forecast_date_d,
    COALESCE(TRY_CAST(temp_max_c AS DOUBLE), 0.0) AS temp_max_c, COALESCE(TRY_CAST(temp_min_c AS DOUBLE), 0.0) AS temp_min_c,
    COALESCE(TRY_CAST(rainfall_forecast_mm AS DOUBLE), 0.0) AS rainfall_forecast_mm, rain_intensity,
    COALESCE(TRY_CAST(humidity_pct AS DOUBLE), 0.0) AS humidity_pct, COALESCE(TRY_CAST(wind_speed_kmh AS DOUBLE), 0.0) AS wind_speed_kmh,
    CASE WHEN lower(trim(is_heavy_rain_24h)) IN ('t', 'true', 'y', 'yes', '1') THEN TRUE
         WHEN lower(trim(is_heavy_rain_24h)) IN ('f', 'false', 'n', 'no', '0') THEN FALSE END AS is_heavy_rain_24h,
    data_source, dt,
    row_number() OVER (PARTITION BY prov_code, forecast_date ORDER BY generated_at DESC NULLS LAST, _offset DESC) AS rn
  FROM bronze_weather WHERE prov_code IS NOT NULL AND forecast_date IS NOT NULL) d
WHERE rn = 1""")

oracle("silver_flood_risk_sql", ["hazard"], """
SELECT lpad(CAST("GEOCODE" AS VARCHAR), 6, '0') AS geocode, TRY_CAST("Month" AS INTEGER) AS month, "TAMBON_T" AS tambon_th,
  "TAMBON_E" AS tambon_en, TRY_CAST("AMPHOE_CODE" AS INTEGER) AS amphoe_code, "AMPHOE_T" AS amphoe_th, "AMPHOE_E" AS amphoe_en,
  TRY_CAST("PROV_CODE" AS INTEGER) AS prov_code, "PROV_T" AS prov_th, "PROV_E" AS prov_en,
  COALESCE(TRY_CAST("COUNT 17 YEAR" AS INTEGER), 0) AS flood_count_17yr, "CRITERIA" AS flood_criteria, "RISK" AS risk_level,
  CASE "RISK" WHEN 'เสี่ยงต่ำ' THEN 1 WHEN 'เสี่ยงปานกลาง' THEN 2 WHEN 'เสี่ยงสูง' THEN 3 WHEN 'เสี่ยงสูงมาก' THEN 4 ELSE 0 END AS risk_score
FROM hazard WHERE "GEOCODE" IS NOT NULL AND TRY_CAST("Month" AS INTEGER) BETWEEN 1 AND 12""")

# ---------------------------------------------------------------- written Gold, states, gates

oracle("join_fact_dim", ["fact_water"], "SELECT * FROM fact_water")
oracle("derive_flag", ["silver_weather"],
       "SELECT * REPLACE (rainfall_forecast_mm >= 35.0 AS is_heavy_rain_24h) FROM silver_weather")
oracle("dq_gate", ["dq_staged"], """
SELECT dt, count_if(status = 'FAIL' AND critical) AS critical_failures, count_if(status = 'FAIL' AND critical) > 0 AS halts
FROM dq_staged GROUP BY dt""")
oracle("sink_dq_report", ["dq_staged"], "SELECT dt, rule, status, critical, total_rows, failed_rows FROM dq_staged")
oracle("insert_overwrite_partition", ["silver_weather"], "SELECT * FROM silver_weather")
ORACLES["mart_from_lake"] = ORACLES["mart_30d_trend"]
oracle("export_alerts_latest", ["silver_weather"],
       ALERT_EXPORT_WX.replace(f"dt = '{RUN_DATE}'", "dt = (SELECT max(dt) FROM silver_weather)"))
oracle("watermark_state", ["bronze_readings"],
       "SELECT max(fetched_at) AS watermark, CAST(0 AS BIGINT) AS still_accepted FROM bronze_readings")
oracle("producer_state", ["bronze_weather"],
       "SELECT max(dt) AS last_date, count(DISTINCT dt) AS processed_count FROM bronze_weather")
oracle("backfill_dates", ["bronze_weather"], f"""
SELECT strftime(d, '%Y-%m-%d') AS dt, (SELECT count(*) FROM bronze_weather w WHERE w.dt = strftime(d, '%Y-%m-%d')) AS forecasts
FROM (SELECT unnest(generate_series(DATE '{RUN_DATE}' - INTERVAL 30 DAY, DATE '{RUN_DATE}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d) t""")

# ---------------------------------------------------------------- streaming state, incremental Gold, gates by date

ACCEPTED = "SELECT * FROM bronze_readings WHERE _offset % 101 <> 0 AND _offset % 103 <> 0 AND fetched_at IS NOT NULL"
oracle("incremental_load", ["bronze_readings"], f"""
SELECT 0 AS run, max(fetched_at) AS mark, count(*) AS accepted, count(*) AS bronze_rows FROM ({ACCEPTED}) a WHERE dt < '{RUN_DATE}'
UNION ALL SELECT 1, max(fetched_at), count(*), count(*) FROM ({ACCEPTED}) b
WHERE (dt >= '{RUN_DATE}' OR _offset % 3 = 0) AND fetched_at > (SELECT max(fetched_at) FROM ({ACCEPTED}) c WHERE dt < '{RUN_DATE}')""")
oracle("stream_dedup", ["bronze_readings"],
       f"SELECT DISTINCT concat_ws('_', reservoir_id, record_date, source) AS message_key, fetched_at FROM ({ACCEPTED}) a")
oracle("producer_ledger", ["bronze_weather"], f"""
SELECT max(dt) AS last_date, count(DISTINCT dt) AS processed_count, '{YESTERDAY}' AS next_date, CAST(1 AS BIGINT) AS n_next FROM bronze_weather""")
DIM_RESERVOIR = CTES["dim_reservoir"][1]
DIM_TO_DATE = DIM_RESERVOIR.replace("FROM silver_reservoir", f"FROM silver_reservoir WHERE dt <= '{RUN_DATE}'")
oracle("dim_reservoir_incremental", ["silver_reservoir"], DIM_TO_DATE)
oracle("insert_overwrite_table", ["silver_reservoir"],
       f"SELECT *, 'new' AS version FROM ({DIM_RESERVOIR}) a UNION ALL SELECT *, 'old' AS version FROM ({DIM_TO_DATE}) b")
oracle("dq_availability", ["dq_silver_day"], f"""
SELECT '{RUN_DATE}' AS run_date, rule, status, critical, total_rows, failed_rows, pass_rate_pct FROM dq_silver_day WHERE rule NOT LIKE 'DUPLICATE%'
UNION ALL SELECT d, 'DATA_AVAILABILITY', 'FAIL', TRUE, 0, 0, 0.0 FROM (VALUES ('{RUN_DATE}'), ('2099-01-01')) v(d)
  WHERE d <> '{RUN_DATE}' OR NOT EXISTS (SELECT 1 FROM dq_silver_day)""")
oracle("backfill_gate", ["fact_water", "dq_silver"], """
SELECT * FROM fact_water WHERE dt BETWEEN '1998-06-06' AND '1998-06-15' AND dt <> '1998-06-11'
  AND dt NOT IN (SELECT dt FROM dq_silver WHERE status = 'FAIL' AND critical)""")
oracle("scan_ndjson_quarantine", ["bronze_readings"], """
SELECT 'good' AS side, count(*) AS n_lines FROM bronze_readings WHERE _offset % 101 <> 0 AND _offset % 103 <> 0
UNION ALL SELECT 'bad', count(*) FROM bronze_readings WHERE _offset % 101 = 0""")
ORACLES["mart_from_buckets"] = ORACLES["mart_30d_trend"]
