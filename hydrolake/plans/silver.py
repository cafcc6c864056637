"""Bronze -> Silver: coerce, conform, de-duplicate.

Each builder processes *every* partition date in one job (``dt`` is carried as
a column and is part of every de-duplication key), which is the backfill
(``process_all_dates``) and the daily run at once: the daily job is the same
plan with ``where(dt = D)`` pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.classify import recompute_percent, risk_score
from ..functions.coerce import (clip, coerce_int, coerce_numeric, ensure_string, fill_default_string,
                                parse_bool, zero_pad)
from ..functions.dates import to_date_lenient
from ..operators.conform import col_or, conform_schema, rename_columns
from ..operators.dedup import dedup_first, dedup_latest

RESERVOIR_NUMERIC = ["capacity_mcm", "volume_mcm", "percent_storage", "inflow_mcm", "outflow_mcm",
                     "active_storage_mcm", "dead_storage_mcm"]

SILVER_RESERVOIR_COLS = [
    ("reservoir_id", "string"), ("reservoir_name", "string"), ("region", "string"), ("source", "string"),
    ("owner", "string"), ("record_date", "date"), ("capacity_mcm", "double"), ("volume_mcm", "double"),
    ("percent_storage", "double"), ("inflow_mcm", "double"), ("outflow_mcm", "double"),
    ("active_storage_mcm", "double"), ("dead_storage_mcm", "double"), ("fetched_at", "string"),
    ("silver_loaded_at", "timestamp"), ("dt", "string"),
]

WEATHER_NUMERIC = ["temp_max_c", "temp_min_c", "rainfall_forecast_mm", "humidity_pct", "wind_speed_kmh"]

SILVER_WEATHER_COLS = [
    ("prov_code", "bigint"), ("prov_th", "string"), ("prov_en", "string"), ("region", "string"),
    ("forecast_date", "date"), ("temp_max_c", "double"), ("temp_min_c", "double"),
    ("rainfall_forecast_mm", "double"), ("rain_intensity", "string"), ("humidity_pct", "double"),
    ("wind_speed_kmh", "double"), ("is_heavy_rain_24h", "boolean"), ("data_source", "string"),
    ("silver_loaded_at", "timestamp"), ("dt", "string"),
]

HAZARD_RENAMES = {
    "Month": "month", "GEOCODE": "geocode", "TAMBON_T": "tambon_th", "TAMBON_E": "tambon_en",
    "AMPHOE_CODE": "amphoe_code", "AMPHOE_T": "amphoe_th", "AMPHOE_E": "amphoe_en", "PROV_CODE": "prov_code",
    "PROV_T": "prov_th", "PROV_E": "prov_en", "COUNT 17 YEAR": "flood_count_17yr", "CRITERIA": "flood_criteria",
    "RISK": "risk_level",
}

SILVER_FLOOD_RISK_COLS = [
    ("geocode", "string"), ("month", "bigint"), ("tambon_th", "string"), ("tambon_en", "string"),
    ("amphoe_code", "bigint"), ("amphoe_th", "string"), ("amphoe_en", "string"), ("prov_code", "bigint"),
    ("prov_th", "string"), ("prov_en", "string"), ("flood_count_17yr", "bigint"), ("flood_criteria", "string"),
    ("risk_level", "string"), ("risk_score", "bigint"), ("silver_loaded_at", "timestamp"),
]


def _loaded_at(run_ts):
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def key_reservoir(bronze: DataFrame) -> DataFrame:
    """Bronze readings with their cleaned keys (id and date; source and dt are as landed); rows without id go."""
    date_src = F.col("record_date") if "record_date" in bronze.columns else col_or(bronze, "date")
    df = bronze.select(*[c for c in bronze.columns if c not in ("reservoir_id", "record_date")],
                       fill_default_string(col_or(bronze, "reservoir_id"), "").alias("reservoir_id"),
                       to_date_lenient(date_src, F.col("dt").cast("date")).alias("record_date"))
    return df.where(F.col("reservoir_id") != "")


def clean_measures(df: DataFrame) -> DataFrame:
    """Keyed readings with numbers parsed, names filled and the percentage recomputed."""
    df = df.withColumns({c: coerce_numeric(col_or(df, c)) for c in RESERVOIR_NUMERIC} | {
        "reservoir_name": fill_default_string(col_or(df, "reservoir_name"), K.DEFAULT_NAME),
        "owner": fill_default_string(col_or(df, "owner"), K.DEFAULT_OWNER),
        "region": fill_default_string(col_or(df, "region"), K.DEFAULT_REGION, blank_to_default=True)})
    return df.withColumn("percent_storage",
                         clip(recompute_percent("percent_storage", "volume_mcm", "capacity_mcm", scale=2)))


def clean_reservoir(bronze: DataFrame) -> DataFrame:
    """Coerce and fill Bronze readings, drop unkeyed rows, normalise dates and percent."""
    return clean_measures(key_reservoir(bronze))


def silver_reservoir(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Silver reservoir: one row per (reservoir_id, record_date, source, dt), latest fetch wins.

    Ties on ``fetched_at`` (one constant per producer run) are broken by the
    message offset, newest first, so the choice is deterministic.  Only the keys are
    cleaned before the shuffle: measures of superseded rows are never parsed, and the
    rest is parsed in as many tasks as the shuffle has, however few files were read.
    """
    df = key_reservoir(bronze)
    tie = [F.col("_offset").desc()] if "_offset" in df.columns else []
    df = dedup_latest(df, ["reservoir_id", "record_date", "source", "dt"], "fetched_at", tie)
    df = clean_measures(df).withColumn("silver_loaded_at", _loaded_at(run_ts))
    return conform_schema(df, SILVER_RESERVOIR_COLS)


def silver_weather(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Silver weather: one row per (prov_code, forecast_date, dt), latest ``generated_at`` wins.

    As in ``silver_reservoir`` only the keys are cleaned before the shuffle.
    """
    order_col = "generated_at" if "generated_at" in bronze.columns else "fetched_at"
    tie = [F.col("_offset").desc()] if "_offset" in bronze.columns else []
    df = bronze.withColumns({"prov_code": coerce_int(col_or(bronze, "prov_code")),
                             "forecast_date": to_date_lenient(col_or(bronze, "forecast_date"), F.col("dt").cast("date"))})
    df = dedup_latest(df, ["prov_code", "forecast_date", "dt"], order_col, tie)
    df = df.withColumns({c: coerce_numeric(col_or(df, c)) for c in WEATHER_NUMERIC} | {
        c: ensure_string(col_or(df, c)) for c in ("prov_th", "prov_en", "region", "rain_intensity", "data_source")})
    if "is_heavy_rain_24h" in df.columns:
        df = df.withColumn("is_heavy_rain_24h", parse_bool("is_heavy_rain_24h"))
    else:   # flag column absent from the feed: derive it from rainfall
        df = df.withColumn("is_heavy_rain_24h", F.col("rainfall_forecast_mm") >= K.HEAVY_RAIN_MM)
    df = df.withColumn("silver_loaded_at", _loaded_at(run_ts))
    return conform_schema(df, SILVER_WEATHER_COLS)


def silver_flood_risk(raw: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Silver hazard table: snake_case, typed, one row per (geocode, month)."""
    df = rename_columns(raw, HAZARD_RENAMES)
    df = df.select(
        *[c for c in df.columns if c not in ("month", "geocode", "prov_code", "amphoe_code", "flood_count_17yr",
                                               "tambon_th", "tambon_en", "risk_level")],
        coerce_int("month").alias("month"),
        zero_pad(F.col("geocode").cast("string"), 6).alias("geocode"),
        coerce_int("prov_code").alias("prov_code"),
        coerce_int("amphoe_code").alias("amphoe_code"),
        coerce_int("flood_count_17yr").alias("flood_count_17yr"),
        ensure_string("tambon_th").alias("tambon_th"),
        ensure_string("tambon_en").alias("tambon_en"),
        fill_default_string("risk_level", K.RISK_LEVEL_MISSING).alias("risk_level"),
    )
    tie = [F.col("_offset").asc()] if "_offset" in df.columns else []
    df = dedup_first(df, ["geocode", "month"], ["geocode", "month"], tie)
    df = df.withColumn("risk_score", risk_score("risk_level"))
    df = df.withColumn("silver_loaded_at", _loaded_at(run_ts))
    return conform_schema(df, SILVER_FLOOD_RISK_COLS)


def silver_flood_risk_domain(silver: DataFrame) -> DataFrame:
    """SQL-model variant: keep rows with a geocode and a valid month (1..12)."""
    return silver.where(F.col("geocode").isNotNull() & F.col("month").between(1, 12))
