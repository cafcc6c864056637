"""Silver -> Gold star schema: dimensions with stable keys, daily facts.

Dimensions are GROUP BY aggregates (partial + final hash aggregation; no
window over the whole table).  Facts join Silver to the dimensions on natural
keys; AQE broadcasts a dimension only when its runtime size is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.classify import normalize_region, recompute_percent, region_from_code
from ..functions.dates import date_key, date_parts, month_start_key
from ..functions.keys import fact_key, natural_int_key, reservoir_key
from ..operators.joins import pick_first


def dim_date(spark: SparkSession, start: str = K.DIM_DATE_START, end: str = K.DIM_DATE_END) -> DataFrame:
    """One row per calendar day in [start, end] (inclusive)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("d"))
    parts = date_parts(F.col("d"))
    return days.select(*[c.alias(n) for n, c in parts.items()])


def dim_date_for(df: DataFrame, date_col: str) -> DataFrame:
    """Dim_Date rows for the span of dates present in ``df`` (min..max)."""
    span = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*[c.alias(n) for n, c in date_parts(F.col("d")).items()])


RESERVOIR_MAXES = ("reservoir_name", "region", "owner", "capacity_mcm", "dead_storage_mcm")
RESERVOIR_STATE = ("reservoir_id STRING, source STRING, reservoir_name STRING, region STRING, owner STRING, capacity_mcm DOUBLE, "
                   "dead_storage_mcm DOUBLE, first_date DATE, last_date DATE")


def reservoir_state(silver_reservoir: DataFrame) -> DataFrame:
    """Per (reservoir_id, source) the attributes' maxima and the span of reading dates: a mergeable aggregate."""
    return silver_reservoir.groupBy("reservoir_id", "source").agg(
        *[F.max(c).alias(c) for c in RESERVOIR_MAXES], F.min("record_date").alias("first_date"), F.max("record_date").alias("last_date"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all rows that went into ``states``."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy("reservoir_id", "source").agg(
        *[F.max(c).alias(c) for c in RESERVOIR_MAXES], F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def dim_from_state(state: DataFrame, crosswalk_region: bool = False) -> DataFrame:
    """The reservoir dimension: surrogate keys over the state."""
    region = normalize_region("region") if crosswalk_region else F.col("region")
    return state.select(
        reservoir_key("reservoir_id", "source").alias("reservoir_key"),
        "reservoir_id", "reservoir_name", region.alias("region"), "owner",
        F.col("source").alias("reservoir_type"), "capacity_mcm", "dead_storage_mcm",
    )


def dates_from_state(state: DataFrame) -> DataFrame:
    """Dim_Date over the state's span of reading dates."""
    span = state.agg(F.min("first_date").alias("lo"), F.max("last_date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*[c.alias(n) for n, c in date_parts(F.col("d")).items()])


def dim_reservoir(silver_reservoir: DataFrame, crosswalk_region: bool = False) -> DataFrame:
    """One row per (reservoir_id, source) with the max of slowly-changing attributes."""
    return dim_from_state(reservoir_state(silver_reservoir), crosswalk_region)


def dim_location(silver_flood_risk: DataFrame) -> DataFrame:
    """One row per geocode; region from the province code range."""
    agg = silver_flood_risk.groupBy("geocode").agg(
        F.max("tambon_th").alias("tambon_th"), F.max("tambon_en").alias("tambon_en"),
        F.max("amphoe_code").cast("int").alias("amphoe_code"), F.max("amphoe_th").alias("amphoe_th"),
        F.max("amphoe_en").alias("amphoe_en"), F.max("prov_code").cast("int").alias("prov_code"),
        F.max("prov_th").alias("prov_th"), F.max("prov_en").alias("prov_en"),
    )
    return agg.select(
        natural_int_key("geocode").alias("location_key"), "geocode", "tambon_th", "tambon_en", "amphoe_code",
        "amphoe_th", "amphoe_en", "prov_code", "prov_th", "prov_en", region_from_code("prov_code").alias("region"))


def dim_weather(silver_weather: DataFrame, dt: str | None = None) -> DataFrame:
    """Weather dimension; ``dt`` selects one run's partition (None = every partition)."""
    df = silver_weather if dt is None else silver_weather.where(F.col("dt") == dt)
    return df.select(
        F.col("prov_code").cast("int").alias("weather_key"), date_key("forecast_date").alias("date_key"),
        F.col("prov_code").cast("int").alias("prov_code"), "prov_th", "prov_en", "region", "temp_max_c",
        "temp_min_c", "rainfall_forecast_mm", "rain_intensity", "humidity_pct", "wind_speed_kmh",
        "is_heavy_rain_24h", "data_source", "dt")


def fact_water(silver_reservoir: DataFrame, dim_res: DataFrame | None, dt: str | None = None,
               key_with_source: bool = True) -> DataFrame:
    """Daily reservoir facts; ``dt`` = one partition, None = all partitions.

    ``dim_res`` is the reservoir dimension to take surrogate keys from (a Gold
    table in the daily run).  ``None`` means the dimension is ``dim_reservoir``
    of this same Silver frame: its key is a pure function of (reservoir_id,
    source) and every non-NULL pair has a row, so the inner join reduces to
    deriving the key and dropping NULL keys.  That keeps Silver from being
    computed twice (once for the aggregate, once for the facts) in one plan.
    """
    sr = silver_reservoir if dt is None else silver_reservoir.where(F.col("dt") == dt)
    if dim_res is None:
        j = (sr.where(F.col("reservoir_id").isNotNull() & F.col("source").isNotNull())
             .withColumn("reservoir_key", reservoir_key("reservoir_id", "source")))
    else:
        j = sr.join(dim_res.select("reservoir_key", "reservoir_id", F.col("reservoir_type").alias("source")),
                    ["reservoir_id", "source"])
    fk_parts = [F.col("reservoir_id"), F.col("record_date").cast("string")]
    if key_with_source:
        fk_parts.append(F.col("source"))
    return j.select(
        fact_key(*fk_parts).alias("fact_key"),
        date_key("record_date").alias("date_key"),
        "reservoir_key", "record_date", "volume_mcm",
        recompute_percent("percent_storage", "volume_mcm", "capacity_mcm", scale=2, clip_result=False)
        .alias("percent_storage"),
        "inflow_mcm", "outflow_mcm", F.col("capacity_mcm").alias("storage_mcm"), "active_storage_mcm",
        F.col("silver_loaded_at").alias("loaded_at"), "dt")


def _first_forecast(wx: DataFrame, keys: list[str]) -> DataFrame:
    """One weather row per province (and day): the latest forecast, so risk rows are never multiplied."""
    return pick_first(wx, keys, [F.desc_nulls_last("date_key"), F.desc_nulls_last("rainfall_forecast_mm"),
                                 F.desc_nulls_last("is_heavy_rain_24h"), "weather_key"])


def _risk_columns(year, dt, run_ts: str | None) -> list:
    return [
        fact_key(F.col("geocode"), F.col("month").cast("string")).alias("fact_key"),
        month_start_key(year, F.col("month")).alias("date_key"),
        "location_key", "weather_key", "geocode", F.col("month").alias("risk_month"),
        F.col("flood_count_17yr").alias("historical_flood_count"), "risk_level", "risk_score", "flood_criteria",
        F.col("rainfall_forecast_mm").alias("rain_forecast_mm"),
        F.col("is_heavy_rain_24h").alias("is_heavy_rain_forecast"),
        (F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")).alias("loaded_at"), dt.alias("dt")]


def fact_flood_risk(silver_flood_risk: DataFrame, dim_loc: DataFrame, dim_wx: DataFrame, dt: str,
                    run_ts: str | None = None) -> DataFrame:
    """Risk rows of the run month joined to location and that run's weather."""
    year, month = int(dt[:4]), int(dt[5:7])
    risk = silver_flood_risk.where(F.col("month") == month)
    wx = _first_forecast(dim_wx.where(F.col("dt") == dt) if "dt" in dim_wx.columns else dim_wx, ["prov_code"])
    j = (risk.drop("prov_code").join(dim_loc.select("geocode", "location_key", "prov_code"), "geocode")
         .join(wx.select("prov_code", "weather_key", "rainfall_forecast_mm", "is_heavy_rain_24h"), "prov_code"))
    return j.select(*_risk_columns(F.lit(year), F.lit(dt), run_ts))


def fact_flood_risk_daily(silver_flood_risk: DataFrame, dim_loc: DataFrame, dim_wx: DataFrame, run_ts: str | None = None) -> DataFrame:
    """``fact_flood_risk`` of every day of ``dim_wx`` at once: risk rows meet the days by province and month."""
    wx = _first_forecast(dim_wx, ["dt", "prov_code"])
    wx = wx.select("prov_code", "weather_key", "rainfall_forecast_mm", "is_heavy_rain_24h", "dt",
                   F.month(F.to_date("dt")).cast("bigint").alias("month"), F.year(F.to_date("dt")).alias("_year"))
    j = (silver_flood_risk.drop("prov_code").join(dim_loc.select("geocode", "location_key", "prov_code"), "geocode")
         .join(wx, ["prov_code", "month"]))
    return j.select(*_risk_columns(F.col("_year"), F.col("dt"), run_ts))
