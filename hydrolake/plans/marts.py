"""Analyst marts over the star schema, and the reporting views over alerts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import alert_level_en, alert_level_rank
from ..functions.dates import date_key


def mart_hot_reservoirs(fact: DataFrame, dim_res: DataFrame, dim_dt: DataFrame, dim_loc: DataFrame,
                        dim_wx: DataFrame, dt: str, pct_above: float = 80.0) -> DataFrame:
    """Provinces with reservoirs above ``pct_above`` percent and heavy rain forecast on day dt.

    The location join is on *region* (many-to-many).  Every fact row of a
    (region, day) meets the same set of (location, weather) rows, so COUNT
    DISTINCT / AVG / MAX are aggregated per (region, day) first and joined
    afterwards: the fan-out never materialises.
    """
    f = (fact.where((F.col("dt") == dt) & (F.col("percent_storage") > pct_above))
         .join(dim_res.select("reservoir_key", "reservoir_id", "region"), "reservoir_key"))
    per_region = f.groupBy("region", "date_key").agg(
        F.countDistinct("reservoir_id").alias("hot_reservoirs"),
        F.avg("percent_storage").alias("_avg"), F.max("percent_storage").alias("_max"))
    provs = dim_loc.select("prov_code", "prov_th", "prov_en", "region").distinct()
    wx = dim_wx.where(F.col("is_heavy_rain_24h")).select("prov_code", "date_key", "rainfall_forecast_mm",
                                                         "rain_intensity")
    j = (per_region.join(provs, "region").join(wx, ["prov_code", "date_key"])
         .join(dim_dt.select("date_key", "full_date"), "date_key"))
    out = j.groupBy("prov_th", "prov_en", "region", "rainfall_forecast_mm", "rain_intensity", "full_date").agg(
        F.max("hot_reservoirs").alias("hot_reservoirs"), F.max("_avg").alias("_avg"), F.max("_max").alias("_max"))
    out = out.select(
        "prov_th", "prov_en", "region", "hot_reservoirs",
        F.round("_avg", 1).alias("avg_pct_storage"), F.round("_max", 1).alias("max_pct_storage"),
        F.round("rainfall_forecast_mm", 1).alias("rain_forecast_mm"), "rain_intensity",
        F.col("full_date").alias("data_date"))
    return out.orderBy(F.col("avg_pct_storage").desc(), F.col("rain_forecast_mm").desc(), "prov_th", "prov_en")


def mart_top10_subdistricts(fact_risk: DataFrame, dim_loc: DataFrame, dim_wx: DataFrame, dt: str,
                            k: int = 10) -> DataFrame:
    """Top-k sub-districts by historical flood count (ties: geocode, level, criteria).

    Weather is reduced to per-province (sum, count) and the left-joined
    "latest weather" sub-select to a per-province multiplicity, so the
    weighted average equals the row-level AVG of the original join without
    building the province x weather fan-out.
    """
    dk = int(dt.replace("-", ""))
    w = dim_wx.groupBy("prov_code").agg(F.sum("rainfall_forecast_mm").alias("_s"), F.count("rainfall_forecast_mm").alias("_n"))
    latest = dim_wx.where(F.col("date_key") == dk).groupBy("prov_code").agg(F.count(F.lit(1)).alias("_m"))
    loc = dim_loc.select("location_key", "geocode", "tambon_th", "amphoe_th", "prov_th", "region", "prov_code")
    j = (fact_risk.select("location_key", "historical_flood_count", "risk_level", "flood_criteria")
         .join(loc, "location_key").join(w, "prov_code").join(latest, "prov_code", "left")
         .withColumn("_m", F.coalesce(F.col("_m"), F.lit(1))))
    keys = ["geocode", "tambon_th", "amphoe_th", "prov_th", "region", "risk_level", "flood_criteria"]
    out = j.groupBy(*keys).agg(
        F.max("historical_flood_count").alias("flood_count_17yr"),
        (F.sum(F.col("_m") * F.col("_s")) / F.sum(F.col("_m") * F.col("_n"))).alias("_avg"))
    out = out.select("geocode", "tambon_th", "amphoe_th", "prov_th", "region", "flood_count_17yr", "risk_level",
                     "flood_criteria", F.round("_avg", 1).alias("avg_rain_forecast_mm"))
    return out.orderBy(F.col("flood_count_17yr").desc(), "geocode", "risk_level", "flood_criteria").limit(k)


def mart_30d_trend(fact: DataFrame, dim_res: DataFrame, dim_dt: DataFrame, dt: str, days: int = 30) -> DataFrame:
    """Per-reservoir daily trend over [dt-days, dt] with a 7-row moving average and daily change.

    The window partitions by reservoir_key (one shuffle, co-partitioned with the
    fact join) and orders by date; the date filter is applied before the
    window, as in SQL.
    """
    lo = (_dt.date.fromisoformat(dt) - _dt.timedelta(days=days)).isoformat()
    dd = dim_dt.where(F.col("full_date").between(F.to_date(F.lit(lo)), F.to_date(F.lit(dt))))
    f = (fact.where(F.col("date_key").between(int(lo.replace("-", "")), int(dt.replace("-", ""))))
         .join(F.broadcast(dd.select("date_key", "full_date")), "date_key")     # as many rows as days
         .join(dim_res.select("reservoir_key", "reservoir_id", "reservoir_name", "reservoir_type", "region",
                              "capacity_mcm"), "reservoir_key"))
    w = Window.partitionBy("reservoir_key").orderBy("full_date")
    out = f.select(
        "reservoir_id", "reservoir_name", "reservoir_type", "region",
        F.round("capacity_mcm", 2).alias("capacity_mcm"), "full_date",
        F.round("volume_mcm", 2).alias("volume_mcm"), F.round("percent_storage", 1).alias("pct_storage"),
        F.round("inflow_mcm", 2).alias("inflow_mcm"), F.round("outflow_mcm", 2).alias("outflow_mcm"),
        F.round(F.col("inflow_mcm") - F.col("outflow_mcm"), 2).alias("net_flow_mcm"),
        F.round(F.avg("percent_storage").over(w.rowsBetween(-6, 0)), 1).alias("ma7_pct_storage"),
        F.round(F.col("percent_storage") - F.lag("percent_storage", 1).over(w), 2).alias("daily_change_pct"))
    return out.orderBy("reservoir_name", "full_date", "reservoir_id", "reservoir_type")


# ---------------------------------------------------------------- reporting views

def view_level_summary(alerts: DataFrame) -> DataFrame:
    """Provinces per alert level, ordered CRISIS < ALERT < WATCH < NORMAL."""
    a = alerts.withColumn("alert_level_en", alert_level_en("alert_level"))
    out = a.groupBy("alert_level_en").agg(F.count(F.lit(1)).alias("province_count"))
    out = out.withColumn("level_order", alert_level_rank("alert_level_en"))
    return out.orderBy("level_order")


def view_score_breakdown(alerts: DataFrame) -> DataFrame:
    """Non-NORMAL provinces with their three component scores, unpivoted for stacking."""
    a = alerts.withColumn("alert_level_en", alert_level_en("alert_level")).where(F.col("alert_level_en") != "NORMAL")
    long = a.select("prov_code", "prov_th", "alert_score", "alert_level_en", "reservoir_score", "weather_score",
                    "historical_risk_score").unpivot(
        ["prov_code", "prov_th", "alert_score", "alert_level_en"],
        ["reservoir_score", "weather_score", "historical_risk_score"], "component", "points")
    return long.orderBy(F.col("alert_score").desc(), "prov_code", "component")


def view_region_slice(alerts: DataFrame, region: str | None = None, level_en: str | None = None,
                      date: str | None = None) -> DataFrame:
    """Alerts filtered by English region name, English level and/or date."""
    from ..functions.classify import region_from_code
    a = alerts.withColumn("alert_level_en", alert_level_en("alert_level")).withColumn(
        "region_en", region_from_code("prov_code", english=True))
    if region is not None:
        a = a.where(F.col("region_en") == region)
    if level_en is not None:
        a = a.where(F.col("alert_level_en") == level_en)
    if date is not None:
        a = a.where(F.col("alert_date") == F.to_date(F.lit(date)))
    return a


def view_top_alerts(alerts: DataFrame, k: int = 10) -> DataFrame:
    """Top-k alert scores (ties by province code)."""
    return alerts.orderBy(F.col("alert_score").desc(), "prov_code").limit(k)
