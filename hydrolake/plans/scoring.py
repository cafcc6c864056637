"""Province flood-alert scoring: reservoir + weather + historical components.

Set-based: the downstream map is exploded to (map row, province) edges, reservoir
names are matched to map names with a substring join, matches are de-duplicated
per (province, reservoir), ranked (top-3 kept per province) and aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.classify import alert_level, historical_component, reservoir_row_score, weather_component
from ..functions.coerce import parse_code_list
from ..functions.dates import date_key
from ..operators.aggregates import mode_of, topk_concat_and_max
from ..operators.joins import pick_first, substring_match_pairs

ALERT_COLS = ["alert_key", "date_key", "location_key", "weather_key", "alert_date", "prov_code", "prov_th",
              "alert_level", "alert_score", "reservoir_score", "weather_score", "historical_risk_score",
              "trigger_reservoirs", "trigger_reservoir_statuses", "max_reservoir_pct", "rainfall_forecast_mm",
              "historical_risk_level", "affected_subdistricts_count", "loaded_at", "dt"]


def name_matches(features: DataFrame, downstream_map: DataFrame, k: int = 3) -> DataFrame:
    """(reservoir_name, prov_code) for every distinct reservoir name matching a map row
    (Thai name case-sensitive, English name case-insensitive) that lists the province.

    Matching runs on *distinct names* (a reservoir reports every day, its name
    once), so its input does not grow with the number of days; both name columns
    are matched in one pass.
    """
    names = features.select("reservoir_name").distinct()
    # a name is its own id, and a map row's is its list of provinces: no join back to either side
    names = names.select("reservoir_name", F.col("reservoir_name").alias("_name"))
    pairs = substring_match_pairs(names, "reservoir_name", downstream_map, "downstream_prov_codes",
                                  [("_name", "reservoir_name_th", False), ("_name", "reservoir_name_en", True)], k)
    return pairs.select("reservoir_name", F.explode(parse_code_list("downstream_prov_codes")).alias("prov_code")).distinct()


def named_upstream(features: DataFrame, downstream_map: DataFrame, k: int = 3) -> DataFrame:
    """(prov_code, feature row) pairs by name, before features that occur twice are made one."""
    return name_matches(features, downstream_map, k).join(features, "reservoir_name")


def match_upstream(features: DataFrame, downstream_map: DataFrame, keys: list[str] | None = None, k: int = 3) -> DataFrame:
    """Distinct (prov_code, feature row) pairs: the feature's name matches any map row
    listing the province."""
    keys = keys or ["reservoir_id", "source"]
    return named_upstream(features, downstream_map, k).dropDuplicates(["prov_code", *keys])


def reservoir_component(matched: DataFrame, group: list[str], each: tuple[str, str] | None = None) -> DataFrame:
    """Per group, each reservoir and source once: best row score, top-3 names/statuses (score desc, name, id), max percent.
    ``each``: see ``topk_concat_and_max``."""
    scored = matched.withColumn("_rscore", reservoir_row_score("reservoir_status", "filling_rate"))
    order = [F.col("_rscore").desc(), F.col("reservoir_name").asc(), F.col("reservoir_id").asc(),
             F.col("source").asc()]
    return topk_concat_and_max(scored, group, order, K.TOP_TRIGGERS,
                               {"trigger_reservoirs": "reservoir_name", "trigger_reservoir_statuses": "reservoir_status"},
                               {"reservoir_score": "_rscore", "max_reservoir_pct": "percent_storage"}, ["reservoir_id", "source"], each=each)


def fact_flood_alert(features: DataFrame, silver_weather: DataFrame, silver_flood_risk: DataFrame,
                     downstream_map: DataFrame, target_date: str, run_ts: str | None = None) -> DataFrame:
    """Alert rows for day D, one per province present in D's weather partition."""
    day = F.lit(target_date)
    return fact_flood_alert_daily(features.withColumn("feature_date", day), silver_weather.where(F.col("dt") == target_date),
                                  silver_flood_risk, downstream_map, run_ts)


def historical_by_province_month(silver_flood_risk: DataFrame) -> DataFrame:
    """Historical risk per (province, month) for every month at once."""
    risk = silver_flood_risk.withColumn("risk_score", F.coalesce(F.col("risk_score").cast("double"), F.lit(1.0)))
    return risk.groupBy(F.col("prov_code").cast("int").alias("prov_code"), F.col("month").cast("int").alias("_month")).agg(
        F.max("risk_score").alias("_max_risk"), mode_of("risk_level").alias("_risk_level"),
        F.countDistinct("geocode").alias("_subdistricts"))


def fact_flood_alert_daily(features_daily: DataFrame, silver_weather: DataFrame, silver_flood_risk: DataFrame,
                           downstream_map: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Alert rows for every (day, province) in the weather partitions, in one job.

    Equal to ``fact_flood_alert(..., D)`` restricted to D for days whose reservoir
    slice is non-empty.  Shuffles are keyed by (dt, prov_code); the alert key is a
    row number within each day (province-sized windows).
    """
    from pyspark.sql import Window
    wx = silver_weather.withColumn("prov_code", F.col("prov_code").cast("int"))
    provinces = wx.select("dt", "prov_code", "prov_th").distinct()
    first_wx = pick_first(wx, ["dt", "prov_code"], [F.col("forecast_date").desc_nulls_last(), F.col("prov_th"),
                                                   F.col("rainfall_forecast_mm").desc()])
    rain = first_wx.select("dt", "prov_code", F.coalesce(F.col("rainfall_forecast_mm"), F.lit(0.0)).alias("_rain"))
    # a feature row is shuffled once with the list of its name's provinces, not once per province
    of_name = name_matches(features_daily, downstream_map).groupBy("reservoir_name").agg(F.array_sort(F.collect_set("prov_code")).alias("_provinces"))
    res = reservoir_component(features_daily.join(of_name, "reservoir_name"), ["prov_code", "feature_date"],
                              ("prov_code", "_provinces")).withColumnRenamed("feature_date", "dt")
    hist = historical_by_province_month(silver_flood_risk)
    j = (provinces.join(rain, ["dt", "prov_code"], "left").join(res, ["dt", "prov_code"], "left")
         .withColumn("_month", F.month(F.to_date("dt"))).join(hist, ["prov_code", "_month"], "left"))
    r_score = F.coalesce(F.col("reservoir_score"), F.lit(0.0))
    w_score = weather_component(F.coalesce(F.col("_rain"), F.lit(0.0)))
    h_score = F.when(F.col("_max_risk").isNull(), F.lit(K.HISTORICAL_DEFAULT_POINTS)).otherwise(
        historical_component("_max_risk"))
    j = j.select("*", r_score.alias("_r"), w_score.alias("_w"), h_score.alias("_h"))
    total = F.col("_r") + F.col("_w") + F.col("_h")
    loaded = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    key = F.row_number().over(Window.partitionBy("dt").orderBy("prov_code", "prov_th")).cast("bigint")
    return j.select(
        key.alias("alert_key"), date_key(F.to_date("dt")).alias("date_key"),
        F.lit(-1).alias("location_key"), F.lit(-1).alias("weather_key"), F.to_date("dt").alias("alert_date"),
        "prov_code", "prov_th", alert_level(total).alias("alert_level"), F.round(total, 2).alias("alert_score"),
        F.round("_r", 2).alias("reservoir_score"), F.round("_w", 2).alias("weather_score"),
        F.round("_h", 2).alias("historical_risk_score"),
        F.coalesce("trigger_reservoirs", F.lit("")).alias("trigger_reservoirs"),
        F.coalesce("trigger_reservoir_statuses", F.lit("")).alias("trigger_reservoir_statuses"),
        F.round(F.coalesce("max_reservoir_pct", F.lit(0.0)), 2).alias("max_reservoir_pct"),
        F.round(F.coalesce("_rain", F.lit(0.0)), 2).alias("rainfall_forecast_mm"),
        F.coalesce("_risk_level", F.lit(K.HISTORICAL_DEFAULT_LEVEL)).alias("historical_risk_level"),
        F.coalesce("_subdistricts", F.lit(0)).cast("bigint").alias("affected_subdistricts_count"),
        loaded.alias("loaded_at"), "dt")


def resolve_alert_keys(alerts: DataFrame, dim_location: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Alerts with the keys of both dimensions instead of -1, by province code (and day for the weather).

    An alert concerns a province, which has many locations: its key is the least of theirs, so that no alert is
    repeated.  Provinces that a dimension lacks keep -1.  Both sides are aggregated by the join key first.
    """
    location = dim_location.groupBy("prov_code").agg(F.min("location_key").alias("_location"))
    weather = dim_weather.groupBy("dt", "prov_code").agg(F.min("weather_key").alias("_weather"))
    found = alerts.join(location, "prov_code", "left").join(weather, ["dt", "prov_code"], "left")
    keys = {"location_key": F.coalesce("_location", "location_key"), "weather_key": F.coalesce("_weather", "weather_key")}
    return found.select(*[keys.get(c, F.col(c)).alias(c) for c in alerts.columns])
