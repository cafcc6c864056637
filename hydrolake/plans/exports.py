"""Gold / Silver -> dashboard exports (typed rows; JSON/CSV writers in sources.io)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import constants as K
from ..functions.classify import (alert_level, alert_level_en, blank_sentinel, classify_status_lenient,
                                  recompute_percent, region_from_code, weather_component)
from ..functions.coerce import null_if_nan
from ..operators.joins import fallback_whole
from ..sources.io import scan_latest_partition

RESERVOIR_EXPORT_COLS = ["reservoir_id", "reservoir_name", "source", "region", "record_date", "capacity_mcm",
                         "volume_mcm", "percent_storage", "inflow_mcm", "outflow_mcm", "net_flow_mcm",
                         "storage_trend_7d", "storage_delta_1d", "days_to_full", "reservoir_status", "filling_rate"]

ALERT_JSON_COLS = ["alert_date", "prov_code", "prov_th", "alert_level", "alert_score", "reservoir_score",
                   "weather_score", "historical_risk_score", "trigger_reservoirs", "max_reservoir_pct",
                   "rainfall_forecast_mm", "historical_risk_level", "affected_subdistricts_count"]

ALERT_CSV_COLS = ["alert_date", "prov_code", "prov_th", "alert_level", "alert_level_en", "alert_score",
                  "reservoir_score", "weather_score", "historical_risk_score", "trigger_reservoirs",
                  "max_reservoir_pct", "rainfall_forecast_mm", "historical_risk_level",
                  "affected_subdistricts_count", "lat", "lon", "region_en"]

#: The orders of the exports, as ascending SQL keys.
ALERT_ORDER = ["-alert_score", "prov_code"]
RESERVOIR_ORDER = ["percent_storage IS NULL", "-percent_storage", "reservoir_id", "source"]

FEATURE_EXPORT_COLS = ["net_flow_mcm", "storage_trend_7d", "storage_delta_1d", "days_to_full", "reservoir_status",
                       "filling_rate"]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN / +-Inf -> NULL in every floating column (JSON writers would emit "NaN")."""
    cols = [null_if_nan(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def export_reservoirs(silver_day: DataFrame, features_day: DataFrame | None) -> DataFrame:
    """Silver rows of the day with their features; percent recomputed (1 dp), status re-derived."""
    if features_day is not None:
        f = features_day.select("reservoir_id", "source", *[c for c in FEATURE_EXPORT_COLS if c != "reservoir_status"])
        df = silver_day.join(f, ["reservoir_id", "source"], "left")
    else:
        df = silver_day
        for c in FEATURE_EXPORT_COLS:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string" if c in ("filling_rate",) else "double"))
    df = df.withColumn("percent_storage", recompute_percent("percent_storage", "volume_mcm", "capacity_mcm", scale=1,
                                                            clip_result=True, also_null=True))
    df = df.withColumn("reservoir_status", classify_status_lenient("percent_storage"))
    return nan_to_null(df.select(*RESERVOIR_EXPORT_COLS)).orderBy(F.col("percent_storage").desc_nulls_last(),
                                                                  "reservoir_id", "source")


def gold_alerts_for_export(alerts: DataFrame) -> DataFrame:
    """Gold alert rows normalised for export: numeric NULL -> 0, 1 dp; string NULL -> ''."""
    def num(c):
        return F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), 1)
    return alerts.select(
        F.col("alert_date"), F.coalesce(F.col("prov_code").cast("int"), F.lit(0)).alias("prov_code"),
        F.coalesce(F.col("prov_th"), F.lit("")).alias("prov_th"),
        F.coalesce(F.col("alert_level"), F.lit(K.ALERT_LEVEL_OTHERWISE)).alias("alert_level"),
        num("alert_score").alias("alert_score"), num("reservoir_score").alias("reservoir_score"),
        num("weather_score").alias("weather_score"), num("historical_risk_score").alias("historical_risk_score"),
        F.coalesce(F.col("trigger_reservoirs"), F.lit("")).alias("trigger_reservoirs"),
        num("max_reservoir_pct").alias("max_reservoir_pct"), num("rainfall_forecast_mm").alias("rainfall_forecast_mm"),
        F.coalesce(F.col("historical_risk_level"), F.lit("")).alias("historical_risk_level"),
        F.coalesce(F.col("affected_subdistricts_count").cast("bigint"), F.lit(0).cast("bigint"))
        .alias("affected_subdistricts_count"))


def weather_only_alerts(silver_weather_day: DataFrame) -> DataFrame:
    """Fallback scoring from weather alone (tops out at 35 -> never above WATCH)."""
    rain = F.coalesce(F.col("rainfall_forecast_mm").cast("double"), F.lit(0.0))
    w = weather_component(rain)
    return silver_weather_day.select(
        F.col("forecast_date").alias("alert_date"),
        F.coalesce(F.col("prov_code").cast("int"), F.lit(0)).alias("prov_code"),
        F.coalesce(F.col("prov_th"), F.lit("")).alias("prov_th"), alert_level(w).alias("alert_level"),
        F.round(w, 1).alias("alert_score"), F.lit(0.0).alias("reservoir_score"), w.alias("weather_score"),
        F.lit(0.0).alias("historical_risk_score"), F.lit("").alias("trigger_reservoirs"),
        F.lit(0.0).alias("max_reservoir_pct"), F.round(rain, 1).alias("rainfall_forecast_mm"),
        F.lit("").alias("historical_risk_level"), F.lit(0).cast("bigint").alias("affected_subdistricts_count"))


def day_or_latest(df: DataFrame, dt: str) -> DataFrame:
    """The day's partition, or the most recent one if the day has none."""
    return scan_latest_partition(df, dt)


def export_alerts(gold_alerts: DataFrame, silver_weather_day: DataFrame) -> DataFrame:
    """Gold alerts if any exist, else the weather-only fallback; score descending.

    Given ``day_or_latest`` of both, this is: the day's alerts, else the latest
    alerts, else the day's weather, else the latest weather.
    """
    out = fallback_whole(gold_alerts_for_export(gold_alerts), weather_only_alerts(silver_weather_day))
    return out.orderBy(F.col("alert_score").desc(), "prov_code")


def export_alerts_csv(alerts_export: DataFrame, provinces: DataFrame) -> DataFrame:
    """CSV shape: English level, coordinates by province name (left join), English region."""
    coords = provinces.select(F.col("prov_th"), F.col("lat"), F.col("lon")).dropDuplicates(["prov_th"])
    df = alerts_export.join(coords, "prov_th", "left")
    df = df.withColumn("alert_level_en", alert_level_en("alert_level")).withColumn(
        "region_en", region_from_code("prov_code", english=True))
    return df.select(*ALERT_CSV_COLS)


def export_reservoirs_csv(reservoirs_export: DataFrame) -> DataFrame:
    """CSV shape: |days_to_full| >= 365 (the clamp sentinel) shown blank."""
    return reservoirs_export.withColumn("days_to_full", blank_sentinel("days_to_full"))


def export_meta_row(export_date: str, reservoirs: DataFrame, alerts_export: DataFrame,
                    dq_summary_row: DataFrame | None = None) -> DataFrame:
    """One metadata row: counts, watermark, alert level counts (flattened), DQ verdict.

    The inputs are unioned (each tagged) and reduced by ONE global aggregate
    (partial per task, then final): no join between the one-row summaries.
    """
    levels = {"วิกฤต": "alert_crisis", "เตือนภัย": "alert_warning", "เฝ้าระวัง": "alert_watch",
              "ปกติ": "alert_normal"}
    parts = [reservoirs.select(F.lit(1).alias("_r"), F.col("record_date").alias("_rd")),
             alerts_export.select(F.lit(1).alias("_a"), F.col("alert_level").alias("_lvl"))]
    if dq_summary_row is not None:
        parts.append(dq_summary_row.select(F.col("overall").alias("_ov"), F.col("passed").alias("_ps"),
                                           F.col("total_checks").alias("_tc")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    aggs = [F.count("_r").alias("reservoir_count"), F.max("_rd").alias("latest_record_date"),
            F.count("_a").alias("alert_province_count")]
    aggs += [F.count_if(F.col("_lvl") == v).alias(out) for v, out in levels.items()]
    if dq_summary_row is not None:
        aggs += [F.max("_ov").alias("dq_overall"), F.max("_ps").alias("dq_passed"), F.max("_tc").alias("dq_total")]
    return u.agg(*aggs).select(F.lit(export_date).alias("export_date"), "*")


def json_snapshot(df: DataFrame, date: str) -> DataFrame:
    """``{date, count, data:[rows]}`` as one JSON string - report-sized frames only
    (alerts: one row per province).  Large exports: ``export_json_document``."""
    clean = nan_to_null(df)
    return clean.agg(F.to_json(F.struct(F.lit(date).alias("date"), F.count(F.lit(1)).alias("count"),
                                        F.collect_list(F.struct(*clean.columns)).alias("data"))).alias("json"))


def json_document(df: DataFrame, date: str, order: list[str]) -> DataFrame:
    """The lines of one JSON document ``{date, count, data:[rows]}``, ``order`` ascending (NULL first); equal rows all stay.

    A line is a row, so the document may be of any size: it is sorted by a range shuffle, and all lines but
    the least one begin with the comma.  An empty table gives ``data:[]``.
    """
    clean = nan_to_null(df)
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in clean.columns]), {"ignoreNullFields": "false"})
    keyed = clean.select(F.struct(*[F.expr(c).alias(f"o{i}") for i, c in enumerate(order)], row.alias("row")).alias("_key"))
    # equal rows are counted before they are told apart by a number
    rows = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).select("_key", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_at"))
    all_rows = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_key", "_at")).alias("least"))
    head = all_rows.select(F.concat(F.lit('{"date":' + json.dumps(date) + ',"count":'), F.col("n").cast("string"),
                                    F.lit(',"data":[')).alias("line"))
    first = all_rows.select("least").scalar()
    body = rows.select(F.lit(1).alias("_part"), "_key", "_at", F.when(F.struct("_key", "_at").eqNullSafe(first), F.col("_key.row"))
                       .otherwise(F.concat(F.lit(","), F.col("_key.row"))).alias("line"))
    ends = head.select(F.lit(0).alias("_part"), "line").unionByName(df.sparkSession.range(1).select(F.lit(2).alias("_part"), F.lit("]}").alias("line")))
    return body.unionByName(ends, allowMissingColumns=True).orderBy("_part", "_key", "_at").select("line")


def export_json_document(df: DataFrame, path: str, date: str, order: list[str]) -> None:
    """Write ``json_document``: the part files, put together in the order of their names, are the document."""
    json_document(df, date, order).write.mode("overwrite").text(path)
