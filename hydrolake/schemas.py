"""Gold table DDL (Spark SQL column lists) and schema creation."""

from __future__ import annotations

from pyspark.sql import SparkSession

GOLD_TABLES: dict[str, tuple[str, str | None]] = {
    "dim_date": ("date_key INT, full_date DATE, year INT, month INT, month_name_th STRING, day INT, quarter INT, "
                 "day_of_week INT, day_name_en STRING, is_weekend BOOLEAN, thai_year INT", None),
    "dim_location": ("location_key INT, geocode STRING, tambon_th STRING, tambon_en STRING, amphoe_code INT, "
                     "amphoe_th STRING, amphoe_en STRING, prov_code INT, prov_th STRING, prov_en STRING, "
                     "region STRING", None),
    "dim_reservoir": ("reservoir_key STRING, reservoir_id STRING, reservoir_name STRING, region STRING, owner STRING, "
                      "reservoir_type STRING, capacity_mcm DOUBLE, dead_storage_mcm DOUBLE", None),
    "dim_weather": ("weather_key INT, date_key INT, prov_code INT, prov_th STRING, prov_en STRING, region STRING, "
                    "temp_max_c DOUBLE, temp_min_c DOUBLE, rainfall_forecast_mm DOUBLE, rain_intensity STRING, "
                    "humidity_pct DOUBLE, wind_speed_kmh DOUBLE, is_heavy_rain_24h BOOLEAN, data_source STRING, "
                    "dt STRING", None),
    "fact_water_monitoring": ("fact_key STRING, date_key INT, reservoir_key STRING, record_date DATE, volume_mcm DOUBLE, "
                              "percent_storage DOUBLE, inflow_mcm DOUBLE, outflow_mcm DOUBLE, storage_mcm DOUBLE, "
                              "active_storage_mcm DOUBLE, loaded_at TIMESTAMP, dt STRING", "dt"),
    "fact_flood_risk": ("fact_key STRING, date_key INT, location_key INT, weather_key INT, geocode STRING, "
                        "risk_month BIGINT, historical_flood_count BIGINT, risk_level STRING, risk_score BIGINT, "
                        "flood_criteria STRING, rain_forecast_mm DOUBLE, is_heavy_rain_forecast BOOLEAN, "
                        "loaded_at TIMESTAMP, dt STRING", "dt"),
    "fact_flood_alert": ("alert_key BIGINT, date_key INT, location_key INT, weather_key INT, alert_date DATE, "
                         "prov_code INT, prov_th STRING, alert_level STRING, alert_score DOUBLE, "
                         "reservoir_score DOUBLE, weather_score DOUBLE, historical_risk_score DOUBLE, "
                         "trigger_reservoirs STRING, trigger_reservoir_statuses STRING, max_reservoir_pct DOUBLE, "
                         "rainfall_forecast_mm DOUBLE, historical_risk_level STRING, "
                         "affected_subdistricts_count BIGINT, loaded_at TIMESTAMP, dt STRING", "dt"),
}


def create_gold_schema(spark: SparkSession, database: str, location: str, fmt: str = "orc") -> None:
    """Create the Gold database and its tables if absent (idempotent)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, (cols, part) in GOLD_TABLES.items():
        p = f" PARTITIONED BY ({part})" if part else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING {fmt}{p}")
