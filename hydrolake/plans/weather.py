"""Province weather records: API forecast per province, generated values where the API has none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.classify import classify_rain
from ..operators.joins import fallback_per_key

VALUE_COLS = ["temp_max_c", "temp_min_c", "rainfall_forecast_mm", "humidity_pct", "wind_speed_kmh"]


def bronze_weather_record(catalogue: DataFrame, api: DataFrame, generated: DataFrame, forecast_date: str,
                          generated_at: str) -> DataFrame:
    """16-field Bronze weather record for every catalogue province.

    ``api`` / ``generated`` carry prov_code + VALUE_COLS; the API row wins per
    province, provenance goes to ``data_source``.
    """
    vals = fallback_per_key(api, generated, ["prov_code"], VALUE_COLS, "tmd_api", "mock_tmd")
    j = catalogue.join(vals, "prov_code", "left")
    rain = F.col("rainfall_forecast_mm")
    return j.select(
        "prov_code", "prov_th", "prov_en", "region", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.lit(forecast_date).alias("forecast_date"), "temp_max_c", "temp_min_c", "rainfall_forecast_mm",
        classify_rain(rain).alias("rain_intensity"), "humidity_pct", "wind_speed_kmh",
        (rain >= K.HEAVY_RAIN_MM).alias("is_heavy_rain_24h"), "data_source", F.lit(generated_at).alias("generated_at"))
