"""Nested API payloads -> flat records (two explodes, no Python)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import coerce_numeric, first_truthy
from ..functions import constants as K

ITEM_FIELDS = ["id", "code", "name", "owner", "date", "report_date", "reservoir_id", "reservoir_name",
               "record_date", "capacity", "storage", "volume", "percent_storage", "inflow", "outflow",
               "active_storage", "dead_storage"]


def payload_schema(children: tuple[str, ...]) -> str:
    item = ", ".join(f"`{f}`: STRING" for f in ITEM_FIELDS)
    lists = ", ".join(f"`{c}`: ARRAY<STRUCT<{item}>>" for c in children)
    return f"`date` STRING, `data` ARRAY<STRUCT<`region`: STRING, {lists}>>"


def flatten_nested_payload(df: DataFrame, json_col: str, *children: str) -> DataFrame:
    """``{date, data:[{region, <child>:[...], ...}]}`` -> one row per item of any child list, with its
    kind (``child``), region and payload date copied down; the payloads are parsed once.  Wrong shapes
    parse to NULL and ``explode`` drops them."""
    p = df.select(F.from_json(F.col(json_col), payload_schema(children)).alias("p"))
    regions = p.select(F.col("p.date").alias("payload_date"), F.explode("p.data").alias("r"))
    def tagged(child: str) -> Column:
        return F.transform(F.coalesce(F.col(f"r.{child}"), F.array()), lambda i: F.struct(F.lit(child).alias("child"), i.alias("i")))
    items = regions.select("payload_date", F.col("r.region").alias("region"), F.inline(F.concat(*map(tagged, children))))
    return items.select("child", "payload_date", "region", "i.*")


def _num(c: str):
    return coerce_numeric(F.col(c))


def normalize_items(items: DataFrame, fetched_at: str) -> DataFrame:
    """Flattened dam and reservoir items as 14-field common records.

    Of a reservoir the volume or storage counts, and its date, record_date, then report_date (the last fallback
    keeps backfilled days apart).  Fields that both kinds have are written once: their numbers are parsed once.
    """
    def by_kind(dam: Column, reservoir: Column) -> Column:
        return F.when(F.col("child") == "dam", dam).otherwise(reservoir)

    storage = _num("storage")
    return items.select(
        by_kind(F.lit("dam"), F.lit("reservoir")).alias("source"),
        by_kind(first_truthy("id", "code"), first_truthy("reservoir_id", "id", "code")).alias("reservoir_id"),
        by_kind(F.coalesce(F.col("name"), F.lit("")), F.coalesce(first_truthy("reservoir_name", "name"), F.lit(""))).alias("reservoir_name"),
        F.coalesce(F.col("region"), F.lit("")).alias("region"),
        F.coalesce(first_truthy("owner"), F.lit(K.DEFAULT_OWNER)).alias("owner"),
        by_kind(first_truthy("report_date", "date", "payload_date"),
                first_truthy("date", "record_date", "report_date", "payload_date")).alias("record_date"),
        _num("capacity").alias("capacity_mcm"),
        by_kind(storage, F.coalesce(F.nullif(_num("volume"), F.lit(0.0)), storage)).alias("volume_mcm"),
        _num("percent_storage").alias("percent_storage"), _num("inflow").alias("inflow_mcm"),
        _num("outflow").alias("outflow_mcm"), _num("active_storage").alias("active_storage_mcm"),
        _num("dead_storage").alias("dead_storage_mcm"), F.lit(fetched_at).alias("fetched_at"))


FORECAST_FIELDS = ["tc_max", "tc_min", "rh", "rain", "ws10m"]


def _scalar_or_value(v):
    """A number given either as a scalar or as ``{"value": x, "unit": ...}``."""
    return F.coalesce(F.get_json_object(v, "$.value").try_cast("double"), v.try_cast("double"), F.lit(0.0))


def extract_forecast_payload(df: DataFrame, json_col: str) -> DataFrame:
    """``WeatherForecasts[0].forecasts[0].data`` -> rounded fields; any missing level -> no row.
    Wind speed is converted from m/s to km/h."""
    data = F.get_json_object(F.col(json_col), "$.WeatherForecasts[0].forecasts[0].data")
    d = df.select("*", data.alias("_d")).where(F.col("_d").isNotNull() & (F.col("_d") != "{}"))
    vals = {f: _scalar_or_value(F.get_json_object(F.col("_d"), f"$.{f}")) for f in FORECAST_FIELDS}
    return d.select(
        *[c for c in df.columns if c != json_col],
        F.round(vals["tc_max"], 1).alias("temp_max_c"), F.round(vals["tc_min"], 1).alias("temp_min_c"),
        F.round(vals["rain"], 1).alias("rainfall_forecast_mm"), F.round(vals["rh"], 1).alias("humidity_pct"),
        F.round(vals["ws10m"] * K.WIND_MS_TO_KMH, 1).alias("wind_speed_kmh"),
        F.lit("tmd_api").alias("data_source"))
