"""Warehouse-model variants of the Silver tables.

The same builders' parts with laxer rules: raw keys as they are, plain lenient
casts, no fallback date, and de-duplication over the raw key without the
partition date.  Ties on the order column go to the newest message offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import risk_score
from ..functions.coerce import clip
from ..operators.conform import conform_schema, rename_columns
from ..operators.dedup import dedup_latest
from .silver import (HAZARD_RENAMES, RESERVOIR_NUMERIC, SILVER_FLOOD_RISK_COLS, SILVER_RESERVOIR_COLS,
                     SILVER_WEATHER_COLS, WEATHER_NUMERIC)


def _plain(c: str) -> Column:
    """The column as a double, 0 where it isn't one."""
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))


def _variant(df: DataFrame, schema: list[tuple[str, str]], without: tuple[str, ...] = (), **types: str) -> DataFrame:
    """The Silver columns, less some, with some types changed."""
    fields = [(c, types.get(c, t)) for c, t in schema if c not in without and c != "silver_loaded_at"]
    return conform_schema(df, fields).withColumn("silver_loaded_at", F.current_timestamp())


def silver_reservoir_sql(bronze: DataFrame) -> DataFrame:
    """One row per raw (id, record date, source); blank-padded ids stay, unreadable dates become NULL."""
    kept = dedup_latest(bronze.where(F.col("reservoir_id") != ""), ["reservoir_id", "record_date", "source"], "fetched_at",
                        [F.col("_offset").desc()])
    typed = kept.withColumns({c: _plain(c) for c in RESERVOIR_NUMERIC} | {"record_date": F.col("record_date").try_cast("date")})
    return _variant(typed.withColumn("percent_storage", clip("percent_storage")), SILVER_RESERVOIR_COLS, ("active_storage_mcm",))


def silver_weather_sql(bronze: DataFrame) -> DataFrame:
    """One row per raw (province, forecast date), rows without either dropped."""
    kept = dedup_latest(bronze.where(F.col("prov_code").isNotNull() & F.col("forecast_date").isNotNull()),
                        ["prov_code", "forecast_date"], "generated_at", [F.col("_offset").desc()])
    casts = {"prov_code": "int", "forecast_date": "date", "is_heavy_rain_24h": "boolean"}
    typed = kept.withColumns({c: _plain(c) for c in WEATHER_NUMERIC} | {c: F.col(c).try_cast(t) for c, t in casts.items()})
    return _variant(typed, SILVER_WEATHER_COLS, prov_code="int")


def silver_flood_risk_sql(raw: DataFrame) -> DataFrame:
    """Every row with a geocode and a valid month, not de-duplicated; codes padded (and cut) to six digits."""
    df = rename_columns(raw, HAZARD_RENAMES)
    ints = ("month", "amphoe_code", "prov_code", "flood_count_17yr")
    df = df.withColumns({c: F.col(c).try_cast("int") for c in ints})
    df = df.where(F.col("geocode").isNotNull() & F.col("month").between(1, 12))
    df = df.withColumns({"geocode": F.lpad("geocode", 6, "0"), "flood_count_17yr": F.coalesce("flood_count_17yr", F.lit(0)),
                         "risk_score": risk_score("risk_level")})
    return _variant(df, SILVER_FLOOD_RISK_COLS, **dict.fromkeys((*ints, "risk_score"), "int"))
