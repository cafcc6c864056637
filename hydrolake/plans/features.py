"""Rolling reservoir features over the 7-day Silver window."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.classify import classify_filling_rate, classify_status, days_to_full, net_flow
from ..operators.dedup import keep_first
from ..operators.windows import calendar_delta, range_mean

FEATURE_COLS = ["feature_date", "reservoir_id", "reservoir_name", "source", "region", "capacity_mcm", "volume_mcm",
                "percent_storage", "inflow_mcm", "outflow_mcm", "net_flow_mcm", "storage_trend_7d",
                "storage_delta_1d", "days_to_full", "reservoir_status", "filling_rate", "computed_at"]

_NUM = ["percent_storage", "volume_mcm", "capacity_mcm", "inflow_mcm", "outflow_mcm"]


LOOKBACK = K.LOOKBACK_DAYS


def shift(d: str, days: int) -> str:
    return (_dt.date.fromisoformat(d) + _dt.timedelta(days=days)).isoformat()


def scan_window(silver: DataFrame, target_date: str, days: int = K.LOOKBACK_DAYS) -> DataFrame:
    """Partitions dt in [D-(days-1), D]; literal bounds so the scan prunes partitions."""
    return silver.where(F.col("dt").between(shift(target_date, -(days - 1)), target_date))


def _prepare(df: DataFrame) -> DataFrame:
    for c in _NUM:
        df = df.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    # latest record per (reservoir, source, partition day); record_date then fetch time is a total order
    return keep_first(df, ["reservoir_id", "source", "dt"],
                      [F.col("record_date").desc_nulls_last(), F.col("fetched_at").desc_nulls_last()])


def _derive(df: DataFrame, feature_date, run_ts) -> DataFrame:
    df = df.withColumn("net_flow_mcm", net_flow("inflow_mcm", "outflow_mcm"))
    df = df.withColumn("storage_delta_1d", F.coalesce(F.col("storage_delta_1d"), F.lit(0.0)))
    computed = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return df.select(
        feature_date.alias("feature_date"), "reservoir_id", "reservoir_name", "source", "region", "capacity_mcm",
        "volume_mcm", "percent_storage", "inflow_mcm", "outflow_mcm", "net_flow_mcm", "storage_trend_7d",
        "storage_delta_1d", days_to_full("capacity_mcm", "volume_mcm", "net_flow_mcm").alias("days_to_full"),
        classify_status("percent_storage").alias("reservoir_status"),
        classify_filling_rate("storage_delta_1d").alias("filling_rate"),
        computed.alias("computed_at"))


def reservoir_features(silver: DataFrame, target_date: str, run_ts: str | None = None) -> DataFrame:
    """Features of day D: one row per (reservoir_id, source) seen on D.

    If no row has record_date = D the latest record date of the window stands
    in for "today" (yesterday stays D-1).  The fallback is a one-row aggregate
    joined in, so the plan stays lazy.

    Trend and yesterday come from one window pass over (reservoir_id, source):
    after the per-day de-duplication a key holds at most one row per day of the
    window, so the collected list of yesterday's values is bounded by the window
    length; exploding it (outer) gives exactly the rows of a left join with
    yesterday's rows (one per match, NULL when none).
    """
    w = _prepare(scan_window(silver, target_date))
    target = F.to_date(F.lit(target_date))
    pick = w.agg(F.coalesce(F.max(F.when(F.col("record_date") == target, F.col("record_date"))),
                            F.max("record_date")).alias("_today"))
    per_key = Window.partitionBy("reservoir_id", "source")
    y = F.when(F.col("record_date") == F.date_sub(target, 1), F.col("percent_storage"))
    x = w.select("*", F.avg("percent_storage").over(per_key).alias("storage_trend_7d"),
                 F.collect_list(y).over(per_key).alias("_ys"))
    today = x.join(F.broadcast(pick), F.col("record_date") == F.col("_today")).drop("_today")
    out = (today.select("*", F.explode_outer("_ys").alias("_pct_y")).drop("_ys")
           .withColumn("storage_delta_1d", F.col("percent_storage") - F.col("_pct_y")))
    return _derive(out, F.lit(target_date), run_ts)


def reservoir_features_daily(silver: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Features for every day at once (backfill): one shuffle on (reservoir_id, source) after Silver.

    Equal to ``reservoir_features(silver, D)`` for every D whose day slice is
    non-empty, when record_date equals the partition day: yesterday is the row
    exactly one calendar day earlier and the trend is the mean over the
    7-calendar-day range ending at D.
    """
    # one shuffle on (reservoir_id, source) serves the per-day dedup (clustered on a superset of
    # these keys) and both history windows; Silver is already one row per (record_date, dt) here,
    # so this adds no skew beyond the per-reservoir windows themselves
    w = _prepare(silver.repartition("reservoir_id", "source")).withColumn("_day", F.to_date("dt"))
    w = calendar_delta(w, ["reservoir_id", "source"], "_day", "percent_storage", "storage_delta_1d", missing=None)
    w = range_mean(w, ["reservoir_id", "source"], "_day", "percent_storage", K.LOOKBACK_DAYS, "storage_trend_7d")
    w = w.where(F.col("record_date") == F.col("_day"))
    return _derive(w, F.col("dt"), run_ts)
