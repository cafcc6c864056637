"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator / pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import marts
from .domain import RUN_DATE, Domain

#: Gram length of names with long numbers: few names share one.
PART_GRAM = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _dom(spark, sf_dir) -> Domain:
    """Lazy plans over the folder as it is now."""
    return Domain(spark, sf_dir)


@register("silver_reservoir")
def q_silver_reservoir(spark, sf_dir):
    return _dom(spark, sf_dir).silver_reservoir.drop("silver_loaded_at")


@register("dim_reservoir")
def q_dim_reservoir(spark, sf_dir):
    return _dom(spark, sf_dir).dim_reservoir


@register("dim_date")
def q_dim_date(spark, sf_dir):
    """Dim_Date over the span of reading dates present in Silver."""
    from ..plans.star import dim_date_for
    return dim_date_for(_dom(spark, sf_dir).silver_reservoir, "record_date")


@register("fact_water")
def q_fact_water(spark, sf_dir):
    return _dom(spark, sf_dir).fact_water.drop("loaded_at")


@register("mart_30d_trend")
def q_mart_30d_trend(spark, sf_dir):
    d = _dom(spark, sf_dir)
    from ..plans.star import fact_water
    return marts.mart_30d_trend(fact_water(d.readings_window(31), None), d.dim_reservoir, d.dim_date, RUN_DATE)


@register("silver_weather")
def q_silver_weather(spark, sf_dir):
    return _dom(spark, sf_dir).silver_weather.drop("silver_loaded_at")


@register("silver_flood_risk")
def q_silver_flood_risk(spark, sf_dir):
    return _dom(spark, sf_dir).silver_flood_risk.drop("silver_loaded_at")


@register("dim_location")
def q_dim_location(spark, sf_dir):
    return _dom(spark, sf_dir).dim_location


@register("dim_weather")
def q_dim_weather(spark, sf_dir):
    return _dom(spark, sf_dir).dim_weather


@register("fact_flood_risk")
def q_fact_flood_risk(spark, sf_dir):
    return _dom(spark, sf_dir).fact_flood_risk.drop("loaded_at")


@register("reservoir_features")
def q_reservoir_features(spark, sf_dir):
    return _dom(spark, sf_dir).features.drop("computed_at")


@register("reservoir_features_daily")
def q_reservoir_features_daily(spark, sf_dir):
    from ..plans.features import reservoir_features_daily
    return reservoir_features_daily(_dom(spark, sf_dir).silver_reservoir).drop("computed_at")


@register("match_upstream")
def q_match_upstream(spark, sf_dir):
    from ..plans.scoring import match_upstream
    d = _dom(spark, sf_dir)
    return match_upstream(d.features, d.downstream_map).select("prov_code", "reservoir_id", "source")


@register("match_upstream_parts")
def q_match_upstream_parts(spark, sf_dir):
    """Upstream matches by a map with a row per part: selective names, on both sides as many as the data has."""
    from ..plans.scoring import match_upstream
    d = _dom(spark, sf_dir)
    return match_upstream(d.features, d.part_map, k=PART_GRAM).select("prov_code", "reservoir_id", "source")


@register("fact_flood_alert")
def q_fact_flood_alert(spark, sf_dir):
    return _dom(spark, sf_dir).alerts.drop("loaded_at")


@register("mart_hot_reservoirs")
def q_mart_hot_reservoirs(spark, sf_dir):
    d = _dom(spark, sf_dir)
    from ..plans.star import fact_water
    return marts.mart_hot_reservoirs(fact_water(d.readings_day, None), d.dim_reservoir, d.dim_date, d.dim_location, d.dim_weather,
                                     RUN_DATE)


@register("mart_hot_reservoirs_crosswalk")
def q_mart_hot_reservoirs_crosswalk(spark, sf_dir):
    """The mart where readings have region texts and locations region codes: they meet by the dimension's crosswalk."""
    from ..functions.constants import REGION_TEXT_TO_CODE
    from ..plans.star import dim_reservoir, fact_water
    d = _dom(spark, sf_dir)
    region = F.col("region")
    for text, code in REGION_TEXT_TO_CODE.items():
        region = F.when(F.col("region") == code, F.lit(text)).otherwise(region)
    dim = dim_reservoir(d.silver_reservoir.withColumn("region", region), crosswalk_region=True)
    return marts.mart_hot_reservoirs(fact_water(d.readings_day, None), dim, d.dim_date, d.dim_location, d.dim_weather, RUN_DATE)


@register("mart_top10_subdistricts")
def q_mart_top10(spark, sf_dir):
    d = _dom(spark, sf_dir)
    return marts.mart_top10_subdistricts(d.fact_flood_risk, d.dim_location, d.dim_weather, RUN_DATE)


@register("view_level_summary")
def q_view_level_summary(spark, sf_dir):
    return marts.view_level_summary(_dom(spark, sf_dir).alerts)


@register("view_score_breakdown")
def q_view_score_breakdown(spark, sf_dir):
    return marts.view_score_breakdown(_dom(spark, sf_dir).alerts)


@register("view_region_slice")
def q_view_region_slice(spark, sf_dir):
    return marts.view_region_slice(_dom(spark, sf_dir).alerts.drop("loaded_at"), date=RUN_DATE)


@register("view_top_alerts")
def q_view_top_alerts(spark, sf_dir):
    return marts.view_top_alerts(_dom(spark, sf_dir).alerts.drop("loaded_at"))


# ---------------------------------------------------------------- data quality

def _staged(d):
    from ..plans.silver import clean_reservoir
    return clean_reservoir(d.bronze_readings)


@register("dq_report_silver")
def q_dq_report_silver(spark, sf_dir):
    from ..operators.quality import dq_report
    return dq_report(_dom(spark, sf_dir).silver_reservoir, "silver_reservoir", group=["dt"])


@register("dq_report_staged")
def q_dq_report_staged(spark, sf_dir):
    from ..operators.quality import dq_report
    return dq_report(_staged(_dom(spark, sf_dir)), "staged_reservoir", group=["dt"])


@register("dq_summary")
def q_dq_summary(spark, sf_dir):
    from ..operators.quality import dq_report, dq_summary
    return dq_summary(dq_report(_staged(_dom(spark, sf_dir)), "staged_reservoir", group=["dt"]), ["dt"])


@register("dq_report_day")
def q_dq_report_day(spark, sf_dir):
    """Whole-frame report of one run day (the daily job's unit)."""
    from pyspark.sql import functions as F
    from ..operators.quality import dq_report
    return dq_report(_staged(_dom(spark, sf_dir)).where(F.col("dt") == RUN_DATE), "staged_reservoir")


@register("dbt_not_null")
def q_dbt_not_null(spark, sf_dir):
    from ..operators.quality import dbt_not_null
    d = _dom(spark, sf_dir)
    return dbt_not_null({"silver_reservoir": d.silver_reservoir, "silver_flood_risk": d.silver_flood_risk,
                         "silver_weather": d.silver_weather})


@register("flag_duplicates")
def q_flag_duplicates(spark, sf_dir):
    from ..operators.dedup import flag_duplicates
    st = _staged(_dom(spark, sf_dir)).select("reservoir_id", "record_date", "source", "dt", "_offset")
    return flag_duplicates(st, ["reservoir_id", "record_date", "source", "dt"])


# ---------------------------------------------------------------- exports

def _silver_day(d):
    return d.readings_day


@register("export_reservoirs")
def q_export_reservoirs(spark, sf_dir):
    from ..plans.exports import export_reservoirs
    d = _dom(spark, sf_dir)
    return export_reservoirs(_silver_day(d), d.features)


@register("export_reservoirs_csv")
def q_export_reservoirs_csv(spark, sf_dir):
    from ..plans.exports import export_reservoirs, export_reservoirs_csv
    d = _dom(spark, sf_dir)
    return export_reservoirs_csv(export_reservoirs(_silver_day(d), d.features))


def _wx_day(d):
    return d.weather_day


@register("export_alerts")
def q_export_alerts(spark, sf_dir):
    from ..plans.exports import export_alerts
    d = _dom(spark, sf_dir)
    return export_alerts(d.alerts_once, _wx_day(d))


@register("export_alerts_fallback")
def q_export_alerts_fallback(spark, sf_dir):
    """Gold partition for a day with no alerts -> weather-only scoring of the run day."""
    from pyspark.sql import functions as F
    from ..plans.exports import export_alerts
    d = _dom(spark, sf_dir)
    return export_alerts(d.alerts_once.where(F.col("alert_date") < F.to_date(F.lit("1900-01-01"))), _wx_day(d))


@register("export_alerts_csv")
def q_export_alerts_csv(spark, sf_dir):
    from ..plans.exports import export_alerts, export_alerts_csv
    d = _dom(spark, sf_dir)
    return export_alerts_csv(export_alerts(d.alerts_once, _wx_day(d)), d.provinces)


@register("export_meta_row")
def q_export_meta_row(spark, sf_dir):
    from ..operators.quality import dq_report, dq_summary
    from ..plans.exports import export_alerts, export_meta_row, export_reservoirs
    d = _dom(spark, sf_dir)
    res = export_reservoirs(_silver_day(d), d.features)
    summ = dq_summary(dq_report(_silver_day(d), "silver_reservoir"))
    return export_meta_row(RUN_DATE, res, export_alerts(d.alerts_once, _wx_day(d)), summ)


# ---------------------------------------------------------------- aggregates / set ops

@register("agg_value_counts")
def q_agg_value_counts(spark, sf_dir):
    from ..operators.aggregates import value_counts
    from ..plans.features import reservoir_features_daily
    return value_counts(reservoir_features_daily(_dom(spark, sf_dir).silver_reservoir), "reservoir_status")


@register("agg_pivot_counts")
def q_agg_pivot_counts(spark, sf_dir):
    """Weather-only alert levels per day flattened into four count columns."""
    from ..operators.aggregates import pivot_counts
    from ..plans.exports import weather_only_alerts
    a = weather_only_alerts(_dom(spark, sf_dir).silver_weather)
    return pivot_counts(a, ["alert_date"], "alert_level", {"วิกฤต": "alert_crisis", "เตือนภัย": "alert_warning",
                                                            "เฝ้าระวัง": "alert_watch", "ปกติ": "alert_normal"})


@register("agg_profile")
def q_agg_profile(spark, sf_dir):
    from ..operators.aggregates import profile
    return profile(_dom(spark, sf_dir).silver_reservoir, ["reservoir_id", "record_date", "percent_storage",
                                                          "capacity_mcm"], "percent_storage", "percent_storage")


@register("agg_profile_weather")
def q_agg_profile_weather(spark, sf_dir):
    from ..operators.aggregates import profile
    return profile(_dom(spark, sf_dir).silver_weather, ["prov_code", "forecast_date", "rainfall_forecast_mm"],
                   "rainfall_forecast_mm", true_col="is_heavy_rain_24h")


@register("agg_count_by_partition")
def q_agg_count_by_partition(spark, sf_dir):
    from ..operators.aggregates import count_by_partition
    return count_by_partition(_dom(spark, sf_dir).silver_reservoir).orderBy("dt", ascending=False)


@register("agg_province_risk")
def q_agg_province_risk(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..plans.scoring import historical_by_province_month
    return historical_by_province_month(_dom(spark, sf_dir).silver_flood_risk).where(F.col("_month") == 6).drop("_month").withColumnsRenamed(
        {"_max_risk": "max_risk_score", "_risk_level": "risk_level", "_subdistricts": "subdistrict_count"})


@register("distinct_pairs")
def q_distinct_pairs(spark, sf_dir):
    from ..operators.dedup import distinct_rows
    return distinct_rows(_dom(spark, sf_dir).silver_weather, ["prov_code", "prov_th"])


@register("union_distinct_dates")
def q_union_distinct_dates(spark, sf_dir):
    from ..sources.io import partition_dates
    d = _dom(spark, sf_dir)
    return partition_dates([d.silver_reservoir, d.silver_weather], include=RUN_DATE)


@register("fallback_per_key")
def q_fallback_per_key(spark, sf_dir):
    """Per province: the run day's forecast if present, else a catalogue-derived default."""
    from pyspark.sql import functions as F
    from ..operators.joins import fallback_per_key
    d = _dom(spark, sf_dir)
    prim = _wx_day(d).select(F.col("prov_code").cast("int").alias("prov_code"), "rainfall_forecast_mm", "temp_max_c")
    sec = d.provinces.select("prov_code", (F.col("lat") * 2.0).alias("rainfall_forecast_mm"),
                             F.lit(30.0).alias("temp_max_c"))
    return fallback_per_key(prim, sec, ["prov_code"], ["rainfall_forecast_mm", "temp_max_c"], "tmd_api", "mock_tmd")


# ---------------------------------------------------------------- scalar function batteries

@register("fn_classify_battery")
def q_fn_classify_battery(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..functions import classify as C
    s = _dom(spark, sf_dir).silver_reservoir
    delta = F.col("inflow_mcm") - F.col("outflow_mcm")
    code = F.substring("reservoir_id", 4, 3).cast("int") % 100
    # what others build on is computed once, a step before: in one step the generated method passes 8,000 bytes, which the JVM never compiles
    s = s.select(
        "reservoir_id", "source", "record_date", "dt", "region", "dead_storage_mcm",
        (F.col("volume_mcm") / 50.0).alias("_rain_mm"), code.alias("_code"),
        C.classify_status("percent_storage").alias("status"),
        C.classify_filling_rate(delta).alias("filling"),
        C.alert_level(F.col("percent_storage")).alias("level"),
        C.days_to_full("capacity_mcm", "volume_mcm", delta).alias("days_to_full"))
    return s.select(
        "reservoir_id", "source", "record_date", "dt", "status", "filling",
        C.classify_rain(F.col("_rain_mm")).alias("rain_label"),
        C.weather_component(F.col("_rain_mm")).alias("weather_pts"),
        C.historical_component(F.pmod(F.col("dead_storage_mcm") / 10.0, F.lit(5.0))).alias("hist_pts"),
        C.reservoir_row_score("status", "filling").alias("row_score"),
        "level",
        C.alert_level_en("level").alias("level_en"),
        "days_to_full",
        C.blank_sentinel("days_to_full").alias("days_to_full_csv"),
        C.region_from_code(F.col("_code")).alias("region_code"),
        C.region_from_code(F.col("_code"), english=True).alias("region_en"),
        C.normalize_region("region").alias("region_norm"))


@register("fn_string_date_battery")
def q_fn_string_date_battery(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..functions import coerce as X
    from ..functions import dates as D
    from ..functions import keys as Kk
    r = _dom(spark, sf_dir).bronze_readings
    return r.select(
        "_offset",
        X.coerce_numeric("percent_storage").alias("pct_num"),
        X.coerce_int("capacity_mcm").alias("cap_int"),
        X.first_truthy("reservoir_id", "reservoir_name").alias("first_id"),
        X.fill_default_string("owner", "none", blank_to_default=True).alias("owner_filled"),
        X.zero_pad(F.substring("reservoir_id", 2, 5).try_cast("int").cast("string"), 6).alias("padded"),
        X.clip(X.coerce_numeric("volume_mcm") / 20.0).alias("clipped"),
        X.parse_code_list(F.concat_ws(",", F.col("outflow_mcm").cast("double").cast("int").cast("string"),
                                      F.lit(" 63"), F.lit("x"), F.col("source"))).alias("codes"),
        D.date_key(D.to_date_lenient("record_date", F.col("dt").cast("date"))).alias("date_key"),
        D.month_start_key(F.substring("dt", 1, 4).cast("int"), F.pmod(F.col("_offset"), F.lit(13))).alias("month_key"),
        D.thai_month_name(F.month(F.col("dt").cast("date"))).alias("month_th"),
        Kk.reservoir_key("reservoir_id", "source").alias("rkey"),
        Kk.natural_int_key(F.substring("reservoir_id", 2, 5)).alias("nat_key"),
        F.datediff(F.date_add(F.col("dt").cast("date"), 30), F.date_sub(F.col("dt").cast("date"), 30)).alias("span"))


# ---------------------------------------------------------------- scans / sinks over written tables

def _weather_lake(spark, sf_dir):
    from .written import write_partitioned, written
    d = _dom(spark, sf_dir)
    return written(spark, sf_dir, "silver_weather",
                   lambda p: write_partitioned(d.silver_weather.drop("silver_loaded_at"), p))


def _ddl(cols, drop=("silver_loaded_at",)):
    return ", ".join(f"{c} {t}" for c, t in cols if c not in drop)


def _weather_schema():
    from ..plans.silver import SILVER_WEATHER_COLS
    return _ddl(SILVER_WEATHER_COLS)


def _read_weather(spark, sf_dir):
    """Written weather lake with an explicit schema (partition column typed, nothing inferred)."""
    return spark.read.schema(_weather_schema()).parquet(_weather_lake(spark, sf_dir))


@register("scan_partition")
def q_scan_partition(spark, sf_dir):
    from ..sources.io import scan_partition
    return scan_partition(spark, _weather_lake(spark, sf_dir), RUN_DATE, schema=_weather_schema())


@register("scan_latest_partition")
def q_scan_latest_partition(spark, sf_dir):
    """A run date with no partition -> the most recent partition."""
    from ..sources.lake import latest_partition
    return latest_partition(spark, _weather_lake(spark, sf_dir), "2099-01-01", _weather_schema())


@register("scan_all_if_empty")
def q_scan_all_if_empty(spark, sf_dir):
    """A run date with no partition -> every partition."""
    from ..sources.io import scan_all_if_empty
    return scan_all_if_empty(_read_weather(spark, sf_dir), "2099-01-01")


@register("scan_window")
def q_scan_window(spark, sf_dir):
    from ..plans.features import shift
    from ..sources.io import scan_window
    return scan_window(_read_weather(spark, sf_dir), shift(RUN_DATE, -6), RUN_DATE)


@register("scan_partition_dates")
def q_scan_partition_dates(spark, sf_dir):
    from ..sources.lake import listed_dates
    return listed_dates(spark, [_weather_lake(spark, sf_dir)], include=RUN_DATE)


@register("scan_mixed_formats")
def q_scan_mixed_formats(spark, sf_dir):
    """Hazard Silver partitioned by month: months 0-6 as Parquet, 7-12 as ORC, one folder."""
    from pyspark.sql import functions as F
    from ..sources.io import scan_mixed_formats
    from .written import write_partitioned, written
    d = _dom(spark, sf_dir)
    fr = d.silver_flood_risk.drop("silver_loaded_at")

    def build(p):
        write_partitioned(fr.where(F.col("month") <= 6), p, "parquet", ("month",))
        fr.where(F.col("month") > 6).hint("rebalance", "month").write.mode("append").format("orc").partitionBy("month").save(p)
    root = written(spark, sf_dir, "flood_risk_mixed", build)
    return scan_mixed_formats(spark, root, fr.schema).select(*fr.columns)


@register("sink_orc_partition")
def q_sink_orc_partition(spark, sf_dir):
    from pyspark.sql import functions as F
    from .written import write_partitioned, written
    d = _dom(spark, sf_dir)
    root = written(spark, sf_dir, "alerts_orc",
                   lambda p: write_partitioned(d.alerts.drop("loaded_at"), p, "orc", ("dt",)))
    from ..schemas import GOLD_TABLES
    schema = ", ".join(c for c in GOLD_TABLES["fact_flood_alert"][0].split(", ") if not c.startswith("loaded_at"))
    return spark.read.schema(schema).orc(root)


READING_FIELDS = ["_offset", "source", "reservoir_id", "reservoir_name", "region", "owner", "record_date",
                  "capacity_mcm", "volume_mcm", "percent_storage", "inflow_mcm", "outflow_mcm",
                  "active_storage_mcm", "dead_storage_mcm", "fetched_at", "dt"]
READING_SCHEMA = ", ".join(f"{c} {'BIGINT' if c == '_offset' else 'STRING'}" for c in READING_FIELDS)
DAM_SCHEMA = ", ".join(f"{c} {'BIGINT' if c == '_offset' else 'STRING'}" for c in READING_FIELDS if c != "owner")


def _ndjson_lake(spark, sf_dir):
    from .written import write_ndjson_by_source, written
    d = _dom(spark, sf_dir)
    return written(spark, sf_dir, "bronze_ndjson",
                   lambda p: write_ndjson_by_source(d.bronze_readings, p, drop_for_dam=("owner",)))


@register("scan_ndjson")
def q_scan_ndjson(spark, sf_dir):
    """Bronze NDJSON with truncated and blank lines: malformed dropped, blank ignored."""
    from ..sources.io import scan_ndjson
    return scan_ndjson(spark, _ndjson_lake(spark, sf_dir) + "/*", READING_SCHEMA)


@register("scan_union_sources")
def q_scan_union_sources(spark, sf_dir):
    """dam and reservoir folders with different key sets -> union of columns."""
    from ..sources.io import scan_ndjson, scan_union_sources
    root = _ndjson_lake(spark, sf_dir)
    return scan_union_sources([scan_ndjson(spark, f"{root}/dam", DAM_SCHEMA),
                               scan_ndjson(spark, f"{root}/reservoir", READING_SCHEMA)])


@register("scan_csv_bom")
def q_scan_csv_bom(spark, sf_dir):
    """Hazard rows round-tripped through a BOM-prefixed CSV, then cleaned to Silver."""
    from ..plans.silver import silver_flood_risk
    from ..sources.io import scan_csv, sink_csv_bom
    from .written import written
    d = _dom(spark, sf_dir)
    cols = d.hazard.columns
    root = written(spark, sf_dir, "hazard_csv", lambda p: sink_csv_bom(d.hazard, p, cols))
    schema = ", ".join(f"`{c}` {'BIGINT' if c == '_offset' else 'STRING'}" for c in cols)
    return silver_flood_risk(scan_csv(spark, root, schema)).drop("silver_loaded_at")


@register("flatten_nested_payload")
def q_flatten_nested_payload(spark, sf_dir):
    """Per-order API payloads {date, data:[{region, dam|reservoir:[...]}]} flattened and normalised."""
    from pyspark.sql import functions as F
    from ..sources.payloads import flatten_nested_payload, normalize_items
    # one shuffle serves both groupings: an order's readings of a day are in one task
    b = _dom(spark, sf_dir).bronze_readings.withColumn("_order", F.floor(F.col("_offset") / 8)).repartition("_order", "dt")
    item = F.struct(
        F.col("reservoir_id").alias("id"), F.col("reservoir_id").alias("reservoir_id"),
        F.col("reservoir_name").alias("name"), F.col("reservoir_name").alias("reservoir_name"),
        F.col("owner").alias("owner"), F.col("record_date").alias("report_date"), F.col("record_date").alias("date"),
        F.col("capacity_mcm").alias("capacity"), F.col("volume_mcm").alias("storage"),
        F.col("volume_mcm").alias("volume"), "percent_storage", F.col("inflow_mcm").alias("inflow"),
        F.col("outflow_mcm").alias("outflow"), F.col("active_storage_mcm").alias("active_storage"),
        F.col("dead_storage_mcm").alias("dead_storage"), "_offset")
    per_region = b.groupBy("_order", "source", "dt", "region").agg(F.collect_list(item).alias("items"))
    lists = [F.when(F.col("source") == child, F.col("items")).alias(child) for child in ("dam", "reservoir")]
    payload = per_region.groupBy("_order", "dt").agg(F.collect_list(F.struct("region", *lists)).alias("data"))
    js = payload.select(F.to_json(F.struct(F.col("dt").alias("date"), "data")).alias("value"))
    return normalize_items(flatten_nested_payload(js, "value", "dam", "reservoir"), RUN_DATE + "T00:00:00+07:00")


@register("extract_forecast_payload")
def q_extract_forecast_payload(spark, sf_dir):
    """Forecast payloads (scalar or {value, unit} numbers; some with an empty forecast list)."""
    from pyspark.sql import functions as F
    from ..sources.payloads import extract_forecast_payload
    w = _dom(spark, sf_dir).bronze_weather
    data = F.struct(F.col("temp_max_c").cast("double").alias("tc_max"),
                    F.struct(F.col("temp_min_c").cast("double").alias("value"), F.lit("C").alias("unit")).alias("tc_min"),
                    F.col("humidity_pct").cast("double").alias("rh"), F.col("rainfall_forecast_mm").cast("double").alias("rain"),
                    (F.pmod(F.col("_offset"), F.lit(20))).cast("double").alias("ws10m"))
    fc = F.array(F.struct(F.col("dt").alias("time"), data.alias("data")))
    fc = F.when(F.pmod(F.col("_offset"), F.lit(23)) == 0, F.filter(fc, lambda x: F.lit(False))).otherwise(fc)
    payload = F.to_json(F.struct(F.array(F.struct(
        F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("location"),
        fc.alias("forecasts"))).alias("WeatherForecasts")))
    js = w.select("_offset", "dt", payload.alias("payload"))
    return extract_forecast_payload(js, "payload")


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Drain a landing folder of JSON messages with an availableNow stream into Bronze buckets."""
    from ..session import scratch_path
    from ..streaming.ingest import MESSAGE_SCHEMA, file_source, stream_ingest
    from .written import LINES_A_FILE, message_lines, write_lines, written
    d = _dom(spark, sf_dir)
    landing = written(spark, sf_dir, "landing",
                      lambda p: write_lines(message_lines(d.bronze_readings, exclude=("_offset", "dt")), p, "overwrite", LINES_A_FILE))
    bronze, ck = scratch_path(spark, "bronze_stream"), scratch_path(spark, "bronze_stream_ck")
    stream_ingest(file_source(spark, landing), bronze, ck, today=RUN_DATE)
    return spark.read.schema(MESSAGE_SCHEMA + ", bucket_source STRING, bucket_date STRING, batch BIGINT").json(bronze).drop("batch")


@register("watermark_filter")
def q_watermark_filter(spark, sf_dir):
    from ..streaming.ingest import message_key, watermark_filter
    b = _dom(spark, sf_dir).bronze_readings
    return message_key(watermark_filter(b, RUN_DATE + "T03:00:00+07:00")).select("_offset", "fetched_at", "message_key")


# ---------------------------------------------------------------- remaining composites

@register("ingest_static_table")
def q_ingest_static_table(spark, sf_dir):
    """Idempotent load of the hazard CSV into the lake + one metadata row per load."""
    from pyspark.sql import functions as F
    from ..sources.io import scan_csv, sink_csv_bom
    from ..session import scratch_path
    from .written import written
    d = _dom(spark, sf_dir)
    cols = d.hazard.columns
    src = written(spark, sf_dir, "hazard_csv", lambda p: sink_csv_bom(d.hazard, p, cols))
    schema = ", ".join(f"`{c}` {'BIGINT' if c == '_offset' else 'STRING'}" for c in cols)
    dst = scratch_path(spark, "static_flood_risk")
    for _ in range(2):   # loading twice leaves one copy
        scan_csv(spark, src, schema).write.mode("overwrite").parquet(dst)
    loaded = spark.read.parquet(dst)
    return loaded.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("flood_risk_area.csv").alias("file"), "row_count",
        F.lit("Hazard history per sub-district and month").alias("description"))


@register("export_json_document")
def q_export_json_document(spark, sf_dir):
    """The alert export as one JSON document over several files, read back: its rows, and date and count of its head."""
    from ..session import scratch_path
    from ..plans.exports import ALERT_ORDER, export_alerts, export_json_document
    d = _dom(spark, sf_dir)
    out = scratch_path(spark, "alerts_json")
    export_json_document(export_alerts(d.alerts_once, _wx_day(d)), out, RUN_DATE, ALERT_ORDER)
    lines = spark.read.text(out)
    head = lines.where(F.col("value").startswith('{"date"'))
    count = head.select(F.regexp_extract("value", '"count":([0-9]+)', 1).cast("bigint")).scalar()
    date = head.select(F.regexp_extract("value", '"date":"([^"]+)"', 1)).scalar()
    schema = "alert_date DATE, prov_code INT, prov_th STRING, alert_level STRING, alert_score DOUBLE, trigger_reservoirs STRING"
    row = F.from_json(F.ltrim(F.col("value"), F.lit(",")), schema)
    rows = lines.where(F.ltrim(F.col("value"), F.lit(",")).startswith('{"alert_date"'))
    return rows.select(row.alias("r")).select("r.*", date.alias("date"), count.alias("count"))


@register("export_json_snapshot")
def q_export_json_snapshot(spark, sf_dir):
    """{date, count, data:[...]} envelope of the alert export, decoded back to check it."""
    from pyspark.sql import functions as F
    from ..plans.exports import export_alerts, json_snapshot
    d = _dom(spark, sf_dir)
    js = json_snapshot(export_alerts(d.alerts_once, _wx_day(d)), RUN_DATE)
    env = js.select(F.from_json("json", "date STRING, count BIGINT, data ARRAY<STRUCT<prov_code: INT, alert_score: DOUBLE>>")
                    .alias("e"))
    return env.select(F.col("e.date").alias("date"), F.col("e.count").alias("count"),
                      F.size("e.data").alias("n_data"),
                      F.aggregate("e.data", F.lit(0.0), lambda acc, x: acc + x["alert_score"]).alias("score_sum"))


@register("agg_dq_history")
def q_agg_dq_history(spark, sf_dir):
    """Per run: passed / total rule counts and the overall verdict."""
    from pyspark.sql import functions as F
    from ..operators.quality import dq_report
    rep = dq_report(_dom(spark, sf_dir).silver_reservoir, "silver_reservoir", group=["dt"])
    return rep.groupBy(F.col("dt").alias("run_date")).agg(
        F.count_if(F.col("status") == "PASS").alias("passed"), F.count(F.lit(1)).alias("total"),
        F.when(F.count_if((F.col("status") == "FAIL") & F.col("critical")) > 0, F.lit("FAIL"))
        .otherwise(F.lit("PASS")).alias("overall"))


@register("bronze_weather_record")
def q_bronze_weather_record(spark, sf_dir):
    """Catalogue provinces with the run day's extracted API forecast, generated values elsewhere."""
    from pyspark.sql import functions as F
    from ..plans.weather import bronze_weather_record
    d = _dom(spark, sf_dir)
    api = (d.weather_day
           .select(F.col("prov_code").cast("int").alias("prov_code"), "temp_max_c", "temp_min_c",
                   "rainfall_forecast_mm", "humidity_pct", "wind_speed_kmh"))
    gen = d.provinces.select("prov_code", F.lit(31.0).alias("temp_max_c"), F.lit(24.0).alias("temp_min_c"),
                             (F.col("lat") * 3.0).alias("rainfall_forecast_mm"), F.lit(70.0).alias("humidity_pct"),
                             F.lit(10.8).alias("wind_speed_kmh"))
    return bronze_weather_record(d.provinces, api, gen, RUN_DATE, RUN_DATE + "T06:00:00+07:00")


@register("fact_flood_alert_daily")
def q_fact_flood_alert_daily(spark, sf_dir):
    """Alert scoring for every day and province in one job (backfill form)."""
    from ..plans.features import reservoir_features_daily
    from ..plans.scoring import fact_flood_alert_daily
    d = _dom(spark, sf_dir)
    return fact_flood_alert_daily(reservoir_features_daily(d.silver_reservoir), d.silver_weather,
                                  d.silver_flood_risk, d.downstream_map).drop("loaded_at")


@register("fact_flood_alert_resolved")
def q_fact_flood_alert_resolved(spark, sf_dir):
    """The alerts of all days with the keys of the location and weather dimensions."""
    from ..plans.features import reservoir_features_daily
    from ..plans.scoring import fact_flood_alert_daily, resolve_alert_keys
    from ..plans.star import dim_weather
    d = _dom(spark, sf_dir)
    alerts = fact_flood_alert_daily(reservoir_features_daily(d.silver_reservoir), d.silver_weather, d.silver_flood_risk, d.downstream_map)
    return resolve_alert_keys(alerts, d.dim_location, dim_weather(d.silver_weather)).drop("loaded_at")


@register("load_downstream_map")
def q_load_downstream_map(spark, sf_dir):
    """Map rows with the comma-joined province codes parsed to an int array."""
    from ..functions.coerce import parse_code_list
    m = _dom(spark, sf_dir).downstream_map
    return m.select("reservoir_name_th", "reservoir_name_en", "downstream_prov_codes",
                    parse_code_list("downstream_prov_codes").alias("downstream_prov_list"))


@register("agg_max_watermark")
def q_agg_max_watermark(spark, sf_dir):
    """High-water mark (max fetched_at) of the accepted messages, per source."""
    from pyspark.sql import functions as F
    from ..streaming.ingest import watermark_filter
    acc = watermark_filter(_dom(spark, sf_dir).bronze_readings)
    return acc.groupBy("source").agg(F.max("fetched_at").alias("last_fetched_at"), F.count(F.lit(1)).alias("accepted"))


@register("silver_flood_risk_domain")
def q_silver_flood_risk_domain(spark, sf_dir):
    from ..plans.silver import silver_flood_risk_domain
    return silver_flood_risk_domain(_dom(spark, sf_dir).silver_flood_risk).drop("silver_loaded_at")


@register("export_csv_bom")
def q_export_csv_bom(spark, sf_dir):
    """Alert CSV written with a BOM and fixed column order, read back (CSV keeps no NULL/'' distinction)."""
    from pyspark.sql import functions as F
    from ..plans.exports import ALERT_CSV_COLS, export_alerts, export_alerts_csv
    from ..sources.io import scan_csv, sink_csv_bom
    from ..session import scratch_path
    d = _dom(spark, sf_dir)
    out = scratch_path(spark, "alerts_csv")
    sink_csv_bom(export_alerts_csv(export_alerts(d.alerts_once, _wx_day(d)), d.provinces), out, ALERT_CSV_COLS)
    schema = ("alert_date DATE, prov_code INT, prov_th STRING, alert_level STRING, alert_level_en STRING, "
              "alert_score DOUBLE, reservoir_score DOUBLE, weather_score DOUBLE, historical_risk_score DOUBLE, "
              "trigger_reservoirs STRING, max_reservoir_pct DOUBLE, rainfall_forecast_mm DOUBLE, "
              "historical_risk_level STRING, affected_subdistricts_count BIGINT, lat DOUBLE, lon DOUBLE, "
              "region_en STRING")
    back = scan_csv(spark, out, schema)
    strings = ["prov_th", "alert_level", "alert_level_en", "trigger_reservoirs", "historical_risk_level", "region_en"]
    return back.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in strings})


@register("process_all_dates")
def q_process_all_dates(spark, sf_dir):
    """Backfill summary: Silver rows per partition date for both daily tables, from one job each."""
    from pyspark.sql import functions as F
    d = _dom(spark, sf_dir)
    r = d.silver_reservoir.groupBy("dt").agg(F.count(F.lit(1)).alias("reservoir_rows"))
    w = d.silver_weather.groupBy("dt").agg(F.count(F.lit(1)).alias("weather_rows"))
    return r.join(w, "dt", "full").select("dt", F.coalesce("reservoir_rows", F.lit(0)).alias("reservoir_rows"),
                                          F.coalesce("weather_rows", F.lit(0)).alias("weather_rows"))


@register("fn_pad_variants")
def q_fn_pad_variants(spark, sf_dir):
    """zfill-style pad (never truncates) vs SQL LPAD (truncates) on hazard geocodes."""
    from pyspark.sql import functions as F
    from ..functions.coerce import zero_pad
    h = _dom(spark, sf_dir).hazard
    long_code = F.concat(F.col("GEOCODE"), F.lit("00"), F.col("GEOCODE"))
    return h.select("_offset", zero_pad("GEOCODE", 6).alias("zfill_short"), zero_pad(long_code, 6).alias("zfill_long"),
                    F.lpad(long_code, 6, "0").alias("lpad_long"))


@register("silver_reservoir_sql")
def q_silver_reservoir_sql(spark, sf_dir):
    from ..plans.silver_sql import silver_reservoir_sql
    return silver_reservoir_sql(_dom(spark, sf_dir).bronze_readings).drop("silver_loaded_at")


@register("silver_weather_sql")
def q_silver_weather_sql(spark, sf_dir):
    from ..plans.silver_sql import silver_weather_sql
    return silver_weather_sql(_dom(spark, sf_dir).bronze_weather).drop("silver_loaded_at")


@register("silver_flood_risk_sql")
def q_silver_flood_risk_sql(spark, sf_dir):
    from ..plans.silver_sql import silver_flood_risk_sql
    return silver_flood_risk_sql(_dom(spark, sf_dir).hazard).drop("silver_loaded_at")


# ---------------------------------------------------------------- written Gold, states, gates

@register("join_fact_dim")
def q_join_fact_dim(spark, sf_dir):
    """Facts with the surrogate keys of the reservoir dimension."""
    from ..plans.star import fact_water
    d = _dom(spark, sf_dir)
    return fact_water(d.silver_reservoir, d.dim_reservoir).drop("loaded_at")


@register("derive_flag")
def q_derive_flag(spark, sf_dir):
    """A weather feed without the heavy-rain flag: it is derived from the rainfall."""
    from ..plans.silver import silver_weather
    return silver_weather(_dom(spark, sf_dir).bronze_weather.drop("is_heavy_rain_24h")).drop("silver_loaded_at")


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    """The gate's verdict for every day's report."""
    from ..operators.quality import dq_report, gate_verdicts
    return gate_verdicts(dq_report(_staged(_dom(spark, sf_dir)), "staged_reservoir", group=["dt"]), ["dt"])


@register("sink_dq_report")
def q_sink_dq_report(spark, sf_dir):
    """Reports written by day and read back."""
    from ..operators.quality import dq_report
    from ..session import scratch_path
    from ..sources.io import sink_partitioned
    report = dq_report(_staged(_dom(spark, sf_dir)), "staged_reservoir", group=["dt"])
    path = scratch_path(spark, "dq_reports")
    sink_partitioned(report, path)
    return spark.read.schema(report.schema).parquet(path).select("dt", "rule", "status", "critical", "total_rows", "failed_rows")


@register("insert_overwrite_partition")
def q_insert_overwrite_partition(spark, sf_dir):
    """INSERT OVERWRITE of the run day's partition of a catalogue table that holds all days."""
    import uuid
    from ..session import scratch_path
    from ..sources.io import insert_overwrite_partition, register_external, sink_partitioned
    d = _dom(spark, sf_dir)
    name, path, cols = f"weather_{uuid.uuid4().hex[:12]}", scratch_path(spark, "weather_table"), _weather_schema()
    sink_partitioned(d.silver_weather.drop("silver_loaded_at"), path)
    register_external(spark, name, cols, path)
    try:
        insert_overwrite_partition(spark, name, d.weather_day.drop("silver_loaded_at"))
    finally:
        spark.sql(f"DROP TABLE {name}")     # external: the files stay
    return spark.read.schema(cols).parquet(path)


@register("mart_from_lake")
def q_mart_from_lake(spark, sf_dir):
    """The 30-day mart over Gold tables written to the lake and read back."""
    from ..plans import daily
    from ..plans.star import fact_water
    from ..session import scratch_path
    from ..sources.io import sink_partitioned
    d, lake = _dom(spark, sf_dir), scratch_path(spark, "lake")
    p = daily.paths(lake)
    d.dim_reservoir.write.parquet(p["dim_reservoir"])
    d.dim_date.write.parquet(p["dim_date"])
    d.dim_location.write.parquet(p["dim_location"])
    sink_partitioned(d.dim_weather, p["dim_weather"])
    sink_partitioned(d.fact_flood_risk, p["fact_flood_risk"])
    sink_partitioned(fact_water(d.silver_reservoir, spark.read.parquet(p["dim_reservoir"])), p["fact_water"])
    return daily.marts_from_lake(spark, lake, RUN_DATE)["mart_30d_trend"]


@register("export_alerts_latest")
def q_export_alerts_latest(spark, sf_dir):
    """Export for a day without alerts, in a lake without any: the latest weather partition."""
    from pyspark.sql import functions as F
    from ..plans.exports import day_or_latest, export_alerts
    d = _dom(spark, sf_dir)
    return export_alerts(day_or_latest(d.alerts_once.where(F.col("dt") < "1900-01-01"), "2099-01-01"), day_or_latest(d.silver_weather, "2099-01-01"))


@register("watermark_state")
def q_watermark_state(spark, sf_dir):
    """The mark saved after a load, and how many messages a second load would still accept."""
    from pyspark.sql import functions as F
    from ..session import scratch_path
    from ..streaming.ingest import watermark_filter
    from ..streaming.state import load_watermark, save_watermark
    b, state = _dom(spark, sf_dir).bronze_readings, scratch_path(spark, "watermark")
    save_watermark(spark, state, watermark_filter(b, load_watermark(spark, state)))
    mark = load_watermark(spark, state)
    return watermark_filter(b, mark).agg(F.lit(mark).alias("watermark"), F.count(F.lit(1)).alias("still_accepted"))


@register("producer_state")
def q_producer_state(spark, sf_dir):
    """The ledger after two batches of forecast days."""
    from pyspark.sql import functions as F
    from ..streaming.state import update_ledger
    days = _dom(spark, sf_dir).bronze_weather.select(F.col("dt").alias("fetch_date")).distinct()
    first = update_ledger(None, days.where(F.col("fetch_date") < RUN_DATE))
    return update_ledger(first, days.where(F.col("fetch_date") >= RUN_DATE))


@register("backfill_dates")
def q_backfill_dates(spark, sf_dir):
    """Days that a first run on the run date fetches, with the forecasts that there are for them."""
    from pyspark.sql import functions as F
    from ..streaming.state import backfill_dates
    days = backfill_dates(spark, RUN_DATE, 30).select(F.date_format("fetch_date", "yyyy-MM-dd").alias("dt"))
    found = _dom(spark, sf_dir).bronze_weather.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
    return days.join(found, "dt", "left").select("dt", F.coalesce("n", F.lit(0)).alias("forecasts"))


from . import lake  # noqa: E402, F401  (registers its queries)
