"""The daily run: ingest -> Silver -> DQ gate -> Gold -> features -> alerts -> exports.

A plain function calling the transforms in order (no scheduler).  Every step
writes a table under ``lake`` (dynamic partition overwrite, so a re-run of a
day replaces that day only) and later steps read those tables back with their
schemas, which cuts the lineage between steps and lets an empty day through to
the gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import dq_gate, dq_summary, observe_rules, unique_rule
from ..schemas import GOLD_TABLES
from ..sources import io, lake as folders
from . import exports, features, marts, scoring, silver, star

TABLES = ("silver_reservoir", "silver_weather", "silver_flood_risk", "dq", "dim_reservoir_state", "dim_date", "dim_reservoir", "dim_location",
          "dim_weather", "fact_water", "fact_flood_risk", "features", "alerts", "export_alerts", "export_alerts_csv",
          "export_alerts_json", "document_alerts_json", "export_reservoirs", "export_reservoirs_csv", "export_reservoirs_json",
          "document_reservoirs_json", "export_meta")

#: Tables that are refreshed whole: each run adds a version, readers see the newest complete one.
VERSIONED = ("silver_flood_risk", "dim_date", "dim_reservoir", "dim_location")


def paths(lake: str) -> dict[str, str]:
    return {k: f"{lake.rstrip('/')}/{k}" for k in TABLES}


def ddl(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{c} {t}" for c, t in columns)


def run_daily(spark: SparkSession, run_date: str, lake: str, bronze_readings: DataFrame, bronze_weather: DataFrame,
              hazard: DataFrame, downstream_map: DataFrame, provinces: DataFrame) -> dict[str, str]:
    """Run one day end to end; returns the written table paths."""
    from .incremental import advance_state

    p = paths(lake)
    day = F.col("dt") == run_date
    # the rules are counted while Silver is written; only uniqueness reads the day's keys again
    readings = silver.silver_reservoir(bronze_readings.where(day))
    watch, rules = observe_rules(readings, "silver_reservoir")
    io.sink_partitioned(readings, p["silver_reservoir"], watch=watch)
    io.sink_partitioned(silver.silver_weather(bronze_weather.where(day)), p["silver_weather"])
    folders.replace_table(silver.silver_flood_risk(hazard), p["silver_flood_risk"])

    res_ddl = ddl(silver.SILVER_RESERVOIR_COLS)
    sres = spark.read.schema(res_ddl).parquet(p["silver_reservoir"])
    swx = spark.read.schema(ddl(silver.SILVER_WEATHER_COLS)).parquet(p["silver_weather"])
    srisk = folders.read_current(spark, p["silver_flood_risk"], ddl(silver.SILVER_FLOOD_RISK_COLS))

    # the report replaces that of an earlier run of the day, and the gate judges this report alone
    report = rules().unionByName(unique_rule(sres.where(day), "silver_reservoir")).withColumn("run_date", F.lit(run_date))
    (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(p["dq"]))
    report = spark.read.schema(report.schema).parquet(p["dq"]).where(F.col("run_date") == run_date)
    dq_gate(report)   # halts on a critical failure

    # dimensions: yesterday's state and the day's Silver, published as whole versions
    state = advance_state(spark, p["dim_reservoir_state"], p["silver_reservoir"], run_date, res_ddl)
    folders.replace_table(star.dates_from_state(state), p["dim_date"])
    folders.replace_table(star.dim_from_state(state, crosswalk_region=True), p["dim_reservoir"])
    folders.replace_table(star.dim_location(srisk), p["dim_location"])
    io.sink_partitioned(star.dim_weather(swx, run_date), p["dim_weather"])
    gold = {k: folders.read_current(spark, p[k], GOLD_TABLES[k][0]) for k in ("dim_reservoir", "dim_location", "dim_weather")}
    io.sink_partitioned(star.fact_water(sres, gold["dim_reservoir"], run_date), p["fact_water"])
    io.sink_partitioned(star.fact_flood_risk(srisk, gold["dim_location"], gold["dim_weather"], run_date), p["fact_flood_risk"])

    feats = features.reservoir_features(sres, run_date).withColumn("dt", F.lit(run_date))
    io.sink_partitioned(feats, p["features"])
    feats = spark.read.schema(feats.schema).parquet(p["features"]).where(day)
    io.sink_partitioned(scoring.fact_flood_alert(feats, swx, srisk, downstream_map, run_date), p["alerts"], "orc")

    # the day's partition or the latest, by the listing: no other day's file is opened
    alerts = folders.latest_partition(spark, p["alerts"], run_date, GOLD_TABLES["fact_flood_alert"][0], "orc")
    latest_wx = folders.latest_partition(spark, p["silver_weather"], run_date, ddl(silver.SILVER_WEATHER_COLS))
    exports.export_alerts(alerts, latest_wx).write.mode("overwrite").parquet(p["export_alerts"])
    exports.export_reservoirs(sres.where(day), feats).write.mode("overwrite").parquet(p["export_reservoirs"])
    out_alerts, out_res = (spark.read.parquet(p[k]) for k in ("export_alerts", "export_reservoirs"))
    io.sink_csv_bom(exports.export_alerts_csv(out_alerts, provinces), p["export_alerts_csv"], exports.ALERT_CSV_COLS)
    io.sink_csv_bom(exports.export_reservoirs_csv(out_res), p["export_reservoirs_csv"], exports.RESERVOIR_EXPORT_COLS)
    for name, frame, order in (("alerts_json", out_alerts, exports.ALERT_ORDER), ("reservoirs_json", out_res, exports.RESERVOIR_ORDER)):
        exports.nan_to_null(frame).write.mode("overwrite").option("ignoreNullFields", False).json(p[f"export_{name}"])
        exports.export_json_document(frame, p[f"document_{name}"], run_date, order)
    exports.export_meta_row(run_date, out_res, out_alerts, dq_summary(report)).write.mode("overwrite").json(p["export_meta"])
    return {k: folders.current_version(spark, v) if k in VERSIONED else v for k, v in p.items()}


def marts_from_lake(spark: SparkSession, lake: str, run_date: str) -> dict[str, DataFrame]:
    """The three marts over the written Gold tables."""
    p = paths(lake)

    def gold(name: str, schema: str | None = None) -> DataFrame:
        return folders.read_current(spark, p[name], GOLD_TABLES[schema or name][0])

    water, dates = gold("fact_water", "fact_water_monitoring"), gold("dim_date")
    # dim_weather is one run's table in these marts
    weather = gold("dim_weather").where(F.col("dt") == run_date)
    risk = gold("fact_flood_risk").where(F.col("dt") == run_date)
    return {"mart_30d_trend": marts.mart_30d_trend(water, gold("dim_reservoir"), dates, run_date),
            "mart_hot_reservoirs": marts.mart_hot_reservoirs(water, gold("dim_reservoir"), dates, gold("dim_location"), weather, run_date),
            "mart_top10_subdistricts": marts.mart_top10_subdistricts(risk, gold("dim_location"), weather, run_date)}
