"""Gold kept day by day: dimension states that grow by one partition, and backfills gated per date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import availability_rows, dq_report, gate_verdicts
from ..schemas import GOLD_TABLES
from ..sources import io, lake
from . import daily, features, scoring, silver, star


def advance_state(spark: SparkSession, root: str, silver_root: str, run_date: str, silver_schema: str, first: str | None = None) -> DataFrame:
    """The reservoir state through ``run_date``: the newest state before ``first`` (by default the run date),
    merged with the Silver of the days since, as a rule one partition.

    States are stored as ``root/through=<day>``.  A day that runs again starts from the state before it, so a
    mended reading leaves nothing behind; states stored for later days are then brought up to date in order, each
    from the days between the one before and itself.  The first state of all aggregates Silver up to its day.
    """
    have = lake.partition_values(spark, root, "through")
    first = first or run_date
    known = [x for x in have if x < first]
    for d in sorted({run_date, *(x for x in have if x >= first)}):
        state = star.reservoir_state(new_days(spark, silver_root, silver_schema, known, d))
        if known:
            state = star.merge_states(stored_state(spark, root, known[-1]), state)
        state.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/through={d}")
        known.append(d)
    return stored_state(spark, root, known[-1])


def new_days(spark: SparkSession, silver_root: str, silver_schema: str, known: list[str], day: str) -> DataFrame:
    """Silver of the days after the last known state, through ``day``: only their folders are listed and read."""
    if not known:
        return spark.read.schema(silver_schema).parquet(silver_root).where(F.col("dt") <= day)
    days = lake.partition_values(spark, silver_root, above=known[-1], through=day)
    return lake.read_partitions(spark, silver_root, days, silver_schema)


def stored_state(spark: SparkSession, root: str, through: str) -> DataFrame:
    return spark.read.schema(star.RESERVOIR_STATE).parquet(f"{root}/through={through}")


def gate_by_date(spark: SparkSession, silver_rows: DataFrame, table: str, first: str, last: str, report_path: str) -> DataFrame:
    """dt, critical_failures, halts of every date from ``first`` to ``last``, judged in one job.

    The reports of all dates are written by date (a date that runs again replaces its own) and the verdicts come
    from what was written.  A date without rows has the availability failure, like an empty day of a single run.
    """
    dates = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("dt")).select(F.col("dt").cast("string"))
    span = silver_rows.where(F.col("dt").between(first, last))
    report = dq_report(span, table, group=["dt"])
    empty = availability_rows(dates.join(span.select("dt").distinct(), "dt", "left_anti"), table)
    io.sink_partitioned(report.unionByName(empty).withColumnRenamed("dt", "run_date"), report_path, part_cols=("run_date",))
    written = spark.read.schema(report.withColumnRenamed("dt", "run_date").schema).parquet(report_path)
    verdicts = gate_verdicts(written.where(F.col("run_date").between(first, last)), ["run_date"])
    return verdicts.withColumnRenamed("run_date", "dt")


def passing(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of the dates that the gate lets through; halted dates (as many as days) are left out by an anti join."""
    return df.join(F.broadcast(verdicts.where("halts").select("dt")), "dt", "left_anti")


def run_backfill(spark: SparkSession, first: str, last: str, root: str, bronze_readings: DataFrame, bronze_weather: DataFrame,
                 hazard: DataFrame, downstream_map: DataFrame) -> dict[str, str]:
    """The daily run's tables for all days from ``first`` to ``last``, one job a table; returns their paths.

    As in a single run, Silver and its reports are written for every day and the gate decides what goes on to Gold:
    halted days keep the Gold partitions that they had, the others are replaced by dynamic overwrite.
    """
    p = daily.paths(root)
    span = F.col("dt").between(first, last)
    io.sink_partitioned(silver.silver_reservoir(bronze_readings.where(span)), p["silver_reservoir"])
    io.sink_partitioned(silver.silver_weather(bronze_weather.where(span)), p["silver_weather"])
    lake.replace_table(silver.silver_flood_risk(hazard), p["silver_flood_risk"])
    res_ddl = daily.ddl(silver.SILVER_RESERVOIR_COLS)
    sres = spark.read.schema(res_ddl).parquet(p["silver_reservoir"])
    swx = spark.read.schema(daily.ddl(silver.SILVER_WEATHER_COLS)).parquet(p["silver_weather"])
    srisk = lake.read_current(spark, p["silver_flood_risk"], daily.ddl(silver.SILVER_FLOOD_RISK_COLS))
    verdicts = gate_by_date(spark, sres, "silver_reservoir", first, last, p["dq"])

    state = advance_state(spark, p["dim_reservoir_state"], p["silver_reservoir"], last, res_ddl, first)
    dims = {"dim_reservoir": star.dim_from_state(state, crosswalk_region=True), "dim_date": star.dates_from_state(state),
            "dim_location": star.dim_location(srisk)}
    gold = {k: lake.read_current(spark, p[k], GOLD_TABLES[k][0]) for k in dims if lake.replace_table(dims[k], p[k])}
    io.sink_partitioned(star.dim_weather(passing(swx.where(span), verdicts)), p["dim_weather"])
    wx = spark.read.schema(GOLD_TABLES["dim_weather"][0]).parquet(p["dim_weather"]).where(span)
    io.sink_partitioned(star.fact_water(passing(sres.where(span), verdicts), gold["dim_reservoir"]), p["fact_water"])
    io.sink_partitioned(star.fact_flood_risk_daily(srisk, gold["dim_location"], passing(wx, verdicts)), p["fact_flood_risk"])

    history = sres.where(F.col("dt").between(features.shift(first, 1 - features.LOOKBACK), last))
    feats = passing(features.reservoir_features_daily(history).withColumn("dt", F.col("feature_date").cast("string")).where(span), verdicts)
    io.sink_partitioned(feats, p["features"])
    feats = spark.read.schema(feats.schema).parquet(p["features"]).where(span)
    alerts = scoring.fact_flood_alert_daily(passing(feats, verdicts), passing(swx.where(span), verdicts), srisk, downstream_map)
    io.sink_partitioned(alerts, p["alerts"], "orc")
    return p
