"""Lazily-built domain frames over one test-data folder (one place that wires
adapters -> Silver -> Gold -> features -> alerts for the registered queries)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..plans import features as feat
from ..plans import scoring, silver, star
from ..schemas import GOLD_TABLES
from ..session import scratch_path
from ..sources import adapters

# The run date every daily query uses (a job parameter, never current_date).
RUN_DATE = "1998-06-15"
DIM_DATE_FROM = "1992-01-01"


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str, run_date: str = RUN_DATE):
        self.spark, self.sf_dir, self.run_date = spark, sf_dir, run_date

    # raw
    @cached_property
    def bronze_readings(self) -> DataFrame:
        return adapters.bronze_readings(self.spark, self.sf_dir)

    @cached_property
    def bronze_weather(self) -> DataFrame:
        return adapters.bronze_weather(self.spark, self.sf_dir)

    @cached_property
    def hazard(self) -> DataFrame:
        return adapters.hazard_rows(self.spark, self.sf_dir)

    @cached_property
    def downstream_map(self) -> DataFrame:
        return adapters.downstream_map(self.spark, self.sf_dir)

    @cached_property
    def part_map(self) -> DataFrame:
        return adapters.part_map(self.spark, self.sf_dir)

    @cached_property
    def provinces(self) -> DataFrame:
        return adapters.province_catalogue(self.spark, self.sf_dir)

    # silver
    @cached_property
    def silver_reservoir(self) -> DataFrame:
        return silver.silver_reservoir(self.bronze_readings)

    @cached_property
    def silver_weather(self) -> DataFrame:
        return silver.silver_weather(self.bronze_weather)

    @cached_property
    def silver_flood_risk(self) -> DataFrame:
        return silver.silver_flood_risk(self.hazard)

    # Silver of the run day, or the days up to it: the range is a pushed filter of the raw scan
    def readings_window(self, days: int) -> DataFrame:
        """Silver readings of the ``days`` days that end with the run day."""
        span = (feat.shift(self.run_date, 1 - days), self.run_date)
        return silver.silver_reservoir(adapters.bronze_readings(self.spark, self.sf_dir, span))

    @cached_property
    def readings_day(self) -> DataFrame:
        return self.readings_window(1)

    @cached_property
    def weather_day(self) -> DataFrame:
        return silver.silver_weather(adapters.bronze_weather(self.spark, self.sf_dir, (self.run_date, self.run_date)))

    # gold
    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date(self.spark, DIM_DATE_FROM)

    @cached_property
    def dim_reservoir(self) -> DataFrame:
        return star.dim_reservoir(self.silver_reservoir)

    @cached_property
    def dim_location(self) -> DataFrame:
        return star.dim_location(self.silver_flood_risk)

    @cached_property
    def dim_weather(self) -> DataFrame:
        return star.dim_weather(self.weather_day, self.run_date)

    @cached_property
    def fact_water(self) -> DataFrame:
        return star.fact_water(self.silver_reservoir, None)   # dim derives from the same Silver

    @cached_property
    def fact_flood_risk(self) -> DataFrame:
        return star.fact_flood_risk(self.silver_flood_risk, self.dim_location, self.dim_weather, self.run_date)

    # features / alerts
    @cached_property
    def features(self) -> DataFrame:
        return feat.reservoir_features(self.readings_window(feat.LOOKBACK), self.run_date)

    @cached_property
    def alerts(self) -> DataFrame:
        return scoring.fact_flood_alert(self.features, self.weather_day, self.silver_flood_risk,
                                        self.downstream_map, self.run_date)

    @cached_property
    def alerts_once(self) -> DataFrame:
        """The alerts as a written Gold table: an export that looks at them more than once (any rows? which day?) plans them once."""
        path = scratch_path(self.spark, "gold_alerts")
        self.alerts.write.partitionBy("dt").orc(path)
        return self.spark.read.schema(GOLD_TABLES["fact_flood_alert"][0]).orc(path)
