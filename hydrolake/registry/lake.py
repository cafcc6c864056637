"""Registered queries over written tables: streaming state, incremental and atomic Gold, gates, buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.quality import observe_rules
from ..plans import incremental, marts, silver, star
from ..plans.daily import ddl
from ..plans.features import shift
from ..schemas import GOLD_TABLES
from ..session import scratch_path
from ..sources import adapters, io, lake
from ..streaming import state as run_state
from ..streaming.ingest import MESSAGE_SCHEMA, file_source, incremental_load, message_key, stream_ingest
from .domain import RUN_DATE, Domain
from .queries import READING_SCHEMA, _ndjson_lake, register
from .written import LINES_A_FILE, message_lines, write_lines

#: Days of the backfill row, and the one that is spoilt.
BACKFILL_DAYS, SPOILT_DAY = (shift(RUN_DATE, -9), RUN_DATE), shift(RUN_DATE, -4)
BUCKETS = 16


def _lines(bronze):
    return message_lines(bronze, exclude=("_offset", "dt")).select("value")


@register("incremental_load")
def q_incremental_load(spark, sf_dir):
    """Two loads: the log up to the run date, then the rest with a third of the old messages sent again.  Per run: the
    mark, the messages accepted by the state, and those found in Bronze."""
    bronze = Domain(spark, sf_dir).bronze_readings
    landing, out, ck, marks = (scratch_path(spark, n) for n in ("landing", "bronze", "checkpoint", "marks"))
    old = F.col("dt") < RUN_DATE
    write_lines(_lines(bronze.where(old)), landing, lines_a_file=LINES_A_FILE)
    incremental_load(file_source(spark, landing), out, ck, marks, RUN_DATE)
    write_lines(_lines(bronze.where(~old | (F.col("_offset") % 3 == 0))), landing, "append", LINES_A_FILE)
    incremental_load(file_source(spark, landing), out, ck, marks, RUN_DATE)
    found = spark.read.schema("fetched_at STRING, batch BIGINT").json(out).groupBy("batch").agg(F.count(F.lit(1)).alias("found"))
    return (run_state.batches(spark, marks).join(found, "batch", "left").groupBy("run")
            .agg(F.max("last_fetched_at").alias("mark"), F.sum("accepted").alias("accepted"), F.sum("found").alias("bronze_rows")))


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """A log in which a third of the messages come again in later files: each lands once."""
    bronze = Domain(spark, sf_dir).bronze_readings
    landing, out, ck = (scratch_path(spark, n) for n in ("landing", "bronze", "checkpoint"))
    write_lines(_lines(bronze), landing)
    write_lines(_lines(bronze.where(F.col("_offset") % 3 == 0)), landing, "append")
    # the log is written out of order over its whole span: no message is late
    stream_ingest(file_source(spark, landing, max_files_per_batch=4), out, ck, today=RUN_DATE, dedup_within="4000 days")
    return message_key(lake.read_json_folders(spark, out, MESSAGE_SCHEMA)).select("message_key", "fetched_at")


@register("producer_ledger")
def q_producer_ledger(spark, sf_dir):
    """The stored ledger after two runs, the second of which ran twice, and the date to fetch next."""
    days = Domain(spark, sf_dir).bronze_weather.select(F.col("dt").alias("fetch_date")).distinct()
    path = scratch_path(spark, "ledger")
    run_state.record_run(days.where(F.col("fetch_date") < RUN_DATE), path, "first")
    for _ in range(2):
        run_state.record_run(days.where(F.col("fetch_date") >= RUN_DATE), path, "second")
    nxt = run_state.next_fetch_dates(spark, path, RUN_DATE, 30).agg(F.max("fetch_date").cast("string").alias("next_date"), F.count(F.lit(1)).alias("n_next"))
    row = nxt.first()       # one row
    return run_state.ledger(spark, path).select("*", F.lit(row.next_date).alias("next_date"), F.lit(row.n_next).alias("n_next"))


def _silver_lake(spark, sf_dir) -> str:
    path = scratch_path(spark, "silver_reservoir")
    io.sink_partitioned(Domain(spark, sf_dir).silver_reservoir, path)
    return path


@register("dim_reservoir_incremental")
def q_dim_reservoir_incremental(spark, sf_dir):
    """The dimension after three daily merges on top of a first state; equals one built over all days."""
    path, states, schema = _silver_lake(spark, sf_dir), scratch_path(spark, "states"), ddl(silver.SILVER_RESERVOIR_COLS)
    for d in (shift(RUN_DATE, -3), shift(RUN_DATE, -2), shift(RUN_DATE, -1), RUN_DATE):
        state = incremental.advance_state(spark, states, path, d, schema)
    return star.dim_from_state(state)


@register("insert_overwrite_table")
def q_insert_overwrite_table(spark, sf_dir):
    """Full refresh of a catalogue table: a reader from before keeps the old version whole, a new one sees the new."""
    d, name, root = Domain(spark, sf_dir), f"dim_{uuid.uuid4().hex[:12]}", scratch_path(spark, "dim_versions")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.dim_reservoir.schema)
    lake.publish(spark, name, cols, lake.replace_table(star.dim_reservoir(d.silver_reservoir.where(F.col("dt") <= RUN_DATE)), root))
    try:
        old = spark.table(name)
        # the new version is computed while the old one is being read
        new = lake.replace_table(d.dim_reservoir.join(old.select("reservoir_key", F.lit(1).alias("_known")), "reservoir_key", "left").drop("_known"), root)
        lake.publish(spark, name, cols, new)
        return spark.table(name).select("*", F.lit("new").alias("version")).unionByName(old.select("*", F.lit("old").alias("version")))
    finally:
        spark.sql(f"DROP TABLE {name}")     # external: the files stay


@register("dq_availability")
def q_dq_availability(spark, sf_dir):
    """Rules observed while Silver is written, for the run day and for a day without data."""
    out = []
    for day, rows in ((RUN_DATE, Domain(spark, sf_dir).readings_day), ("2099-01-01", Domain(spark, sf_dir, "2099-01-01").readings_day)):
        rows = rows.where(F.col("dt") == day)
        watch, report = observe_rules(rows, "silver_reservoir")
        io.sink_partitioned(rows, scratch_path(spark, "silver_day"), watch=watch)
        out.append(report().select(F.lit(day).alias("run_date"), "rule", "status", "critical", "total_rows", "failed_rows", "pass_rate_pct"))
    return out[0].unionByName(out[1])


@register("backfill_gate")
def q_backfill_gate(spark, sf_dir):
    """A backfill of ten days, one of them spoilt: its Gold partition is held back, the other nine are written."""
    d, root = Domain(spark, sf_dir), scratch_path(spark, "backfill")
    span = (shift(BACKFILL_DAYS[0], -6), BACKFILL_DAYS[1])
    bronze = adapters.bronze_readings(spark, sf_dir, span)
    bronze = bronze.withColumn("volume_mcm", F.when(F.col("dt") == SPOILT_DAY, F.lit("1e9")).otherwise(F.col("volume_mcm")))
    p = incremental.run_backfill(spark, *BACKFILL_DAYS, root, bronze, adapters.bronze_weather(spark, sf_dir, BACKFILL_DAYS), d.hazard, d.downstream_map)
    return spark.read.schema(GOLD_TABLES["fact_water_monitoring"][0]).parquet(p["fact_water"]).drop("loaded_at")


@register("scan_ndjson_quarantine")
def q_scan_ndjson_quarantine(spark, sf_dir):
    """Good and malformed lines of the landed files, split by one pass; both are read from their partitions."""
    good, bad = lake.split_ndjson(spark, _ndjson_lake(spark, sf_dir) + "/*", READING_SCHEMA, scratch_path(spark, "split"))
    count = lambda df, side: df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n_lines"))
    return count(good, "good").unionByName(count(bad, "bad"))


def bucketed_trend(spark, sf_dir):
    """The 30-day mart over Gold facts and dimension that are bucketed by the reservoir's key."""
    d, lake_root, tag = Domain(spark, sf_dir), scratch_path(spark, "gold_buckets"), uuid.uuid4().hex[:12]
    lake.write_bucketed(d.dim_reservoir, f"dim_reservoir_{tag}", f"{lake_root}/dim", "reservoir_key", BUCKETS)
    lake.write_bucketed(d.fact_water, f"fact_water_{tag}", f"{lake_root}/fact", "reservoir_key", BUCKETS)
    fact, dim = spark.table(f"fact_water_{tag}"), spark.table(f"dim_reservoir_{tag}")
    out = marts.mart_30d_trend(fact, dim, d.dim_date, RUN_DATE)
    for name in (f"fact_water_{tag}", f"dim_reservoir_{tag}"):
        spark.sql(f"DROP TABLE {name}")     # external: the files stay
    return out


register("mart_from_buckets")(bucketed_trend)

#: Queries that write tables before they plan their result.
WRITERS = ("incremental_load", "stream_dedup", "producer_ledger", "dim_reservoir_incremental", "insert_overwrite_table", "dq_availability",
           "backfill_gate", "scan_ndjson_quarantine", "mart_from_buckets")
