"""Run state kept as tiny tables (high-water mark, producer ledger) and backfill dates."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "1970-01-01T00:00:00+00:00"


MARK_STATE = "run INT, last_fetched_at STRING"


def load_watermark(spark: SparkSession, path: str) -> str:
    """Last accepted ``fetched_at`` of the finished runs (default: epoch), whether loads or ``save_watermark`` stored it."""
    marks = _rows(spark, f"{path}/marks", MARK_STATE)
    return (marks.agg(F.max("last_fetched_at").alias("w")).first()["w"] if marks is not None else None) or EPOCH


def save_watermark(spark: SparkSession, path: str, accepted: DataFrame) -> None:
    """Persist max(fetched_at) of the accepted rows as a run of its own (only after the Bronze write)."""
    w = accepted.agg(F.max("fetched_at").alias("last_fetched_at")).where(F.col("last_fetched_at").isNotNull())
    run, _ = current_run(spark, path)
    w.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/marks/run={run}")


BATCH_STATE = "run INT, batch BIGINT, last_fetched_at STRING, accepted BIGINT"


def current_run(spark: SparkSession, path: str) -> tuple[int, str]:
    """(number of the run to start or go on with, the mark that its messages must exceed).

    A run is over when its mark is saved.  One that broke off goes on under its number and with the mark that it
    began with, so a batch that is replayed accepts the very messages that it accepted before.
    """
    marks = _rows(spark, f"{path}/marks", MARK_STATE)
    last = marks.orderBy(F.col("run").desc()).first() if marks is not None else None
    return (last.run + 1, last.last_fetched_at) if last else (0, EPOCH)


def save_batch(spark: SparkSession, path: str, run: int, batch: int, last_fetched_at: str | None, accepted: int) -> None:
    """What one micro-batch accepted; a replay of the batch replaces its row."""
    row = spark.createDataFrame([(last_fetched_at, accepted)], "last_fetched_at STRING, accepted BIGINT").coalesce(1)
    row.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batches/run={run}/batch={batch}")


def finish_run(spark: SparkSession, path: str, run: int, mark: str) -> str:
    """Save the run's mark: the highest of its batches, or the mark before if they accepted nothing."""
    own = batches(spark, path)
    top = own.where(F.col("run") == run).agg(F.max("last_fetched_at").alias("m")).first().m if own is not None else None
    new = max(top or mark, mark)
    spark.createDataFrame([(new,)], "last_fetched_at STRING").coalesce(1).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").parquet(f"{path}/marks/run={run}")
    return new


def batches(spark: SparkSession, path: str) -> DataFrame | None:
    """run, batch, last_fetched_at, accepted of every micro-batch so far."""
    return _rows(spark, f"{path}/batches", BATCH_STATE)


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":     # only an absent table is a first run
            raise
        return None


def backfill_dates(spark: SparkSession, target: str, days: int, ledger: DataFrame | None = None) -> DataFrame:
    """First run (empty ledger): D-days .. D-1 ascending; later runs: D-1 only."""
    d = F.to_date(F.lit(target))
    first = spark.range(1).select(F.explode(F.sequence(F.date_sub(d, days), F.date_sub(d, 1))).alias("fetch_date"))
    later = spark.range(1).select(F.date_sub(d, 1).alias("fetch_date"))
    if ledger is None:
        return first
    has = ledger.select(F.lit(1)).limit(1)
    return first.where(~has.exists()).unionByName(later.where(has.exists()))


def update_ledger(ledger: DataFrame | None, processed: DataFrame, date_col: str = "fetch_date") -> DataFrame:
    """Producer ledger: last processed date and cumulative number of processed dates."""
    new = processed.agg(F.max(date_col).alias("last_date"), F.count(F.lit(1)).alias("n"))
    if ledger is None:
        return new.select("last_date", F.col("n").alias("processed_count"))
    # one-row ledger + one-row batch summary -> one global aggregate (no join)
    u = ledger.select("last_date", F.col("processed_count").alias("n")).unionByName(new)
    return u.agg(F.max("last_date").alias("last_date"), F.sum("n").alias("processed_count"))


def record_run(processed: DataFrame, path: str, run_id: str, date_col: str = "fetch_date") -> None:
    """Upsert the dates that a producer run processed; running a run id again replaces its own entry only."""
    (processed.select(F.col(date_col).cast("string").alias("fetch_date")).distinct().write.mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(f"{path}/run_id={run_id}"))


def ledger_dates(spark: SparkSession, path: str) -> DataFrame:
    """run_id, fetch_date of every recorded run; empty before the first."""
    schema = "fetch_date STRING, run_id STRING"
    rows = _rows(spark, path, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's one row: last processed date and how many dates the runs processed."""
    return ledger_dates(spark, path).agg(F.max("fetch_date").alias("last_date"), F.count(F.lit(1)).alias("processed_count"))


def next_fetch_dates(spark: SparkSession, path: str, target: str, days: int) -> DataFrame:
    """The dates that the next run fetches, by the stored ledger."""
    return backfill_dates(spark, target, days, ledger_dates(spark, path))
