"""Folders of the lake: partitions by listing, whole versions of tables, quarantine, bucketed tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import settings


def _listing(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, as its file system lists them; an absent folder is an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


# ------------------------------------------------------------------ partitions by listing

def partition_values(spark: SparkSession, root: str, part_col: str = "dt", above: str | None = None, through: str | None = None) -> list[str]:
    """The values of ``root/part_col=...`` folders that hold files, ascending; ``above`` < value <= ``through``.

    Only the names are listed (one per date): no data file is opened, whatever the table's size.
    """
    prefix = f"{part_col}="
    found = [n[len(prefix):] for n in _listing(spark, root) if n.startswith(prefix)]
    return [v for v in found if (above is None or v > above) and (through is None or v <= through) and _holds_files(spark, f"{root}/{prefix}{v}")]


def _holds_files(spark: SparkSession, folder: str) -> bool:
    return any(n[0] not in "._" for n in _listing(spark, folder))


def read_partitions(spark: SparkSession, root: str, values: list[str], schema: str, fmt: str = "parquet", part_col: str = "dt") -> DataFrame:
    """The rows of some partitions; the folders of others are not even listed."""
    if not values:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).option("basePath", root).load([f"{root}/{part_col}={v}" for v in values])


def listed_dates(spark: SparkSession, roots: list[str], part_col: str = "dt", include: str | None = None) -> DataFrame:
    """Sorted distinct valid ``yyyy-MM-dd`` partition values of several roots (and ``include``), from listings."""
    names = {v for r in roots for v in partition_values(spark, r, part_col)} | ({include} if include else set())
    dates = spark.createDataFrame([(v,) for v in sorted(names)], "dt string")
    return dates.where(F.col("dt").rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(F.col("dt"), "yyyy-MM-dd").isNotNull()).orderBy("dt")


def latest_partition(spark: SparkSession, root: str, dt: str, schema: str, fmt: str = "parquet", part_col: str = "dt") -> DataFrame:
    """Rows of partition ``dt`` if it holds files, else of the most recent partition; no other day's files are opened."""
    prefix = f"{part_col}="
    names = [n[len(prefix):] for n in _listing(spark, root) if n.startswith(prefix)]
    order = [dt] * (dt in names) + names[::-1]
    pick = next((v for v in order if _holds_files(spark, f"{root}/{prefix}{v}")), None)
    return read_partitions(spark, root, [pick] if pick else [], schema, fmt, part_col)


def read_json_folders(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """JSON lines under nested folders, found by one job of as many tasks as there are cores.

    Left to itself Spark lists each folder of more than 32 sub-folders by a job of its own, with a task for each of these: two a
    micro-batch of a Bronze of a few thousand buckets.
    """
    listing = "spark.sql.sources.parallelPartitionDiscovery"
    with settings(spark, {f"{listing}.threshold": "1", f"{listing}.parallelism": str(spark.sparkContext.defaultParallelism)}):
        return spark.read.schema(schema).json(root)     # lists before it returns


# ------------------------------------------------------------------ whole versions of a table

def current_version(spark: SparkSession, root: str) -> str:
    """The folder of the newest complete version; the root itself if it holds no versions."""
    done = [n for n in _listing(spark, root) if n.startswith("v=") and "_SUCCESS" in _listing(spark, f"{root}/{n}")]
    return f"{root}/{done[-1]}" if done else root


def replace_table(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """Full refresh that readers see at once: the rows go to a new version folder, which counts from the moment
    its job has committed.  Readers of the version before keep its files; ``df`` may read it, too."""
    path = f"{root}/v={time.time_ns() // 1_000_000:014d}-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").save(path)
    return path


def read_current(spark: SparkSession, root: str, schema: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(current_version(spark, root))


def publish(spark: SparkSession, table: str, ddl_cols: str, path: str, fmt: str = "parquet") -> None:
    """Point a catalogue table at a version: one catalogue change, so a query sees the old version or the new one."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl_cols}) USING {fmt} LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


# ------------------------------------------------------------------ quarantine

BAD = "_bad"


def split_ndjson(spark: SparkSession, path: str, schema: StructType | str, out: str) -> tuple[DataFrame, DataFrame]:
    """Read NDJSON once and write its good and its malformed lines to two partitions of ``out``.

    Returns (good, bad): the good rows by ``schema``, and the raw text of the malformed lines.  Nothing is cached; both sides are read
    from files, by a partition filter.
    """
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    parsed = StructType([*fields.fields]).add("_corrupt_record", "string")
    lines = spark.read.schema(parsed).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    lines.withColumn(BAD, F.col("_corrupt_record").isNotNull()).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .option("compression", "zstd").partitionBy(BAD).parquet(out)
    both = spark.read.schema(StructType([*parsed.fields]).add(BAD, "boolean")).parquet(out)
    return both.where(~F.col(BAD)).select(*fields.names), both.where(BAD).select("_corrupt_record")


# ------------------------------------------------------------------ bucketed tables

def write_bucketed(df: DataFrame, table: str, path: str, by: str, buckets: int, fmt: str = "parquet") -> None:
    """A catalogue table bucketed and sorted by ``by``, one file a bucket: joins and windows on it need no shuffle."""
    (df.repartition(buckets, by).write.mode("overwrite").format(fmt).bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(table))

