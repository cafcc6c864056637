"""Tables derived from the driver's data and written into the
shared checkpoint folder (the lake the scan / sink / stream queries read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import io

#: Lines of a file that one task reads in well under a minute.
LINES_A_FILE = 1_000_000

_WRITTEN: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and modification times of the input tables."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def written(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """The table's folder; it is written once per application and state of the input."""
    key = (spark.sparkContext.applicationId, sf_dir, name, _state(spark, sf_dir))
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        build(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def message_lines(bronze: DataFrame, drop_for_dam: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> DataFrame:
    """Bronze records as JSON lines; every 101st offset is truncated (malformed) and
    every 103rd is a blank line."""
    cols = [c for c in bronze.columns if c not in exclude]
    rec = F.to_json(F.struct(*[F.col(c) for c in cols]))
    if drop_for_dam:
        keep = [c for c in cols if c not in drop_for_dam]
        rec = F.when(F.col("source") == "dam", F.to_json(F.struct(*[F.col(c) for c in keep]))).otherwise(rec)
    line = (F.when(F.pmod(F.col("_offset"), F.lit(101)) == 0, F.substring(rec, 1, 25))
            .when(F.pmod(F.col("_offset"), F.lit(103)) == 0, F.lit(""))
            .otherwise(rec))
    return bronze.select("source", line.alias("value"))


def write_lines(lines: DataFrame, path: str, mode: str = "error", lines_a_file: int = 0) -> None:
    """Text lines as gzip files, about a tenth of the plain ones.  Such a file is read by one task: ``lines_a_file`` (0: any number) bounds it."""
    lines.select("value").write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", lines_a_file).text(path)


def write_ndjson_by_source(bronze: DataFrame, path: str, drop_for_dam: tuple[str, ...] = ()) -> None:
    lines = message_lines(bronze, drop_for_dam)
    for src in ("dam", "reservoir"):
        write_lines(lines.where(F.col("source") == src), f"{path}/{src}", "overwrite", LINES_A_FILE)


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet", part: tuple[str, ...] = ("dt",)) -> None:
    io.sink_partitioned(df, path, fmt, part)
