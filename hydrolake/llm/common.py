"""Helpers shared by the operators: reading, words, checkpoints, Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a maximal run of code points other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (bound as a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files: later
    stages neither recompute it nor depend on any one executor's disk."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    done = df.checkpoint(eager=True)
    # what was shuffled for it is no longer needed; Spark deletes shuffle files once the driver's
    # collector finds them unused, which in a long job can be long after the disks are full
    del df
    tidy(spark)
    return done


def tidy(spark: SparkSession) -> None:
    """Have Spark drop the shuffles and checkpoints that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


#: Keys with at least 1/HOT of all rows are spread over SALTS partitions; there are at most HOT of them.
HOT, SALTS = 1 << 14, 64


def hot_keys(counts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """The keys of ``counts`` with at least 1/HOT of the total; at most HOT rows, so safe to broadcast."""
    return counts.where(F.col(n) * HOT >= F.lit(total)).select(key)


def salted_join(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join of many rows with a table of unique keys: rows with a hot key are dealt out by a salt, and
    the table's row for that key is repeated for each salt."""
    mark = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return (rows.join(mark, key, "left").withColumn("_salt", salt).drop("_hot")
            .join(table.join(mark, key, "left").withColumn("_salt", F.explode(salts)).drop("_hot"), [key, "_salt"]).drop("_salt"))


def text_list(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty string."""
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices of the incoming batches, so a task holds few texts as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ship(spark: SparkSession) -> None:
    """Send this library's modules to the executors, once per application: the functions
    that run there import them, installed or not."""
    sc = spark.sparkContext
    if getattr(sc, "_hydrolake_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="hydrolake-ship-")) / "hydrolake_modules.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))      # the driver serves it; executors fetch their own copies
    sc._hydrolake_shipped = True
