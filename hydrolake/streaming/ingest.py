"""Incremental Bronze ingest with Structured Streaming.

The message log (Kafka in production, a landing folder of JSON files in tests)
is drained with ``trigger(availableNow=True)``: everything present is processed
in bounded micro-batches and the query stops - the equivalent of "poll until
the topic is empty".  Progress lives in the checkpoint (exactly-once per file
commit), so a restarted run never re-reads committed messages; the strict
``fetched_at > high-water mark`` guard is kept as a replay filter.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import settings
from .state import EPOCH, current_run, finish_run, save_batch

MESSAGE_SCHEMA = ("source STRING, reservoir_id STRING, reservoir_name STRING, region STRING, owner STRING, "
                  "record_date STRING, date STRING, capacity_mcm STRING, volume_mcm STRING, percent_storage STRING, "
                  "inflow_mcm STRING, outflow_mcm STRING, active_storage_mcm STRING, dead_storage_mcm STRING, "
                  "fetched_at STRING")

#: What a micro-batch is written from: the text, the time of the mark, the bucket.
BRONZE_COLS = ["value", "fetched_at", "bucket_source", "bucket_date"]


def message_key(df: DataFrame) -> DataFrame:
    """``{id}_{date}_{source}`` record key."""
    return df.withColumn("message_key", F.concat_ws("_", F.col("reservoir_id"), F.col("record_date"), F.col("source")))


def decode_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The listed fields of each JSON message and its raw text as ``value``; malformed messages are skipped.

    The fields come from a generator of one row: filters stay above it.  Below a mere projection each filter,
    ours and those of later steps, would hold the parser again.
    """
    text = F.col(value_col).cast("string")
    parsed = raw.select(text.alias("value"), F.inline(F.array(F.from_json(text, MESSAGE_SCHEMA, {"mode": "PERMISSIVE"}))))
    # a malformed message parses to NULL or to an all-NULL struct, a row of NULLs either way: skip both
    return parsed.where(F.coalesce("reservoir_id", "source", "fetched_at", "record_date").isNotNull())


def watermark_filter(df: DataFrame, watermark: str = EPOCH) -> DataFrame:
    """Accept only ``fetched_at > watermark`` (strict; missing fetched_at is rejected)."""
    return df.where(F.coalesce(F.col("fetched_at"), F.lit("")) > F.lit(watermark))


def bucket_columns(df: DataFrame, today: str) -> DataFrame:
    """(source, record date) bucket: source defaults to 'reservoir'; date falls back to
    the payload date, then today."""
    return df.select(
        "*",
        F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("reservoir")).alias("bucket_source"),
        F.coalesce(F.nullif(F.col("record_date"), F.lit("")), F.nullif(F.col("date"), F.lit("")), F.lit(today))
        .alias("bucket_date"))


def file_source(spark: SparkSession, landing: str, max_files_per_batch: int = 1000) -> DataFrame:
    """A landing folder of JSON lines, in micro-batches of bounded size."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_batch).load(landing)


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, max_offsets_per_batch: int = 1_000_000) -> DataFrame:
    """Production source (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
            .option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_offsets_per_batch).load())


def drop_resent(recs: DataFrame, within: str) -> DataFrame:
    """One of the messages with the same key and fetch time, in whichever micro-batch they come.

    The state store holds a message's key until the stream's time has passed it by ``within``, so its size
    follows the rate of messages, not the log.  A message later than that is dropped, and so is one whose
    ``fetched_at`` is no timestamp.  A newer fetch of the same reading is another message.
    """
    timed = message_key(recs).withColumn("_fetched", F.col("fetched_at").try_cast("timestamp")).where("_fetched IS NOT NULL")
    return timed.withWatermark("_fetched", within).dropDuplicatesWithinWatermark(["message_key", "fetched_at"]).drop("_fetched")


#: The keys of a log whose messages are all within reach of each other are as many as its messages: they are kept on disk, with
#: bounded memory an executor.  The default store holds them in its heap, and copies its whole map for each micro-batch.  A
#: checkpoint that was begun with that one goes on with it.
KEYS_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",    # a micro-batch uploads its own keys
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",           # a look-up for each write
}


def _for_writing(spark: SparkSession) -> dict[str, str]:
    """Settings for what a micro-batch writes: a stream's session has adaptive execution off, and without it rebalance hints do nothing.

    The stateful part is planned before and stays as it is; the settings are put back for the next micro-batch.  A large batch gets
    several tasks a core (a file costs more than a task): with about one, a last task has the machines for itself.
    """
    return {"spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(4 * spark.sparkContext.defaultParallelism)}


def _write_batch(recs: DataFrame, batch: int, bronze: str, state: str | None, run: int) -> None:
    """Write one micro-batch to its own Bronze folder and its mark to the state; both replace what an attempt before left."""
    seen = Observation(f"accepted_{batch}_{uuid.uuid4().hex[:8]}")
    # files by the size of the buckets: a small batch is one file a bucket, a hot bucket has several writers
    with settings(recs.sparkSession, _for_writing(recs.sparkSession)):      # the hint, too, is resolved in here
        out = (recs.select(BRONZE_COLS).hint("rebalance", "bucket_source", "bucket_date")
               .observe(seen, F.max("fetched_at").alias("last"), F.count(F.lit(1)).alias("n")))
        (out.drop("fetched_at").write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "gzip")
         .partitionBy("bucket_source", "bucket_date").text(f"{bronze}/batch={batch}"))
    if state is not None:
        save_batch(recs.sparkSession, state, run, batch, seen.get["last"], seen.get["n"])


def stream_ingest(source: DataFrame, bronze: str, checkpoint: str, watermark: str = EPOCH, today: str | None = None,
                  dedup_within: str | None = None, state: str | None = None, run: int = 0) -> None:
    """Drain a streaming frame of messages (``value``) into Bronze, then stop.

    Bronze holds the messages as they came, one JSON line each with every field, in gzip files in
    (batch, bucket_source, bucket_date) folders.  Re-running only processes new input, and a micro-batch
    that is replayed after a crash replaces its own folder.  ``dedup_within``: see ``drop_resent``.
    """
    today = today or _dt.date.today().isoformat()
    recs = bucket_columns(watermark_filter(decode_messages(source), watermark), today)
    if dedup_within:
        recs = drop_resent(recs, dedup_within)
    # the text holds every field: what a micro-batch does not write is not carried through the state either
    recs = recs.select(BRONZE_COLS)
    with settings(recs.sparkSession, KEYS_ON_DISK if dedup_within else {}):     # the stream's session is a copy, made at its start
        q = (recs.writeStream.foreachBatch(lambda df, batch: _write_batch(df, batch, bronze, state, run))
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def incremental_load(source: DataFrame, bronze: str, checkpoint: str, state: str, today: str | None = None,
                     dedup_within: str | None = None) -> str:
    """Ingest what is newer than the mark of the last finished run; returns the mark used.

    The new mark comes from what the micro-batches accepted, observed while they were written: no Bronze file
    is opened.  A crash at any point neither loses nor repeats a message (see ``state.current_run``).
    """
    spark = source.sparkSession
    run, mark = current_run(spark, state)
    stream_ingest(source, bronze, checkpoint, mark, today, dedup_within, state, run)
    finish_run(spark, state, run, mark)
    return mark
