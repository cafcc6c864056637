"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

quality rules (rejected documents go, failing lines leave the others), SimHash near-dedup (of each
group the document with the least id stays), secret scans (secrets in the texts are replaced),
mixing sources to target weights (a row for each time a document is taken), packing.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.llm import mixing, quality_rules, queries, secret_scans, simhash_dedup
from hydrolake.llm.common import ship, table
from hydrolake.session import scratch_path


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash_dedup.keep_one(docs, shingle=3, max_distance=2)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secret_scans.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return queries.packed(docs)


STAGES = [("quality_rules", clean_lines), ("simhash_dedup", drop_near_copies), ("secret_scans", redact_secrets),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Secret scans and tokenisers have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.select(*[F.col(c) for c in docs.columns])
