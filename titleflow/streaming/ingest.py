"""Incremental landing -> bronze ingest with Structured Streaming.

A file-source stream watches a landing extract's folder; every micro-batch
(the files that arrived since the last one) is stamped with its load time
and MERGEd into the bronze table (a snapshot directory, see
:mod:`titleflow.sources.tables`) on the table's key, one load date after the
other.  The stream's checkpoint records which files were consumed, so a
restart -- or a lost executor -- neither skips nor repeats a file.  Snapshots
are numbered by the table alone and carry (query id, batch id, load date): a
batch that runs again skips the dates it has committed, and a new checkpoint
on an existing table adds to it.  ``availableNow`` processes what is there and
stops, which is how a scheduled load runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleflow.sources.landing import PARTITION, TSV_READ, decode_empty, with_load_time
from titleflow.sources.tables import create_or_merge, versions


def landing_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stream of rows from the TSV files landing under ``path`` (text
    columns of ``schema``; a ``load_date`` partition column if present)."""
    return decode_empty(spark.readStream.options(**TSV_READ).schema(schema).csv(path))


def ingest_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    bronze_root: str,
    checkpoint: str,
    keys: Sequence[str] | None = None,
    load_time=None,
) -> int:
    """Merge every landed file not yet ingested into ``bronze_root`` and
    stop.  Returns the newest snapshot number (-1 if none)."""
    keys = list(keys) if keys else [schema.fieldNames()[0]]

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = f"{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        if PARTITION not in batch.columns:
            create_or_merge(session, with_load_time(batch, load_time), bronze_root, keys, token=run)
            return
        # One row per load date of the batch; oldest first, so the newest load wins.
        days = sorted((r[0] for r in batch.select(PARTITION).distinct().collect()), key=lambda d: (d is not None, d))
        for day in days:
            rows = batch.where(F.col(PARTITION).eqNullSafe(F.lit(day))).drop(PARTITION)
            create_or_merge(session, with_load_time(rows, load_time), bronze_root, keys, token=f"{run}-{day}")

    query = (
        landing_stream(spark, landing, schema)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    vs = versions(spark, bronze_root)
    return vs[-1] if vs else -1


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def latest_rows(spark: SparkSession, bronze_root: str) -> DataFrame:
    from titleflow.sources.tables import read_table

    df = read_table(spark, bronze_root)
    if df is None:
        raise FileNotFoundError(bronze_root)
    return df


__all__ = ["landing_stream", "ingest_available", "string_schema", "latest_rows"]
