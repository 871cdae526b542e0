"""Parquet tables whose merges rewrite only the buckets that a load touches.

A table lies in ``<root>/buckets=<n>/tf_bucket=<b>/``; a row's bucket is the
hash of its key, as text, modulo n, and n is fixed when the table is made.  A
load finds the buckets of its keys (at most n numbers), reads those alone,
merges, and writes them back with Spark's dynamic partition overwrite: files
are staged and take their bucket's place when the job commits, so a failed
job changes nothing, and the other buckets' files are never read or written.
A commit that is cut short can be run again: a bucket is replaced whole by the
same merge.  (Rows without a key match nothing and would then be inserted
twice.)  A table has one writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from titleflow.functions.observed import observed
from titleflow.operators.upsert import merge_frames
from titleflow.sources.files import children

BUCKET = "tf_bucket"
DEFAULT_BUCKETS = 64
_N = re.compile(r"buckets=(\d+)")


@dataclass(frozen=True)
class Load:
    """What a load did: rows written and buckets replaced (0 and 0: it was empty)."""

    rows: int
    buckets: int


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n)).cast("int")


def _found(spark: SparkSession, root: str) -> tuple[str, int, list[str]] | None:
    """(path, bucket count, bucket folders) of a table that has rows."""
    for name in children(spark, root):
        if m := _N.fullmatch(name):
            path = f"{root.rstrip('/')}/{name}"
            own = [c for c in children(spark, path) if c.startswith(f"{BUCKET}=")]
            if own:
                return path, int(m.group(1)), own
    return None


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    # Buckets written before a column was added lack it.
    reader = spark.read.option("basePath", path).option("mergeSchema", "true")
    return reader.parquet(*[f"{path}/{f}" for f in folders]).drop(BUCKET)


def read_buckets(spark: SparkSession, root: str) -> DataFrame | None:
    found = _found(spark, root)
    return _read(spark, found[0], found[2]) if found else None


def merge_buckets(spark: SparkSession, df: DataFrame, root: str, keys: Sequence[str] | None = None, buckets: int = DEFAULT_BUCKETS) -> Load:
    """Create the table from ``df``, or MERGE ``df`` into it on ``keys``
    (default: the first column).  Columns new in ``df`` join the table.

    The rows are counted while they are written, so the first load is one job
    and a later one two: its buckets, which also tell whether it is empty, and
    the merge."""
    keys = list(keys) if keys else [df.columns[0]]
    found = _found(spark, root)
    path, n, folders = found or (f"{root.rstrip('/')}/buckets={buckets}", buckets, [])
    out, touched = df, n
    if found:
        asked = [f"{BUCKET}={r[0]}" for r in df.select(bucket_of(keys, n)).distinct().collect()]
        if not asked:
            return Load(0, 0)
        touched = len(asked)
        known = [f for f in folders if f in set(asked)]
        if known:
            current = _read(spark, path, known)
            new = {c: F.lit(None).cast(df.schema[c].dataType) for c in df.columns if c not in current.columns}
            out = merge_frames(current.withColumns(new) if new else current, df, keys)
    seen = Observation()
    tagged = out.withColumn(BUCKET, bucket_of(keys, n)).observe(seen, F.count(F.lit(1)).alias("rows"))
    # One file a bucket, but a bucket swollen by a hot key is split.
    tagged.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    rows = observed(seen, "rows")[0]
    return Load(rows, touched if rows else 0)
