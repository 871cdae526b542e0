"""Table sinks: parquet snapshots with a keyed upsert, and JSON export.

Parquet cannot overwrite a table it is reading, and has no MERGE.  A table
is therefore a directory of snapshots ``<root>/tf_snapshot=<n>/``; an upsert
reads the newest snapshot, merges, and writes the next one.  A snapshot counts
once its marker file ``_committed[-<token>]`` is there: what a failed write
left behind has none, is never read, and is replaced by the next attempt.  A
table has one writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleflow.operators.upsert import merge_frames
from titleflow.sources.buckets import read_buckets
from titleflow.sources.files import children, touch

VERSION = "tf_snapshot"  # prefix of snapshot folders
COMMITTED = "_committed"
_V = re.compile(rf"{VERSION}=(\d+)")


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{VERSION}={version}"


def _commits(spark: SparkSession, root: str) -> dict[int, str]:
    """Committed snapshot number -> the token it was committed with."""
    out = {}
    for name in children(spark, root):
        if m := _V.fullmatch(name):
            marks = [c for c in children(spark, f"{root.rstrip('/')}/{name}") if c.startswith(COMMITTED)]
            if marks:
                out[int(m.group(1))] = marks[0][len(COMMITTED) + 1 :]
    return out


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed snapshot numbers under ``root``."""
    return sorted(_commits(spark, root))


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """A snapshot (the newest by default), or the rows of a bucketed table."""
    vs = versions(spark, root)
    if not vs:
        return read_buckets(spark, root)
    return spark.read.parquet(snapshot_path(root, vs[-1] if version is None else version))


def write_snapshot(df: DataFrame, root: str, version: int, token: str = "") -> None:
    path = snapshot_path(root, version)
    df.write.mode("overwrite").parquet(path)
    touch(df.sparkSession, f"{path}/{COMMITTED}" + (f"-{token}" if token else ""))


def create_or_merge(spark: SparkSession, df: DataFrame, root: str, keys: Sequence[str] | None = None, token: str = "") -> int:
    """Create the table from ``df`` if it has no snapshot yet, else MERGE
    ``df`` into the newest snapshot on ``keys`` (default: the first column,
    as the source pipeline did).  Returns the newest snapshot number.

    An empty ``df`` writes nothing; nor does one whose ``token`` (letters,
    digits, ``-``) a snapshot carries already, so a load that is run again
    after it was committed changes nothing.  Columns new in ``df`` join the
    table (NULL for rows that the load does not touch).
    """
    commits = _commits(spark, root)
    newest = max(commits, default=-1)
    if (token and token in commits.values()) or df.isEmpty():
        return newest
    keys = list(keys) if keys else [df.columns[0]]
    if newest < 0:
        out = df
    else:
        current = spark.read.parquet(snapshot_path(root, newest))
        new = {c: F.lit(None).cast(df.schema[c].dataType) for c in df.columns if c not in current.columns}
        out = merge_frames(current.withColumns(new) if new else current, df, keys)
    write_snapshot(out, root, newest + 1, token)
    return newest + 1


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, one object per row, NULLs written as ``null`` (not
    dropped), text kept as UTF-8.  Runs on the executors."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_json_array(df: DataFrame, path: str, single: bool = False) -> None:
    """JSON array documents: every part file is one array of row objects.

    ``single`` writes one document, as a small export wants it; its one task
    streams the rows and never holds them.  NULLs and text as in
    :func:`export_json`; a table without rows is an empty array.
    """
    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))
    if single:
        rows = rows.repartition(1)

    def document(batches):
        before = "["
        for batch in batches:
            lines = batch.column("value").to_pylist()
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array([before + lines[0], *["," + x for x in lines[1:]]], pa.string())], names=["value"])
                before = ","
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if before == "[" else "]"], pa.string())], names=["value"])

    rows.mapInArrow(document, "value string").write.mode("overwrite").text(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of JSON array documents; a document is one record to Spark, so one task reads it."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
