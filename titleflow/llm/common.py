"""Helpers shared by the text operators.

``WORD`` and ``strip/lower`` rules are the ones every contract here names:
words are runs of anything but the six ASCII blanks, and only A-Z have a
lower-case form.  ``bytes.split()``, ``bytes.strip()`` and ``bytes.lower()``
follow exactly those rules on UTF-8, so tasks work on bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleflow.session import shared_path

#: Text bytes worked on at once inside a task; bounds memory, changes no result.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096


#: Arrow batches sent to Python stop at so many bytes: two tasks' batches, copies and results must fit beside an executor's heap.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches more tightly where the session leaves Spark's default (64 MB); results don't depend on it."""
    if spark.conf.get(BATCH_SETTING).rstrip("b") == str(64 << 20):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage with files that outlive any executor, so later steps neither
    recompute nor depend on machine-local blocks.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (Spark's names know no case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def remainder(doc_id: str, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def picked(df: DataFrame, text: str, max_texts: int) -> DataFrame:
    """The distinct rows of ``df`` for about ``max_texts`` texts at most, picked by hash.

    Copies of a text count as one, so a text with very many cannot outgrow the bound.
    """
    total = df.select(F.xxhash64(text)).distinct().count()
    if total > max_texts:
        df = df.where(F.pmod(F.xxhash64(text), F.lit(total)) < max_texts)
    return df.distinct()


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut a batch where its texts reach ``SLICE_BYTES``; a null text is empty."""
    texts = [t or b"" for t in batch.column(text).cast(pa.binary()).to_pylist()]
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES or i + 1 - start >= SLICE_ROWS or i + 1 == len(texts):
            yield batch.slice(start, i + 1 - start), texts[start : i + 1]
            start, size = i + 1, 0


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    fields: list[tuple[str, str, pa.DataType]],
    make: Callable[[], Callable[[list[bytes]], list[Any]]],
) -> DataFrame:
    """One output row per input row: the ``keep`` columns and ``fields``.

    ``fields`` are (name, Spark type, Arrow type).  ``make()`` runs once per
    task and returns the function that turns a list of texts into one list (or
    Arrow array) per field.
    """
    bound_batches(df.sparkSession)
    body = text if text in keep else free_name(keep, "_text")  # a kept text travels once
    source = df.select(*[F.col(c) for c in keep], *([] if text in keep else [F.col(text).cast("string").alias(body)]))
    schema = T.StructType(
        [source.schema[c] for c in keep] + [T.StructField(n, T._parse_datatype_string(s)) for n, s, _ in fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        names = [*keep, *(n for n, _, _ in fields)]
        for batch in batches:
            for part, texts in slices(batch, body):
                made = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, (_, _, t) in zip(fn(texts), fields)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=names)

    return source.mapInArrow(run, schema)
