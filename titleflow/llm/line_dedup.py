"""Line dedup: levelled sorted runs of line hashes.

A *run* is a Parquet table of (key, n_docs) sorted by key: the lines of one
batch of documents, or of several batches once compacted.  ``LineRuns`` keeps
them in levels.  A new batch is merge-anti-joined with the keys that the runs
already settle (found in ``min_docs`` documents or more: further sightings
cannot change the verdict, so hot lines are never stored again) and what is
left becomes a run of level 0.  When a level holds ``fanout`` runs they are
compacted into one run of the next level.

A line's key is the line stripped of ASCII blanks with A-Z lower-cased; keys
are held as their 128-bit XXH3 hash.  Lines are counted per document (row),
so a line repeated inside one document counts once; repeated rows count each.

Cases: a null or empty text is one empty line and keeps it (keys shorter than
``min_key_chars`` code points are never dropped); an empty table gives an empty result; extra
columns pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleflow.llm.common import bound_batches, free_name, materialise, slices

RUN_SCHEMA = "key binary, n_docs bigint"


def key_hashes(text: bytes, min_key_chars: int) -> list[bytes | None]:
    """One hash per line of the text; None for keys that are too short."""
    out: list[bytes | None] = []
    for line in text.lower().split(b"\n"):
        key = line.strip()
        short = not key or (len(key) < 4 * min_key_chars and len(key.decode()) < min_key_chars)
        out.append(None if short else xxhash.xxh3_128_digest(key))
    return out


class LineRuns:
    """Levelled sorted runs of line hashes in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, runs).groupBy("key").agg(F.sum("n_docs").alias("n_docs"))

    def _store(self, run: DataFrame, level: int) -> DataFrame:
        return materialise(run.sortWithinPartitions("key"), f"line-run-{level}")

    def totals(self) -> DataFrame:
        """(key, n_docs) over all runs."""
        runs = [r for level in self.levels for r in level]
        return self._merged(runs) if runs else self.spark.createDataFrame([], RUN_SCHEMA)

    def frequent(self) -> DataFrame:
        """Keys found in at least ``min_docs`` documents."""
        return self.totals().where(F.col("n_docs") >= self.min_docs).select("key")

    def add(self, keys: DataFrame) -> None:
        """Add a batch: ``keys`` has one row per (document, distinct key)."""
        counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"))
        if any(self.levels):
            counted = counted.join(self.frequent(), "key", "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._store(counted, 0))
        self._compact()

    def _compact(self) -> None:
        for i, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self._store(self._merged(runs), i + 1))
                self.levels[i] = []


def _keys_of(docs: DataFrame, text: str, min_key_chars: int, n_batches: int) -> DataFrame:
    """(batch, text_id, key): a row for each document and distinct line key."""

    def run(batches):
        for batch in batches:
            for _, texts in slices(batch, "_text"):
                ids, keys, parts = [], [], []
                for t in texts:
                    own = {k for k in key_hashes(t, min_key_chars) if k is not None}
                    tid = hashlib.md5(t).digest()
                    ids += [tid] * len(own)
                    parts += [tid[0] % n_batches] * len(own)
                    keys += own
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), pa.array(ids, pa.binary()), pa.array(keys, pa.binary())],
                    names=["batch", "text_id", "key"],
                )

    return docs.select(F.col(text).cast("string").alias("_text")).mapInArrow(run, "batch int, text_id binary, key binary")


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = 10,
    min_key_chars: int = 1,
    n_batches: int = 4,
    fanout: int = 2,
    counts: tuple[str, str] = ("_n_lines", "_n_dropped"),
) -> DataFrame:
    """``docs`` with ``text`` rid of lines whose key is in ``min_docs`` documents or more.

    Adds the lines before dropping and the dropped ones, in columns named by
    ``counts``, which ``docs`` must not have.  The documents are
    added to the runs in ``n_batches`` batches (by hash of their text, so each
    row is in exactly one).  Rows meet their dropped keys by text hash: equal
    texts share one list, and only texts that lose a line have one.
    """
    spark = docs.sparkSession
    if any(free_name(docs.columns, c) != c for c in counts):
        raise ValueError(f"documents have a column {counts[0]} or {counts[1]}; name others in counts")
    bound_batches(spark)
    keys = materialise(_keys_of(docs, text, min_key_chars, n_batches), "line-keys", "batch")
    runs = LineRuns(spark, min_docs, fanout)
    for b in range(n_batches):
        runs.add(keys.where(F.col("batch") == b).select("key"))
    # Both small sides are written first: a join of plain exchanges can be split
    # where a hot line, or a text with very many copies, fills a partition.
    frequent = materialise(runs.frequent(), "frequent-lines")
    dropped = materialise(
        keys.join(frequent, "key", "left_semi")
        .groupBy("text_id")
        .agg(F.collect_set("key").alias("drop")),
        "dropped-lines",
    )
    columns = docs.columns
    tid, own_body, own_drop = (free_name(columns, n) for n in ("_tid", "_body", "_drop"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    tagged = docs.withColumn(tid, F.unhex(F.md5(body.cast("binary")))).withColumn(own_body, body)
    joined = tagged.join(dropped.select(F.col("text_id").alias(tid), F.col("drop").alias(own_drop)), tid, "left").drop(tid)

    others = [c for c in columns if c != text]
    source = joined.select(*others, own_body, own_drop)
    fields = [source.schema[c] for c in others]

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, own_body):
                kept, n, d = [], [], []
                for body, drop in zip(texts, part.column(own_drop).to_pylist()):
                    lines = body.split(b"\n")
                    n.append(len(lines))
                    if drop:
                        gone = set(drop)
                        lines = [x for x, k in zip(lines, key_hashes(body, min_key_chars)) if k not in gone]
                    d.append(n[-1] - len(lines))
                    kept.append(b"\n".join(lines).decode())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                    names=[*others, text, *counts],
                )

    schema = T.StructType([*fields, T.StructField(text, T.StringType()), *[T.StructField(c, T.LongType()) for c in counts]])
    return source.mapInArrow(run, schema).select(*columns, *counts)
