"""Landing files: tab-separated extracts in, typed tables out.

Two layouts are read: the one written here,
``<root>/<name>.tsv/load_date=<yyyy-mm-dd>/part-*.csv.gz`` (one directory per
extract, one folder per load date), and a flat one,
``<root>/<yyyy-mm-dd>/<name>.tsv[.gz]``.  A read lists child folders only and
opens just the chosen day's.  Gzip is decoded by the reader itself (no
driver-side decompression).

Fields are written as they stand: blanks are kept and nothing is quoted.  A
NULL is an empty field and an empty text is ``EMPTY``; a text that holds a
tab, a line end or is ``EMPTY`` itself cannot be written and fails the job.
"""

from __future__ import annotations

import datetime as dt
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleflow.sources.files import children, exists

# Quoting is switched off: the extracts never quote, and a title that starts
# with an unclosed quote would otherwise swallow the following columns.
_EXACT = {"header": "true", "sep": "\t", "quote": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
TSV_READ = {**_EXACT, "mode": "PERMISSIVE"}
TSV_WRITE = {**_EXACT, "escapeQuotes": "false", "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "nullValue": "", "emptyValue": ""}
EMPTY = "\u2400"
PARTITION = "load_date"
ROWS_PER_FILE = 1_000_000
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_DATE_DIR = re.compile(rf"{PARTITION}=({_DATE.pattern})")


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options) -> DataFrame:
    """All columns as text, named from the header (or ``schema``)."""
    reader = spark.read.options(**{**TSV_READ, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return decode_empty(reader.csv(path))


def decode_empty(df: DataFrame) -> DataFrame:
    """``EMPTY`` fields as empty texts (file metadata columns stay available)."""
    texts = {f.name: F.when(F.col(f"`{f.name}`") == EMPTY, F.lit("")).otherwise(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(texts) if texts else df


def _encoded(df: DataFrame) -> DataFrame:
    """Text columns as fields; fails on a text that a field cannot hold."""

    def field(name: str) -> Column:
        c = F.col(f"`{name}`")
        bad = c.contains("\t") | c.contains("\r") | c.contains("\n") | (c == EMPTY)
        return F.when(bad, F.raise_error(F.lit(f"column {name}: a text with a tab, a line end or the empty marker has no TSV form"))).when(c == "", F.lit(EMPTY)).otherwise(c)

    texts = {f.name: field(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(texts) if texts else df


def write_tsv(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite", rows_per_file: int = 0) -> None:
    """Gzip TSV, one file per partition of ``df`` (more where one has over
    ``rows_per_file`` rows).  With ``partition_by`` only the folders that
    ``df`` has rows for are replaced."""
    w = _encoded(df).write.mode(mode).options(**TSV_WRITE).option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        w = w.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    w.csv(path)


def landing_path(root: str, name: str) -> str:
    """``title.basics`` -> ``<root>/title.basics.tsv``."""
    return f"{root.rstrip('/')}/{name}.tsv"


def write_landing(df: DataFrame, root: str, name: str, load_date: str | dt.date | None = None) -> str:
    """Land one extract; replaces the same extract's folder for that date
    (also by an empty extract) and leaves other dates alone.  An extract with
    a ``load_date`` column replaces the folders of the dates in it."""
    path = landing_path(root, name)
    if PARTITION in df.columns:
        write_tsv(df, path, partition_by=PARTITION)
    else:
        day = load_date or dt.date.today()
        write_tsv(df, f"{path}/{PARTITION}={day.isoformat() if isinstance(day, dt.date) else day}")
    return path


def write_landing_many(frames: dict[str, DataFrame], root: str, load_date: str | dt.date | None = None, parallel: int = 4) -> list[str]:
    """Land several independent extracts.  Each write is its own Spark job;
    they are submitted from a few driver threads so small extracts share
    the cluster instead of queueing one after another."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(lambda item: write_landing(item[1], root, item[0], load_date), frames.items()))


def load_dates(spark: SparkSession, root: str) -> list[str]:
    """Distinct load dates under ``root``, newest first, from folder names."""
    found = set()
    for name in children(spark, root):
        if _DATE.fullmatch(name):
            found.add(name)
        elif name.endswith(".tsv"):
            found.update(m.group(1) for c in children(spark, f"{root.rstrip('/')}/{name}") if (m := _DATE_DIR.fullmatch(c)))
    return sorted(found, reverse=True)


def latest_load_date(spark: SparkSession, root: str) -> str | None:
    dates = load_dates(spark, root)
    return dates[0] if dates else None


def landed_at(spark: SparkSession, root: str, name: str, day: str) -> str | None:
    """Where an extract of a day lies, in either layout."""
    flat = f"{root.rstrip('/')}/{day}/{name}.tsv"
    for path in (f"{landing_path(root, name)}/{PARTITION}={day}", flat, f"{flat}.gz"):
        if exists(spark, path):
            return path
    return None


def read_landing(spark: SparkSession, root: str, name: str, load_date: str | None = None) -> DataFrame:
    """One extract at one load date (default: the latest under ``root``),
    columns as text in the order of that day's header.  Only that day's files
    are opened; without any a ``FileNotFoundError`` names what is missing."""
    day = load_date or latest_load_date(spark, root)
    path = landed_at(spark, root, name, day) if day else None
    if path is None:
        raise FileNotFoundError(f"no extract {name} under {root}" + (f" for {day}" if day else ""))
    return read_tsv(spark, path)


def split_landing(spark: SparkSession, root: str, name: str, out_root: str, load_date: str | None = None, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Re-land one day's extract as files of ``rows_per_file`` rows at most.

    Gzip cannot be split, so an extract that arrives as one large file is read
    by one task, whoever reads it.  Here that task reads it once, as a stream
    and without a shuffle, and begins a new file (with its own header) every
    ``rows_per_file`` rows; all later reads are spread over the cluster.
    """
    day = load_date or latest_load_date(spark, root)
    path = f"{landing_path(out_root, name)}/{PARTITION}={day}"
    if root.rstrip("/") == out_root.rstrip("/") and landed_at(spark, root, name, day) == path:
        raise ValueError(f"extract {name} of {day} cannot be split onto itself; name another out_root")
    write_tsv(read_landing(spark, root, name, day), path, rows_per_file=rows_per_file)
    return path


def table_name(path: Column | None = None) -> Column:
    """Table name from a landed file's path: the extract's base name
    without ``.tsv`` / ``.tsv.gz``, dots turned into underscores
    (``.../title.basics.tsv/...`` -> ``title_basics``)."""
    p = F.col("_metadata.file_path") if path is None else path
    base = F.regexp_extract(p, r"([^/]+)\.tsv(\.gz)?(/.*)?$", 1)
    return F.regexp_replace(base, r"\.", "_")


def with_table_name(df: DataFrame, out: str = "table_name") -> DataFrame:
    return df.withColumn(out, table_name())


def with_load_time(df: DataFrame, at: Column | dt.datetime | None = None, out: str = "_processing_time") -> DataFrame:
    """Stamp rows with the load time (``current_timestamp`` unless given,
    so tests can pin it)."""
    if at is None:
        value = F.current_timestamp()
    elif isinstance(at, Column):
        value = at
    else:
        value = F.lit(at).cast("timestamp")
    return df.withColumn(out, value)
