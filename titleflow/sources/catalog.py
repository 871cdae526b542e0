"""Catalog names for snapshot tables.

A layer is a catalog schema (``CREATE SCHEMA IF NOT EXISTS``); a table is
an external parquet table whose location is its newest snapshot folder.
Publishing a new snapshot moves the location (``ALTER TABLE ... SET
LOCATION``), so readers of ``spark.table(name)`` switch atomically from one
complete snapshot to the next and never see a half-written one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titleflow.sources.tables import VERSION, versions


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quote(schema)}")


def publish(spark: SparkSession, name: str, root: str, version: int | None = None) -> str:
    """Point catalog table ``schema.table`` at a snapshot of ``root`` (the
    newest by default); create the schema and the table when absent.
    Returns the snapshot location now published."""
    vs = versions(spark, root)
    if not vs:
        raise FileNotFoundError(f"no snapshot under {root}")
    v = vs[-1] if version is None else version
    location = f"{root.rstrip('/')}/{VERSION}={v}"
    if "." in name:
        ensure_schema(spark, name.rsplit(".", 1)[0])
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {_quote(name)} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {_quote(name)} USING parquet LOCATION '{location}'")
    return location


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
