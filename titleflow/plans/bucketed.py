"""Silver as catalog tables bucketed by their join keys, and gold from them.

Titles, ratings, plots and named credits are bucketed and sorted by tconst,
people and unnamed credits by nconst, all into the same number of buckets.  The
shuffle is paid once, when a table is written; naming the credits and
assembling gold then read buckets side by side without an exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.functions.columns import NULL_MARKER
from titleflow.operators.assemble import assemble_named, name_people, people_long
from titleflow.sources.catalog import ensure_schema

BUCKETS = 32
TITLE_TABLES = ("title_plots", "title_basics", "title_ratings")


def store(df: DataFrame, table: str, key: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` as table ``table`` at ``path``, bucketed and sorted by ``key``; one file a bucket."""
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def named_credits(spark: SparkSession, schema: str) -> DataFrame:
    """Credits with names, from tables bucketed by nconst."""
    return spark.table(f"{schema}.credits").join(spark.table(f"{schema}.name_basics"), "nconst", "left").select("tconst", "role", "pos", "nconst", "primaryName")


def store_silver(spark: SparkSession, schema: str, silver: Callable[[str], DataFrame], root: str, buckets: int = BUCKETS) -> None:
    """Store the tables that gold needs in catalog schema ``schema``, files under ``root``."""
    ensure_schema(spark, schema)
    for t in TITLE_TABLES:
        store(silver(t), f"{schema}.{t}", "tconst", f"{root}/{t}", buckets)
    store(silver("name_basics").select("nconst", "primaryName"), f"{schema}.name_basics", "nconst", f"{root}/name_basics", buckets)
    long = people_long(silver("title_principals"), silver("title_crew"))
    # Marker ids name nobody; together they would fill one bucket, so they go past the join.
    marker = F.col("nconst").isNull() | (F.col("nconst") == NULL_MARKER)
    store(long.where(~marker), f"{schema}.credits", "nconst", f"{root}/credits", buckets)
    nameless = name_people(long.where(marker), spark.table(f"{schema}.name_basics"))
    named = named_credits(spark, schema).unionByName(nameless)
    store(named, f"{schema}.named_credits", "tconst", f"{root}/named_credits", buckets)


def gold_from(spark: SparkSession, schema: str) -> DataFrame:
    """The prediction input from the bucketed tables of ``schema``."""
    t = lambda n: spark.table(f"{schema}.{n}")
    return assemble_named(t("title_plots"), t("title_basics"), t("title_ratings"), t("named_credits"))
