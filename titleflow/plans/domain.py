"""Silver tables of the domain: the bronze stand-ins passed through the
cleaning operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titleflow.operators import clean as C
from titleflow.plans import fixtures as X

BRONZE = {
    "title_basics": X.bronze_title_basics,
    "title_akas": X.bronze_title_akas,
    "title_crew": X.bronze_title_crew,
    "title_episode": X.bronze_title_episode,
    "title_principals": X.bronze_title_principals,
    "title_ratings": X.bronze_title_ratings,
    "name_basics": X.bronze_name_basics,
}


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BRONZE[name](spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "title_plots":
        return X.silver_title_plots(spark, sf_dir)
    return C.clean(bronze(spark, sf_dir, name), name)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.assemble import assemble_gold

    s = lambda n: silver(spark, sf_dir, n)
    return assemble_gold(
        s("title_plots"), s("title_basics"), s("title_ratings"), s("title_principals"), s("title_crew"), s("name_basics")
    )
