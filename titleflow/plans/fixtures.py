"""Domain tables derived from the driver's generated tables.

The driver ships TPC-H-like parquet tables; the catalogue pipeline needs raw
title / people / rating extracts.  These functions derive them with plain
DataFrame code, as *bronze* tables (every column text, the ``\\N`` marker
where a value is missing) so that the cleaning operators have real work to
do.  :mod:`titleflow.plans.oracle` writes the same derivations in DuckDB SQL.

Mapping (every row of the source tables is used):

* titles, ratings, crew  <- ``orders`` (one title per order)
* genres                 <- distinct ``part.p_type`` of the order's lines
* people                 <- ``supplier`` and ``customer`` (names share the
  numeric suffix, so a supplier and a customer can be homonyms)
* principals, akas, episodes <- ``lineitem`` (one row per line)
* writers                <- suppliers on lines with return flag ``N``
* plots                  <- ``documents`` (whole texts)
* lookup responses       <- ``events``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.functions.columns import NULL_MARKER



def _mark() -> Column:
    return F.lit(NULL_MARKER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _id(prefix: str, c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), c.cast("string"))


def _str(c: Column) -> Column:
    return c.cast("string")


def genre_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: the distinct part types of its lines, sorted, comma-joined."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy("l_orderkey")
        .agg(F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("genres"))
    )


def writer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: writer ids of its ``N``-flagged lines in line order."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "N")
    return li.groupBy("l_orderkey").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))),
                lambda x: _id("ns", x["l_suppkey"]),
            ),
            ",",
        ).alias("writers")
    )


def bronze_title_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    g = genre_lists(spark, sf_dir)
    status, prio, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    year = F.year("o_orderdate")
    return o.join(g, o.o_orderkey == g.l_orderkey, "left").select(
        _id("tt", "o_orderkey").alias("tconst"),
        F.lit("movie").alias("titleType"),
        F.concat(F.lit("Title "), _str(F.col("o_orderkey"))).alias("primaryTitle"),
        F.when((prio == "5-LOW") & (status == "P"), _mark()).otherwise(_str(year)).alias("startYear"),
        F.when(status == "F", _str(year + 1)).otherwise(_mark()).alias("endYear"),
        F.when((prio == "3-MEDIUM") & (status == "O"), _mark())
        .otherwise(_str(F.lit(60) + F.floor(price / 5000)))
        .alias("runtimeMinutes"),
        F.when(prio == "1-URGENT", F.lit("1")).otherwise(F.lit("0")).alias("isAdult"),
        F.coalesce(F.col("genres"), _mark()).alias("genres"),
    )


def bronze_title_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.select(
        _id("tt", "o_orderkey").alias("tconst"),
        F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P"), F.lit("N/A"))
        .otherwise(_str(F.floor(price / 5000) / F.lit(10.0)))
        .alias("averageRating"),
        _str(F.floor(price / 100)).alias("numVotes"),
    )


def bronze_name_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(
        _id("ns", "s_suppkey").alias("nconst"),
        F.regexp_replace("s_name", "^Supplier", "Person").alias("primaryName"),
        F.when(F.col("s_acctbal") < 0, _mark()).otherwise(_str(F.lit(1930) + F.col("s_nationkey"))).alias("birthYear"),
        _mark().alias("deathYear"),
    )
    c = table(spark, sf_dir, "customer").select(
        _id("nc", "c_custkey").alias("nconst"),
        F.regexp_replace("c_name", "^Customer", "Person").alias("primaryName"),
        _str(F.lit(1940) + F.col("c_nationkey")).alias("birthYear"),
        F.when(F.col("c_acctbal") < 0, _str(F.lit(2000) + F.col("c_nationkey"))).otherwise(_mark()).alias("deathYear"),
    )
    return s.unionByName(c)


def bronze_title_principals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    return li.select(
        _id("tt", "l_orderkey").alias("tconst"),
        _str(F.col("l_linenumber")).alias("ordering"),
        _id("ns", "l_suppkey").alias("nconst"),
        F.when(flag == "A", F.lit("actor")).when(flag == "R", F.lit("actress")).otherwise(F.lit("self")).alias("category"),
    )


def bronze_title_crew(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    w = writer_lists(spark, sf_dir)
    cust = _str(F.col("o_custkey"))
    directors = (
        F.when(F.col("o_orderstatus") == "P", _mark())
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("nc"), cust, F.lit(",nx"), cust))
        .otherwise(F.concat(F.lit("nc"), cust))
    )
    return o.join(w, o.o_orderkey == w.l_orderkey, "left").select(
        _id("tt", "o_orderkey").alias("tconst"),
        directors.alias("directors"),
        F.coalesce(F.col("writers"), _mark()).alias("writers"),
    )


def bronze_title_akas(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _id("tt", "l_orderkey").alias("titleId"),
        _str(F.col("l_linenumber")).alias("ordering"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Aka "), _str(F.col("l_partkey"))))
        .alias("title"),
        F.when(F.col("l_linenumber") == 1, F.lit("1"))
        .when(F.col("l_linestatus") == "O", F.lit("0"))
        .otherwise(_mark())
        .alias("isOriginalTitle"),
    )


def bronze_title_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(_id("tt", "l_orderkey"), F.lit("-"), _str(F.col("l_linenumber"))).alias("tconst"),
        _id("tt", "l_orderkey").alias("parentTconst"),
        F.when(F.col("l_returnflag") == "N", _mark()).otherwise(_str(F.col("l_linenumber"))).alias("seasonNumber"),
        _str(F.floor("l_quantity")).alias("episodeNumber"),
    )


def silver_title_plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lang = F.col("lang")
    year = (
        F.when(lang == "en", F.lit(2001))
        .when(lang == "fr", F.lit(2002))
        .when(lang == "es", F.lit(2003))
        .otherwise(F.lit(2004))
    )
    return d.select(
        _id("tt", "doc_id").alias("tconst"),
        F.concat(F.lit("Doc "), _str(F.col("doc_id"))).alias("title"),
        year.cast("int").alias("year"),
        F.col("text").alias("plot"),
    )


def lookup_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored lookup-service replies, one per event, as raw JSON text.

    ``error`` events reply ``Response: False``; ``view`` events carry the
    ``N/A`` plot; ``signup`` replies lack their closing brace (malformed).
    """
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    uid = _str(F.col("user_id"))
    body = F.concat(
        F.lit('{"Response": "'),
        F.when(et == "error", F.lit("False")).otherwise(F.lit("True")),
        F.lit('", "Title": "Title '),
        uid,
        F.lit('", "Year": "'),
        _str(F.year("ts")),
        F.lit('", "Plot": "'),
        F.when(et == "view", F.lit("N/A")).otherwise(F.concat(F.lit("Plot of "), et, F.lit(" "), _str(F.col("event_id")))),
        F.lit('", "Meta": '),
        F.col("props"),
        F.when(et == "signup", F.lit("")).otherwise(F.lit("}")),
    )
    return e.select(_id("tt", "event_id").alias("tconst"), body.alias("body"))


def ratings_load(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """Two successive rating extracts for the upsert.

    Load 1 holds the titles of orders not in status ``P``; load 2 holds
    those not in status ``F``, with one more vote each.  So load 2 updates
    the ``O`` titles, inserts the ``P`` ones and leaves the ``F`` ones.
    """
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    votes = F.floor(price / 100) + (1 if load == 2 else 0)
    skip = "P" if load == 1 else "F"
    return o.filter(F.col("o_orderstatus") != skip).select(
        _id("tt", "o_orderkey").alias("tconst"),
        _str(F.floor(price / 5000) / F.lit(10.0)).alias("averageRating"),
        _str(votes).alias("numVotes"),
    )


def scoring_requests(gold: DataFrame) -> DataFrame:
    """One scoring request per gold title: "what if this title's people
    were recombined?" -- its genres, plot and actor / director / writer
    lists, asking for the best one to three combinations, or (every fourth
    title) with no ``top_k``.  The number of requests grows with the
    catalogue."""
    from titleflow.functions.columns import as_list

    return gold.select(
        F.col("tconst").alias("request_id"),
        as_list(F.col("genres"), gold.schema["genres"].dataType).alias("genres"),
        "plot",
        "actors",
        "directors",
        "writers",
        F.nullif(F.expr("cast(substring(tconst, 3) AS bigint) % 4"), F.lit(0)).cast("int").alias("top_k"),
    )


def ratings_by_load_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ratings tagged with a landing date: January 1st of the
    order's year, so each year's titles land in their own partition."""
    o = table(spark, sf_dir, "orders")
    r = bronze_title_ratings(spark, sf_dir)
    return r.join(
        o.select(_id("tt", "o_orderkey").alias("tconst"), F.concat(_str(F.year("o_orderdate")), F.lit("-01-01")).alias("load_date")),
        "tconst",
    )


# Landing names of the seven extracts (fixed values of the source files).
EXTRACTS = {
    "title.basics": "title_basics",
    "title.akas": "title_akas",
    "title.crew": "title_crew",
    "title.episode": "title_episode",
    "title.principals": "title_principals",
    "title.ratings": "title_ratings",
    "name.basics": "name_basics",
}
