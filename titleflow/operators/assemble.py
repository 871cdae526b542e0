"""Silver -> gold: one wide row per title with its people as arrays.

The people of all three roles go into one long table
``(tconst, role, pos, nconst)``, are named with ONE join against the people
table, and are folded back with ONE aggregation on ``tconst`` that builds
the three arrays with conditional ``collect_list``.  Compared with one join
and one aggregation per role this reads the people table once and shuffles
the long table twice instead of six times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.functions.columns import NULL_MARKER, sorted_values

ROLES = (("actor", "actors"), ("director", "directors"), ("writer", "writers"))
ACTOR_CATEGORIES = ("actor", "actress")


def people_long(principals: DataFrame | None, crew: DataFrame | None) -> DataFrame:
    """(tconst, role, pos, nconst) for actors (from principals, ``pos`` =
    billing order) and directors / writers (from the crew comma lists,
    ``pos`` = place in the list).

    Semantics kept from the source pipeline: a ``\\N`` director list yields
    one unknown id (so the title gets an empty list), while ``\\N`` writer
    ids are dropped (so a title without writers gets none at all).
    """
    parts = []
    if principals is not None:
        parts.append(
            principals.filter(F.col("category").isin(*ACTOR_CATEGORIES)).select(
                "tconst", F.lit("actor").alias("role"), F.col("ordering").cast("int").alias("pos"), "nconst"
            )
        )
    if crew is not None:
        roles = F.explode(
            F.array(
                F.struct(F.lit("director").alias("role"), F.col("directors").alias("ids")),
                F.struct(F.lit("writer").alias("role"), F.col("writers").alias("ids")),
            )
        ).alias("r")
        exploded = (
            crew.select("tconst", roles)
            .select("tconst", "r.role", F.posexplode(F.split("r.ids", ",")).alias("pos", "nconst"))
            .filter((F.col("role") != "writer") | (F.col("nconst") != NULL_MARKER))
        )
        parts.append(exploded.select("tconst", "role", F.col("pos").cast("int").alias("pos"), "nconst"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def name_people(long: DataFrame, names: DataFrame) -> DataFrame:
    """Attach ``primaryName``; ids missing from the people table keep a NULL
    name (and later vanish from the list).  Marker ids, which a large share of
    titles have in common, name nobody and go past the join."""
    marker = F.col("nconst").isNull() | (F.col("nconst") == NULL_MARKER)
    named = long.where(~marker).join(names.select("nconst", "primaryName"), "nconst", "left").select(*long.columns, "primaryName")
    return named.unionByName(long.where(marker).withColumn("primaryName", F.lit(None).cast("string")))


def people_lists(named: DataFrame, roles=ROLES) -> DataFrame:
    """Fold the named long table into per-title arrays, ordered by ``pos``
    (then id).  A role with no rows for a title gives NULL; a role whose ids
    are all unknown gives an empty array."""
    aggs = []
    for role, out in roles:
        is_role = F.col("role") == role
        entries = F.collect_list(
            F.when(is_role & F.col("primaryName").isNotNull(), F.struct("pos", "nconst", "primaryName"))
        )
        aggs.append(F.when(F.count_if(is_role) > 0, sorted_values(entries, "primaryName")).alias(out))
    return named.groupBy("tconst").agg(*aggs)


def actor_lists(principals: DataFrame, names: DataFrame) -> DataFrame:
    return people_lists(name_people(people_long(principals, None), names), roles=ROLES[:1])


def crew_lists(crew: DataFrame, names: DataFrame) -> DataFrame:
    return people_lists(name_people(people_long(None, crew), names), roles=ROLES[1:])


def assemble_gold(
    plots: DataFrame,
    basics: DataFrame,
    ratings: DataFrame,
    principals: DataFrame,
    crew: DataFrame,
    names: DataFrame,
) -> DataFrame:
    """The prediction input: titles having a plot, with basics (inner), and
    rating and people lists (left).

    The people rows are first restricted to titles that have a plot (a left
    semi join; AQE turns it into a broadcast when the plot keys are small at
    run time), so the people join and aggregation only touch sampled titles.
    """
    keys = plots.select("tconst").distinct()
    long = people_long(principals, crew).join(keys, "tconst", "left_semi")
    return _assemble(plots, keys, basics, ratings, name_people(long, names))


def assemble_named(plots: DataFrame, basics: DataFrame, ratings: DataFrame, named: DataFrame) -> DataFrame:
    """:func:`assemble_gold` over credits that are named already (a stored
    layer): every join and aggregation is on tconst, so tables bucketed by it
    need no exchange."""
    keys = plots.select("tconst").distinct()
    return _assemble(plots, keys, basics, ratings, named.join(keys, "tconst", "left_semi"))


def _assemble(plots: DataFrame, keys: DataFrame, basics: DataFrame, ratings: DataFrame, named: DataFrame) -> DataFrame:
    lists = people_lists(named)
    b = basics.select("tconst", "primaryTitle", "startYear", "genres")
    r = ratings.select("tconst", "averageRating")
    # Everything but the plot text is assembled first (narrow rows keyed by
    # tconst); the text joins once, at the end, so it is not carried through
    # every shuffle (AQE broadcasts the narrow side when it is small).
    core = keys.join(b, "tconst").join(r, "tconst", "left").join(lists, "tconst", "left")
    return plots.select("tconst", "plot").join(core, "tconst").select(
        "tconst",
        F.col("primaryTitle").alias("title"),
        "plot",
        F.col("startYear").alias("year"),
        "genres",
        "averageRating",
        "directors",
        "writers",
        "actors",
    )
