"""Feature operators: lookups (person stats, name index, global mean), role
scores, the year z-score, list normalisation and genre multi-hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.functions.columns import NULL_MARKER, as_list
from titleflow.operators.assemble import people_long

# Fixed names of the model's numeric inputs.
ROLE_LISTS = (("actors", "actor"), ("directors", "director"), ("writers", "writer"))
SCORE_COLS = tuple(f"{role}_score_{s}" for _, role in ROLE_LISTS for s in ("mean", "max"))
NUMERIC_COLS = SCORE_COLS + ("numVotes_log1p", "startYear_z")
# Principals and ratings whose titles one task reduces, about.
TASK_CREDITS = 500_000


# ------------------------------------------------------------------ lookups
def title_credits(principals: DataFrame, crew: DataFrame, ratings: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """(tconst, role, nconst, rating): each person once per rated title and role."""
    long = people_long(principals, crew).filter(F.col("nconst") != NULL_MARKER)
    # A task holds its titles' credits: where the session's partitions would get too many, there are more of them.
    spark = ratings.sparkSession
    tasks = -(-(principals.count() + ratings.count()) // TASK_CREDITS)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        long = long.repartition(tasks, "tconst")
    return long.join(_rated(ratings, titles), "tconst").groupBy("tconst", "role", "nconst").agg(F.max("averageRating").alias("rating"))


def _rated(ratings: DataFrame, titles: DataFrame | None) -> DataFrame:
    r = ratings.select("tconst", "averageRating")
    return r if titles is None else r.join(titles.select("tconst"), "tconst", "left_semi")


def person_stats(
    principals: DataFrame, crew: DataFrame, ratings: DataFrame, titles: DataFrame | None = None
) -> DataFrame:
    """(nconst, role, score_role): a person's mean rating over the distinct
    titles they have in that role (actresses count as actors).

    Pass ``titles`` (e.g. the training part) to keep held-out labels out.
    Plan: join on tconst, de-duplicate (tconst, role, nconst) on the join's
    own partitioning (no shuffle), then one partial/final average per
    person: a hugely popular person is pre-aggregated map-side.
    """
    per_title = title_credits(principals, crew, ratings, titles)
    # The sum is exact (decimal), so the mean does not depend on the order
    # rows arrive in, i.e. on partitioning.
    exact = F.avg(F.col("rating").cast("decimal(38,18)")).cast("double")
    return per_title.groupBy("nconst", "role").agg(exact.alias("score_role"))


def name_index(names: DataFrame) -> DataFrame:
    """(name, nconst), distinct; a name may map to several people."""
    return names.select(F.col("primaryName").alias("name"), "nconst").distinct()


def global_avg(ratings: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """One row: the mean rating, used to impute missing role scores."""
    r = ratings if titles is None else ratings.join(titles.select("tconst"), "tconst", "left_semi")
    return r.agg(F.avg("averageRating").alias("global_avg"))


# ------------------------------------------------------------------ role scores
def role_name_long(base: DataFrame, keys: Sequence[str], lists=ROLE_LISTS) -> DataFrame:
    """(keys..., role, name): the base's people lists in one long table."""
    roles = F.explode(
        F.array(*[F.struct(F.lit(role).alias("role"), F.col(lst).alias("names")) for lst, role in lists])
    )
    return (
        base.select(*keys, roles.alias("r"))
        .select(*keys, F.col("r.role").alias("role"), F.explode("r.names").alias("name"))
    )


def name_roles(names_idx: DataFrame, stats: DataFrame) -> DataFrame:
    """(name, role, n, score_sum, score_max) over the people of that name with a score in the role."""
    per_person = names_idx.where(F.col("name").isNotNull()).join(stats.select("nconst", "role", "score_role"), "nconst")
    return per_person.groupBy("name", "role").agg(
        F.count("score_role").alias("n"), F.sum("score_role").alias("score_sum"), F.max("score_role").alias("score_max")
    )


def role_scores(
    base: DataFrame,
    names_idx: DataFrame,
    stats: DataFrame,
    fill: Column | float,
    keys: Sequence[str] = ("tconst",),
) -> DataFrame:
    """Add the six ``<role>_score_{mean,max}`` columns to ``base``.

    Every name in a role list is looked up in the name index (homonyms fan
    out: every matching person enters the mean), then in the person stats
    of that role; mean and max are taken per row of ``base``; rows without
    any score get ``fill`` (the global mean).  The small lookups are joined
    first, so the long (row, role, name) side is shuffled once.
    """
    keys = list(keys)
    scored = role_name_long(base, keys).join(name_roles(names_idx, stats), ["name", "role"])
    aggs = []
    for _, role in ROLE_LISTS:
        total, n, best = (F.when(F.col("role") == role, F.col(c)) for c in ("score_sum", "n", "score_max"))
        aggs += [(F.sum(total) / F.sum(n)).alias(f"{role}_score_mean"), F.max(best).alias(f"{role}_score_max")]
    per_key = scored.groupBy(*keys).agg(*aggs)
    fill_col = fill if isinstance(fill, Column) else F.lit(float(fill))
    out = base.join(per_key, keys, "left")
    return out.select(
        *[F.col(c) for c in base.columns], *[F.coalesce(F.col(c), fill_col).alias(c) for c in SCORE_COLS]
    )


#: Ratings in whole millionths: sums are exact whatever the order of rows.
MILLIONTHS = 1_000_000


def own_out_scores(
    base: DataFrame, names_idx: DataFrame, principals: DataFrame, crew: DataFrame, ratings: DataFrame, titles: DataFrame | None = None
) -> DataFrame:
    """``role_scores`` for titles whose own rating may be among the ratings: it is left out.

    A person's score for a title is the mean over the person's *other* titles
    in that role (of ``titles``, if given): the sum and count per (person,
    role) less the credit in this very title.  A person without other titles
    has no score, and the mean rating that fills gaps leaves the title's own
    rating out too.  So no training label enters its own row's features, while
    a title outside ``titles`` gets what ``role_scores`` gives it.

    Plan: credits are reduced once; the long (title, person, role) side meets
    the sums on (person, role) and its own credit on (title, person, role).
    """
    scaled = lambda c: F.round(F.col(c) * MILLIONTHS).cast("bigint")
    credits = title_credits(principals, crew, ratings, titles).select("tconst", "role", "nconst", scaled("rating").alias("own"))
    sums = credits.groupBy("nconst", "role").agg(F.sum("own").alias("total"), F.count("own").alias("n"))
    people = role_name_long(base, ["tconst"]).join(names_idx.where(F.col("name").isNotNull()), "name")
    met = people.join(sums, ["nconst", "role"]).join(credits, ["tconst", "role", "nconst"], "left")
    others = F.col("n") - F.col("own").isNotNull().cast("bigint")
    score = F.when(others > 0, (F.col("total") - F.coalesce("own", F.lit(0))) / others / MILLIONTHS)
    aggs = [
        f(F.when(F.col("role") == role, score)).alias(f"{role}_score_{name}")
        for _, role in ROLE_LISTS
        for f, name in ((F.avg, "mean"), (F.max, "max"))
    ]
    rated = _rated(ratings, titles).select("tconst", scaled("averageRating").alias("_own")).where(F.col("_own").isNotNull())
    corpus = rated.agg(F.struct(F.sum("_own").alias("total"), F.count("_own").alias("n"))).scalar()
    rest = corpus["n"] - F.col("_own").isNotNull().cast("bigint")
    fill = F.when(rest > 0, (corpus["total"] - F.coalesce("_own", F.lit(0))) / rest / MILLIONTHS)
    out = base.join(met.groupBy("tconst").agg(*aggs), "tconst", "left").join(rated, "tconst", "left")
    return out.select(*[F.col(c) for c in base.columns], *[F.coalesce(F.col(c), fill).alias(c) for c in SCORE_COLS])


# ------------------------------------------------------------------ year z-score
def year_stats(df: DataFrame, year_col: str = "year") -> Column:
    """A scalar struct (mu, sigma) over ``df``: mean -> 0.0 when NULL,
    sample stddev -> 1.0 when NULL (one row) or 0 (all equal)."""
    y = F.col(year_col).cast("double")
    agg = df.agg(F.avg(y).alias("mu"), F.stddev_samp(y).alias("sigma"))
    return agg.select(
        F.struct(
            F.coalesce(F.col("mu"), F.lit(0.0)).alias("mu"),
            F.when(F.col("sigma").isNull() | (F.col("sigma") == 0), F.lit(1.0)).otherwise(F.col("sigma")).alias("sigma"),
        )
    ).scalar()


def year_zscore(df: DataFrame, year_col: str = "year", out: str = "startYear_z", stats: Column | None = None) -> DataFrame:
    """``(year - mu) / sigma`` with the statistics of ``df`` (or ``stats``).
    A NULL year stays NULL here; the model's vector stage fills it with 0."""
    st = year_stats(df, year_col) if stats is None else stats
    return df.withColumn(out, (F.col(year_col).cast("double") - st["mu"]) / st["sigma"])


def votes_feature(df: DataFrame, votes_col: str | None = None, out: str = "numVotes_log1p") -> DataFrame:
    """``log1p(votes)``; the source pipeline has no votes in gold and uses a
    constant 0.0, which is the default here."""
    value = F.lit(0.0) if votes_col is None else F.log1p(F.col(votes_col).cast("double"))
    return df.withColumn(out, value)


# ------------------------------------------------------------------ genres
def normalize_list(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Array columns pass through, text is split on ``\\s*,\\s*``; NULL ->
    empty array; items trimmed; blanks and the ``\\N`` marker dropped."""
    return df.withColumn(out or col, as_list(F.col(col), df.schema[col].dataType))


def genre_vocabulary(df: DataFrame, col: str = "genres") -> list[str]:
    """The fitted vocabulary: all distinct genres, sorted.  It is part of the
    model (one feature each), counted and sorted by Spark's own indexer."""
    each = df.select(F.explode(col).alias("g")).where(F.col("g").isNotNull())
    return list(StringIndexer(inputCol="g", outputCol="i", stringOrderType="alphabetAsc").fit(each).labels)


def genre_encoder(vocab: list[str], col: str = "genres", out: str = "genres_vec") -> CountVectorizerModel:
    """Binary bag over the sorted vocabulary; unknown genres are ignored."""
    return CountVectorizerModel.from_vocabulary(vocab, inputCol=col, outputCol=out, binary=True)


def genre_multihot(df: DataFrame, col: str = "genres", out: str = "genres_vec", vocab: list[str] | None = None) -> DataFrame:
    vocab = genre_vocabulary(df, col) if vocab is None else vocab
    return genre_encoder(vocab, col, out).transform(df)


def multihot_text(vec_col: str) -> Column:
    """A multi-hot vector as ``0|1|...`` text (for comparisons)."""
    return F.array_join(F.transform(vector_to_array(F.col(vec_col)), lambda x: x.cast("int").cast("string")), "|")

