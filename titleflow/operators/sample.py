"""Rating histogram, rating bands and the exact, repeatable stratified sample.

The sample takes, per band, the ``quota`` rows with the smallest seeded md5
of the key (ties broken by the key).  That order does not depend on the
partitioning, so the sample is identical at any parallelism and equal to
the SQL oracle's ``row_number() ... <= quota``.

A plain ``row_number`` window partitioned by band would send every row of
a band to one task.  Instead the hash's leading hex digits split each band
into ``16**bucket_digits`` buckets (uniform, whatever the key skew): one
partial aggregate counts rows per (band, bucket); a running sum over that
small table finds the bucket where the quota is reached; rows in earlier
buckets are taken outright and only the rows of that single boundary bucket
are ranked.  Nothing but the boundary bucket is ever sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleflow.functions.columns import rating_band, seeded_order_key

# Fixed values of the source pipeline's sample.
DEFAULT_TOTAL = 300000
DEFAULT_SHARES = {"low": 0.2, "medium_low": 0.3, "medium_high": 0.3, "high": 0.2}
DEFAULT_MIN_VOTES = 1000
DEFAULT_SEED = 42


def rating_histogram(ratings: DataFrame, rating_col: str = "averageRating") -> DataFrame:
    """Count of titles per whole rating point, ascending."""
    return (
        ratings.groupBy(F.floor(rating_col).alias("rating_floor"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("rating_floor")
    )


def with_rating_band(
    ratings: DataFrame,
    min_votes: int = DEFAULT_MIN_VOTES,
    rating_col: str = "averageRating",
    votes_col: str = "numVotes",
    band_col: str = "rating_group",
) -> DataFrame:
    """Titles with at least ``min_votes`` votes, labelled with their band."""
    return ratings.filter(F.col(votes_col) >= min_votes).withColumn(band_col, rating_band(rating_col))


def quotas(total: int = DEFAULT_TOTAL, shares: dict[str, float] | None = None) -> dict[str, int]:
    """``int(total * share)`` per band; a short band is not topped up."""
    shares = DEFAULT_SHARES if shares is None else shares
    return {band: int(total * share) for band, share in shares.items()}


def _quota_of(band: Column, quota: dict[str, int]) -> Column:
    m = F.create_map(*[x for k, v in quota.items() for x in (F.lit(k), F.lit(int(v)))])
    return F.coalesce(F.element_at(m, band), F.lit(0))


def stratified_sample(
    df: DataFrame,
    key: str,
    band_col: str,
    quota: dict[str, int],
    seed: int = DEFAULT_SEED,
    bucket_digits: int = 4,
) -> DataFrame:
    """Exact per-band sample of ``quota[band]`` rows (see module docstring)."""
    h = seeded_order_key(key, seed)
    tagged = df.withColumn("_h", h).withColumn("_b", F.conv(F.substring("_h", 1, bucket_digits), 16, 10).cast("int"))
    counts = tagged.groupBy(band_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(band_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    q = _quota_of(F.col(band_col), quota)
    plan = (
        counts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        .withColumn("_left", q - F.col("_before"))
        .filter(F.col("_left") > 0)
        .select(band_col, "_b", F.when(F.col("_left") >= F.col("_n"), F.lit(None)).otherwise(F.col("_left")).alias("_edge"))
    )
    # At most |bands| * 16**bucket_digits rows (262,144 for four bands): a
    # size bound that does not grow with the data, so it is broadcast.
    joined = tagged.join(F.broadcast(plan), [band_col, "_b"])
    whole = joined.filter(F.col("_edge").isNull())
    edge = joined.filter(F.col("_edge").isNotNull())
    rank = F.row_number().over(Window.partitionBy(band_col, "_b").orderBy("_h", key))
    edge = edge.withColumn("_r", rank).filter(F.col("_r") <= F.col("_edge")).drop("_r")
    return whole.unionByName(edge).drop("_h", "_b", "_edge")


def sample_titles(
    ratings: DataFrame,
    total: int = DEFAULT_TOTAL,
    shares: dict[str, float] | None = None,
    min_votes: int = DEFAULT_MIN_VOTES,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The source pipeline's sample: voted titles, banded, exact quotas."""
    banded = with_rating_band(ratings, min_votes)
    return stratified_sample(banded, "tconst", "rating_group", quotas(total, shares), seed)
