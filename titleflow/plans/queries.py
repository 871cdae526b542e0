"""The query registry: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each matching the SQL of the same name in
:mod:`titleflow.plans.oracle` (arrays are rendered as ``|``-joined text so
that results compare order-insensitively across engines)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.functions.columns import render_list
from titleflow.operators import assemble as A
from titleflow.plans.domain import gold, silver
from titleflow.plans.oracle import OFF_TIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _render(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[render_list(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("assemble_gold")
def q_assemble_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _render(gold(spark, sf_dir), "directors", "writers", "actors")


@register("gold_from_buckets")
def q_gold_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over silver tables stored in buckets of their join keys."""
    import uuid

    from titleflow.plans.bucketed import gold_from, store_silver
    from titleflow.session import shared_path

    schema = f"titleflow_silver_{uuid.uuid4().hex[:12]}"
    store_silver(spark, schema, lambda n: silver(spark, sf_dir, n), shared_path(spark, "bucketed-silver"))
    return _render(gold_from(spark, schema), "directors", "writers", "actors")


@register("people_list")
def q_people_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = A.actor_lists(silver(spark, sf_dir, "title_principals"), silver(spark, sf_dir, "name_basics"))
    return _render(lists, "actors")


@register("csv_people_list")
def q_csv_people_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = A.crew_lists(silver(spark, sf_dir, "title_crew"), silver(spark, sf_dir, "name_basics"))
    return _render(lists, "directors", "writers")


# ------------------------------------------------------------------ cleaning
def _clean_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from titleflow.operators.clean import clean
        from titleflow.plans.domain import bronze

        return clean(bronze(spark, sf_dir, table), table)

    return run


for _key, _table in (
    ("clean_sentinel_int", "title_basics"),
    ("clean_numeric", "title_ratings"),
    ("clean_boolean", "title_akas"),
    ("clean_required", "title_principals"),
    ("clean_title_episode", "title_episode"),
    ("clean_title_crew", "title_crew"),
    ("clean_name_basics", "name_basics"),
):
    register(_key)(_clean_query(_table))


# ------------------------------------------------------------------ sampling
@register("rating_histogram")
def q_rating_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.sample import rating_histogram

    return rating_histogram(silver(spark, sf_dir, "title_ratings"))


@register("rating_band")
def q_rating_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.sample import with_rating_band

    return with_rating_band(silver(spark, sf_dir, "title_ratings"))


@register("stratified_sample")
def q_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.sample import sample_titles

    return sample_titles(silver(spark, sf_dir, "title_ratings"))


@register("stratified_sample_share")
def q_stratified_sample_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas from a tenth of the ratings, so that bands are cut at every scale."""
    from titleflow.operators.sample import sample_titles

    ratings = silver(spark, sf_dir, "title_ratings")
    return sample_titles(ratings, total=ratings.count() // 10)


# ------------------------------------------------------------------ upsert
@register("upsert")
def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.upsert import merge_frames
    from titleflow.plans.fixtures import ratings_load

    return merge_frames(ratings_load(spark, sf_dir, 1), ratings_load(spark, sf_dir, 2), ["tconst"])


@register("bucketed_merge")
def q_bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rating loads merged into a stored table, bucket by bucket."""
    from titleflow.plans.fixtures import ratings_load
    from titleflow.session import shared_path
    from titleflow.sources.buckets import merge_buckets, read_buckets

    root = shared_path(spark, "bucketed")
    for load in (1, 2):
        merge_buckets(spark, ratings_load(spark, sf_dir, load), root, ["tconst"])
    return read_buckets(spark, root)


@register("catalog_publish")
def q_catalog_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot table published in the catalog, merged, published again and read by name."""
    import uuid

    from titleflow.plans.fixtures import ratings_load
    from titleflow.session import shared_path
    from titleflow.sources.catalog import publish, read
    from titleflow.sources.tables import create_or_merge

    root, name = shared_path(spark, "published"), f"titleflow_bronze.ratings_{uuid.uuid4().hex[:12]}"
    for load in (1, 2):
        create_or_merge(spark, ratings_load(spark, sf_dir, load), root, ["tconst"])
        publish(spark, name, root)
    return read(spark, name)


# ------------------------------------------------------------------ enrichment
@register("parse_lookup_response")
def q_parse_lookup_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.enrich import title_plots
    from titleflow.plans.fixtures import lookup_responses

    return title_plots(lookup_responses(spark, sf_dir))


@register("enrichment_coverage")
def q_enrichment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.enrich import coverage, parse_replies
    from titleflow.plans.fixtures import lookup_responses

    return coverage(parse_replies(lookup_responses(spark, sf_dir)))


@register("title_plots_job")
def q_title_plots_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings -> sample -> replies -> the stored plots table, read back."""
    from titleflow.plans.fixtures import lookup_responses
    from titleflow.plans.medallion import ratings_to_plots
    from titleflow.session import shared_path

    root = shared_path(spark, "plots-job")
    silver(spark, sf_dir, "title_ratings").write.parquet(f"{root}/title_ratings")
    replies = lookup_responses(spark, sf_dir)
    ratings_to_plots(spark, root, lambda titles: replies.join(titles.select("tconst"), "tconst", "left_semi"))
    return spark.read.parquet(f"{root}/title_plots")


# ------------------------------------------------------------------ features
def _lookups(spark: SparkSession, sf_dir: str, titles: DataFrame | None = None):
    from titleflow.operators import features as Fe

    s = lambda n: silver(spark, sf_dir, n)
    stats = Fe.person_stats(s("title_principals"), s("title_crew"), s("title_ratings"), titles)
    return Fe.name_index(s("name_basics")), stats, Fe.global_avg(s("title_ratings"), titles)


def _train_lookups(spark: SparkSession, sf_dir: str, g: DataFrame):
    """Lookups of the training titles alone: no held-out label reaches a feature."""
    from titleflow.operators.model import split_flag

    return _lookups(spark, sf_dir, g.where(~split_flag("tconst")).select("tconst"))


def _own_out(spark: SparkSession, sf_dir: str, base: DataFrame, g: DataFrame) -> DataFrame:
    from titleflow.operators import features as Fe
    from titleflow.operators.model import split_flag

    s = lambda n: silver(spark, sf_dir, n)
    train = g.where(~split_flag("tconst")).select("tconst")
    return Fe.own_out_scores(base, Fe.name_index(s("name_basics")), s("title_principals"), s("title_crew"), s("title_ratings"), train)


def _r6(df: DataFrame, *cols: str, offset: float = 0.5) -> DataFrame:
    """Six decimals as ``floor(x * 1e6 + 0.5) / 1e6``: the same IEEE steps in
    every engine, so exact ties round alike (``round`` differs on them).
    ``offset``: see ``OFF_TIES``."""
    q = lambda c: F.floor(F.col(c) * F.lit(1e6) + F.lit(offset)) / F.lit(1e6)
    return df.select(*[q(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("person_stats")
def q_person_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stats, _ = _lookups(spark, sf_dir)
    return _r6(stats, "score_role")


@register("name_index")
def q_name_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.features import name_index

    return name_index(silver(spark, sf_dir, "name_basics"))


@register("role_scores")
def q_role_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.features import SCORE_COLS, role_scores

    idx, stats, gavg = _lookups(spark, sf_dir)
    base = gold(spark, sf_dir).select("tconst", "actors", "directors", "writers")
    out = role_scores(base, idx, stats, gavg.scalar())
    return _r6(out.select("tconst", *SCORE_COLS), *SCORE_COLS)


@register("role_scores_own_out")
def q_role_scores_own_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's role scores: over the training titles, each title's own rating left out."""
    from titleflow.operators.features import SCORE_COLS

    base = gold(spark, sf_dir).select("tconst", "actors", "directors", "writers")
    return _r6(_own_out(spark, sf_dir, base, base).select("tconst", *SCORE_COLS), *SCORE_COLS, offset=OFF_TIES)


@register("stored_lookups")
def q_stored_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role scores from the lookups stored beside a model, checked and read back."""
    from titleflow.operators.features import SCORE_COLS, role_scores
    from titleflow.operators.model import split_flag
    from titleflow.plans.medallion import read_lookups, store_lookups
    from titleflow.session import shared_path

    base = gold(spark, sf_dir).select("tconst", "actors", "directors", "writers")
    path = shared_path(spark, "model")
    store_lookups(lambda n: silver(spark, sf_dir, n), base.where(~split_flag("tconst")).select("tconst"), path)
    stats, idx, fill = read_lookups(spark, path)
    return _r6(role_scores(base, idx, stats, fill).select("tconst", *SCORE_COLS), *SCORE_COLS, offset=OFF_TIES)


@register("votes_log1p")
def q_votes_log1p(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.features import votes_feature

    ratings = silver(spark, sf_dir, "title_ratings").select("tconst", "numVotes")
    return _r6(votes_feature(ratings, "numVotes"), "numVotes_log1p")


@register("preview")
def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten gold rows by title id."""
    return _render(gold(spark, sf_dir).orderBy("tconst").limit(10), "directors", "writers", "actors")


@register("year_zscore")
def q_year_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.features import year_zscore

    base = gold(spark, sf_dir).select("tconst", "year")
    return _r6(year_zscore(base), "startYear_z")


@register("normalize_list")
def q_normalize_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.features import normalize_list

    base = silver(spark, sf_dir, "title_basics").select("tconst", "genres")
    return _render(normalize_list(base, "genres", "genres_list").select("tconst", "genres_list"), "genres_list")


@register("genre_multihot")
def q_genre_multihot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.features import genre_multihot, multihot_text, normalize_list

    base = normalize_list(silver(spark, sf_dir, "title_basics").select("tconst", "genres"), "genres")
    return genre_multihot(base).select("tconst", multihot_text("genres_vec").alias("genre_vector"))


# ------------------------------------------------------------------ text
@register("tokens")
def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.text import tokens

    return tokens(silver(spark, sf_dir, "title_plots"))


@register("tfidf")
def q_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.text import tfidf_long

    return _r6(tfidf_long(silver(spark, sf_dir, "title_plots")), "weight")


# ------------------------------------------------------------------ model
def _features(spark: SparkSession, sf_dir: str, g: DataFrame | None = None, lookups=None) -> DataFrame:
    """The model's feature frame, stored once in the shared folder: training,
    held-out scoring and request building all read it."""
    from titleflow.operators.model import feature_frame
    from titleflow.session import shared_path, stored

    # Gold is materialised first: the feature frame reads it twice (rows and
    # the year statistics).
    g = stored(gold(spark, sf_dir), shared_path(spark, "gold")) if g is None else g
    idx, stats, gavg = _train_lookups(spark, sf_dir, g) if lookups is None else lookups
    own_out = lambda base: _own_out(spark, sf_dir, base, g)
    return stored(feature_frame(g, idx, stats, gavg.scalar(), scorer=own_out), shared_path(spark, "features"))


@register("train_test_split")
def q_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.model import split_flag

    return silver(spark, sf_dir, "title_ratings").select("tconst", split_flag("tconst").alias("is_test"))


@register("regression_metrics")
def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a supplied predictor on the held-out part: the title's
    actor score over the training titles (a baseline the SQL oracle can
    compute too)."""
    from titleflow.operators.model import regression_metrics, split_flag

    from titleflow.operators.features import role_scores

    g = gold(spark, sf_dir).select("tconst", "actors", "directors", "writers", "averageRating")
    idx, stats, gavg = _train_lookups(spark, sf_dir, g)
    titles = g.where(split_flag("tconst"))
    feats = role_scores(titles, idx, stats, gavg.scalar())
    pred = feats.select("averageRating", F.col("actor_score_mean").alias("prediction"))
    return _r6(regression_metrics(pred), "rmse", "mae", "r2")


@register("svd_text")
def q_svd_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of the projected rows: their width, which are zero
    (plots without a vocabulary term), their first component (by power
    iteration there), and that none is longer than its TF-IDF row, which has
    length one."""
    from pyspark.ml.functions import vector_to_array

    from titleflow.operators import text as Tx

    plots = silver(spark, sf_dir, "title_plots")
    tm = Tx.fit_text_features(plots)
    vecs = tm.transform(plots).select("tconst", "tfidf").checkpoint(eager=True)
    done = Tx.svd_project(vecs, Tx.fit_svd(vecs)).select("tconst", vector_to_array("svd").alias("svd"))
    norm = F.sqrt(F.aggregate("svd", F.lit(0.0), lambda acc, x: acc + x * x))
    # Four decimals: the randomised passes agree with the limit to about nine.
    first = F.floor(F.coalesce(F.abs(F.get("svd", F.lit(0))), F.lit(0.0)) * 1e4 + OFF_TIES) / 1e4
    return done.select(
        "tconst", F.size("svd").alias("width"), (norm > 0).alias("has_terms"), first.alias("first_component"), (norm <= 1 + 1e-9).alias("within_norm")
    )


@register("train_features")
def q_train_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled vectors taken apart: numeric features, genre bits and
    the whole width (with the text part)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    from titleflow.operators.features import NUMERIC_COLS, SCORE_COLS
    from titleflow.operators.model import TrainConfig, _prep_stages, train_test_split

    feats = _features(spark, sf_dir)
    train, _ = train_test_split(feats)
    stages = _prep_stages(train, TrainConfig())
    n, n_genres = len(NUMERIC_COLS), len(stages[0].vocabulary)
    made = PipelineModel(stages=stages).transform(feats).select("tconst", vector_to_array("features").alias("v"), "averageRating")
    numbers = [F.col("v")[i].alias(c) for i, c in enumerate(NUMERIC_COLS)]
    bits = F.array_join(F.slice("v", n + 1, n_genres).cast("array<int>"), "|").alias("genre_vector")
    scored = _r6(made.select("tconst", *numbers, bits, F.size("v").alias("width"), "averageRating"), *SCORE_COLS, offset=OFF_TIES)
    return _r6(scored, "numVotes_log1p", "startYear_z")


@register("score_titles")
def q_score_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out titles, and whether each one's prediction lies in the
    range of the training labels (a forest's mean cannot leave it)."""
    from titleflow.operators.model import fit_model, predict, train_test_split

    train, test = train_test_split(_features(spark, sf_dir))
    model = fit_model(train)
    low, high = train.agg(F.min("averageRating"), F.max("averageRating")).first()
    done = predict(model, test, keep=("tconst", "averageRating"))
    return done.select("tconst", "averageRating", F.col("prediction").between(low, high).alias("in_label_range"))


@register("forest_tree")
def q_forest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of three levels over counts and the year, without bagging:
    grown by histograms at the top, in a task below, and applied to every title."""
    from pyspark.ml.functions import array_to_vector

    from titleflow.operators.forest import ForestConfig, fit_forest
    from titleflow.operators.model import labelled

    sizes = [F.coalesce(F.size(c), F.lit(0)) for c in ("actors", "directors", "writers")]
    n_genres = F.size(F.split(F.coalesce("genres", F.lit("")), ","))
    inputs = [F.greatest(x, F.lit(0)).cast("double") for x in (F.coalesce("year", F.lit(0)), *sizes, n_genres)]
    rows = gold(spark, sf_dir).select("tconst", "averageRating", array_to_vector(F.array(*inputs)).alias("features")).checkpoint(eager=True)
    cfg = ForestConfig(num_trees=1, max_depth=3, local_rows=200, bagging=False)
    model = fit_forest(labelled(rows), "features", "averageRating", "tconst", cfg)
    return model.transform(rows).select("tconst", "prediction")


# ------------------------------------------------------------------ scenarios
def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.plans.fixtures import scoring_requests

    return scoring_requests(gold(spark, sf_dir))


@register("validate_requests")
def q_validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.scenario import validate_requests

    return validate_requests(_requests(spark, sf_dir))


@register("combinations")
def q_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titleflow.operators.scenario import combinations

    return combinations(_requests(spark, sf_dir))


@register("topk_per_request")
def q_topk_per_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k per request over a supplied score: the mean of the three
    people's role scores (SQL-computable), six decimals."""
    from titleflow.operators.scenario import scored_combinations, top_k

    idx, stats, gavg = _lookups(spark, sf_dir)
    combos = scored_combinations(_requests(spark, sf_dir), idx, stats, gavg.scalar(), carry=("top_k",))
    mean3 = (F.col("actor_score_mean") + F.col("director_score_mean") + F.col("writer_score_mean")) / F.lit(3.0)
    scored = _r6(combos.withColumn("score", mean3), "score")
    return top_k(scored, "score")


@register("displayed_predictions")
def q_displayed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-k results nested per request, and back to rows for display."""
    from titleflow.operators.scenario import nest_predictions, unnest_predictions

    best = q_topk_per_request(spark, sf_dir)
    return unnest_predictions(nest_predictions(_requests(spark, sf_dir), best), digits=2)


@register("scenario_scoring")
def q_scenario_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request: how many predictions, whether their scores fall, and
    whether each label is made of the request's own people."""
    from titleflow.operators.model import fit_model, train_test_split
    from titleflow.operators.scenario import LABEL_SEP, score_requests

    from titleflow.plans.fixtures import scoring_requests
    from titleflow.session import shared_path, stored

    g = stored(gold(spark, sf_dir), shared_path(spark, "gold"))
    idx, stats, gavg = _train_lookups(spark, sf_dir, g)
    stats = stored(stats, shared_path(spark, "stats"))
    train, _ = train_test_split(_features(spark, sf_dir, g, (idx, stats, gavg)))
    model = fit_model(train)
    requests = scoring_requests(g)
    done = score_requests(model, requests, idx, stats, gavg.scalar()).join(requests.select("request_id", "actors", "directors", "writers"), "request_id")
    ranks = F.sequence(F.lit(1), F.size("predictions") - 1)
    p = lambda i: F.element_at("predictions", i)["score"]
    falling = (F.size("predictions") < 2) | F.forall(ranks, lambda i: p(i) >= p(i + 1))
    who = lambda x, i: F.split(x["combination"], "\\Q" + LABEL_SEP + "\\E", -1)[i]
    known = F.forall(
        "predictions", lambda x: F.array_contains("actors", who(x, 0)) & F.array_contains("directors", who(x, 1)) & F.array_contains("writers", who(x, 2))
    )
    return done.select("request_id", F.size("predictions").alias("n_predictions"), falling.alias("falling"), known.alias("labels_known"))


# ------------------------------------------------------------------ sources and sinks
LOAD_DATE = "2024-01-01"


@register("tsv_roundtrip")
def q_tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land bronze title basics as gzip TSV, read them back as text."""
    from titleflow.plans.domain import bronze
    from titleflow.session import shared_path
    from titleflow.sources.landing import read_landing, write_landing

    root = shared_path(spark, "landing")
    write_landing(bronze(spark, sf_dir, "title_basics"), root, "title.basics", LOAD_DATE)
    return read_landing(spark, root, "title.basics")


@register("latest_partition")
def q_latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land ratings under one load date per year, read only the newest."""
    from titleflow.plans.fixtures import ratings_by_load_year
    from titleflow.session import shared_path
    from titleflow.sources.landing import read_landing, write_landing

    root = shared_path(spark, "landing")
    write_landing(ratings_by_load_year(spark, sf_dir), root, "title.ratings")
    return read_landing(spark, root, "title.ratings")


@register("flat_landing")
def q_flat_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts in the flat ``<date>/<name>.tsv`` layout; the newest date is read."""
    from titleflow.plans.domain import bronze
    from titleflow.session import shared_path
    from titleflow.sources.landing import read_landing, write_tsv

    root, basics = shared_path(spark, "landing"), bronze(spark, sf_dir, "title_basics")
    write_tsv(basics.where(F.col("genres").isNull()), f"{root}/2024-01-01/title.basics.tsv")
    write_tsv(basics, f"{root}/2024-02-01/title.basics.tsv")
    return read_landing(spark, root, "title.basics")


@register("split_landing")
def q_split_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat extract re-landed as files of bounded size, then read from those."""
    from titleflow.plans.domain import bronze
    from titleflow.session import shared_path
    from titleflow.sources.landing import read_landing, split_landing, write_tsv

    root, out = shared_path(spark, "landing"), shared_path(spark, "landing-split")
    write_tsv(bronze(spark, sf_dir, "title_basics"), f"{root}/{LOAD_DATE}/title.basics.tsv")
    split_landing(spark, root, "title.basics", out)
    return read_landing(spark, out, "title.basics")


@register("load_report")
def q_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to bronze where one extract is empty and one is missing: the rest
    load, stamped with the load time; one row per extract."""
    import datetime as dt

    from titleflow.plans.domain import bronze
    from titleflow.plans.fixtures import EXTRACTS
    from titleflow.plans.medallion import landing_to_bronze
    from titleflow.session import shared_path
    from titleflow.sources.buckets import read_buckets
    from titleflow.sources.landing import write_landing

    root = shared_path(spark, "report")
    stamp = dt.datetime(2024, 1, 1, 12)
    wanted = {landed: EXTRACTS[landed] for landed in ("title.ratings", "title.crew", "title.episode", "name.basics")}
    for landed in ("title.ratings", "title.episode", "name.basics"):
        df = bronze(spark, sf_dir, wanted[landed])
        write_landing(df.limit(0) if landed == "title.episode" else df, f"{root}/landing", landed, LOAD_DATE)
    report = landing_to_bronze(spark, f"{root}/landing", f"{root}/bronze", wanted, load_time=stamp)
    loaded = None
    for landed in ("title.ratings", "name.basics"):
        rows = read_buckets(spark, f"{root}/bronze/{wanted[landed]}").where(F.col("_processing_time") == F.lit(stamp))
        own = rows.agg(F.count(F.lit(1)).alias("stamped")).select(F.lit(landed).alias("table"), "stamped")
        loaded = own if loaded is None else loaded.unionByName(own)
    empty = F.col("detail") == "empty extract, skipped"
    return report.join(loaded, "table", "left").select("table", "status", empty.alias("empty"), "stamped")


@register("derive_table_name")
def q_derive_table_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all seven extracts, scan them in one read and count rows per
    table name derived from each file's path."""
    from titleflow.plans.domain import bronze
    from titleflow.plans.fixtures import EXTRACTS
    from titleflow.session import shared_path
    from titleflow.sources.landing import read_tsv, table_name, write_landing_many

    root = shared_path(spark, "landing")
    write_landing_many({landed: bronze(spark, sf_dir, tbl) for landed, tbl in EXTRACTS.items()}, root, LOAD_DATE)
    files = read_tsv(spark, root, recursiveFileLookup="true")
    # The name is a property of the file: count per file first, then name
    # the (few) files, instead of running the path regexes on every row.
    per_file = files.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(table_name(F.col("path")).alias("table_name")).agg(F.sum("n").alias("row_count"))


@register("export_json")
def q_export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the gold table as JSON lines and read it back typed."""
    from titleflow.session import shared_path
    from titleflow.sources.tables import export_json, read_json

    g = gold(spark, sf_dir)
    path = shared_path(spark, "export", "prediction_input")
    export_json(g, path)
    return _render(read_json(spark, path, g.schema), "directors", "writers", "actors")


@register("export_json_array")
def q_export_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the gold table as JSON array documents and read them back typed."""
    from titleflow.session import shared_path
    from titleflow.sources.tables import export_json_array, read_json_array

    g = gold(spark, sf_dir)
    path = shared_path(spark, "export", "prediction_input_array")
    export_json_array(g, path)
    return _render(read_json_array(spark, path, g.schema), "directors", "writers", "actors")


@register("landing_stream_ingest")
def q_landing_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rating extracts land; one streaming ingest (availableNow) merges
    them into bronze on tconst, oldest load date first."""
    from titleflow.plans.fixtures import ratings_load
    from titleflow.session import shared_path
    from titleflow.sources.landing import landing_path, write_landing
    from titleflow.streaming.ingest import ingest_available, latest_rows, string_schema

    root = shared_path(spark, "stream")
    landing, bronze_root, ckpt = f"{root}/landing", f"{root}/bronze/title_ratings", f"{root}/_checkpoints/title_ratings"
    schema = string_schema(["tconst", "averageRating", "numVotes"])
    for load, day in ((1, "2024-01-01"), (2, "2024-01-02")):
        write_landing(ratings_load(spark, sf_dir, load), landing, "title.ratings", day)
    ingest_available(spark, landing_path(landing, "title.ratings"), schema, bronze_root, ckpt, ["tconst"])
    return latest_rows(spark, bronze_root).drop("_processing_time")
