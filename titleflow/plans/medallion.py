"""End-to-end jobs over stored layers: landing -> bronze -> silver -> gold.

Each layer is a directory of tables; bronze tables are bucketed by key
(:mod:`titleflow.sources.buckets`) so a load rewrites what it touches.  Every
multi-table job runs its tables side by side, isolates failures per table and
returns a small report DataFrame (one row per table) instead of printing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from titleflow.operators.assemble import assemble_gold
from titleflow.operators.clean import SPECS, apply_spec
from titleflow.operators.enrich import has_plot, observed_coverage, parse_replies
from titleflow.operators.sample import DEFAULT_TOTAL, sample_titles
from titleflow.plans.fixtures import EXTRACTS
from titleflow.sources.buckets import merge_buckets
from titleflow.sources.files import exists
from titleflow.sources.landing import latest_load_date, read_landing, with_load_time
from titleflow.sources.tables import read_table

# Upsert keys per table.  The source pipeline keyed every table on its first
# column, which is not unique for akas and principals.
KEYS = {
    "title_basics": ["tconst"],
    "title_akas": ["titleId", "ordering"],
    "title_crew": ["tconst"],
    "title_episode": ["tconst"],
    "title_principals": ["tconst", "ordering"],
    "title_ratings": ["tconst"],
    "name_basics": ["nconst"],
}

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("detail", T.StringType()),
    ]
)


def _report(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    # One row per table: a handful of rows, built on the driver.
    return spark.createDataFrame(rows, REPORT_SCHEMA)


PARALLEL = 4


def run_each(spark: SparkSession, tables: Iterable[str], step: Callable[[str], str], parallel: int = PARALLEL) -> DataFrame:
    """Run ``step(table)`` for every table, ``parallel`` at a time; a failure is
    recorded and the remaining tables still run.

    Each table's jobs are submitted from a thread of its own, in a scheduler
    pool named after it (local properties are inherited), so under
    ``spark.scheduler.mode=FAIR`` a small table does not wait for a large one.
    """
    tables = list(tables)

    def run(table: str) -> tuple[str, str, str]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        try:
            return table, "ok", step(table)
        except Exception as e:  # noqa: BLE001 - isolation is the point
            return table, "failed", f"{type(e).__name__}: {str(e)[:500]}"
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        # Each call gets a copy of the caller's local properties.
        waiting = [pool.submit(inheritable_thread_target(spark)(run), t) for t in tables]
        return _report(spark, [w.result() for w in waiting])


def landing_to_bronze(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    extracts: dict[str, str] = EXTRACTS,
    load_date: str | None = None,
    load_time: dt.datetime | None = None,
) -> DataFrame:
    """Load the latest landed extracts into bronze: create each table on
    first load, MERGE on its key afterwards; empty extracts are skipped."""
    day = load_date or latest_load_date(spark, landing_root)

    def step(landed: str) -> str:
        table = extracts[landed]
        df = read_landing(spark, landing_root, landed, day)
        done = merge_buckets(spark, with_load_time(df, load_time), f"{bronze_root}/{table}", KEYS.get(table))
        return f"{done.rows} rows written from {day}" if done.rows else "empty extract, skipped"

    return run_each(spark, extracts, step)


def bronze_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, tables: Iterable[str] = SPECS) -> DataFrame:
    """Clean every bronze table into silver (overwrite)."""

    def step(table: str) -> str:
        df = read_table(spark, f"{bronze_root}/{table}")
        if df is None:
            raise FileNotFoundError(f"no bronze table for {table}")
        apply_spec(df, SPECS[table]).write.mode("overwrite").parquet(f"{silver_root}/{table}")
        return "written"

    return run_each(spark, tables, step)


def ratings_to_plots(
    spark: SparkSession, silver_root: str, fetch: Callable[[DataFrame], DataFrame], total: int = DEFAULT_TOTAL
) -> DataFrame:
    """Draw the stratified sample of titles from silver ratings, have ``fetch``
    look them up -- (tconst, ...) in, (tconst, body) replies out -- and write
    the usable plots to ``<silver_root>/title_plots``.  Returns the coverage
    (one row), counted while the plots are written.  The replies are stored
    first, so nothing is fetched twice, and parsed once."""
    sample = sample_titles(spark.read.parquet(f"{silver_root}/title_ratings"), total=total)
    sample.write.mode("overwrite").parquet(f"{silver_root}/title_sample")
    sampled = spark.read.parquet(f"{silver_root}/title_sample")
    fetch(sampled).select("tconst", "body").write.mode("overwrite").parquet(f"{silver_root}/title_replies")
    replies = spark.read.parquet(f"{silver_root}/title_replies")
    parsed, counted = observed_coverage(parse_replies(replies))
    parsed.filter(has_plot()).write.mode("overwrite").parquet(f"{silver_root}/title_plots")
    return counted()


def silver_to_gold(spark: SparkSession, silver_root: str, gold_path: str, plots: DataFrame | None = None) -> None:
    """Assemble the prediction input from silver and the plots table (default: silver's own)."""
    s = lambda n: spark.read.parquet(f"{silver_root}/{n}")
    plots = s("title_plots") if plots is None else plots
    gold = assemble_gold(plots, s("title_basics"), s("title_ratings"), s("title_principals"), s("title_crew"), s("name_basics"))
    gold.write.mode("overwrite").parquet(gold_path)


LOOKUPS = ("person_stats", "name_index", "global_avg")


def lookup_path(model_path: str, name: str) -> str:
    return f"{model_path.rstrip('/')}_lookups/{name}"


def store_lookups(silver: Callable[[str], DataFrame], titles: DataFrame, model_path: str) -> None:
    """Store the person lookups of ``titles`` (the training part) beside a model."""
    from titleflow.operators import features as Fe

    made = {
        "person_stats": Fe.person_stats(silver("title_principals"), silver("title_crew"), silver("title_ratings"), titles=titles),
        "name_index": Fe.name_index(silver("name_basics")),
        "global_avg": Fe.global_avg(silver("title_ratings"), titles=titles),
    }
    for name, df in made.items():
        df.write.mode("overwrite").parquet(lookup_path(model_path, name))


def gold_to_model(
    spark: SparkSession,
    gold: DataFrame,
    silver_root: str,
    model_path: str,
    cfg=None,
) -> DataFrame:
    """Fit the rating model on the training part of ``gold``, save it, and
    return the held-out metrics (one row).

    The person lookups are built from the *training* titles only, so no
    held-out label reaches a feature; and a training title's own rating is
    left out of its own features.
    """
    from titleflow.operators import features as Fe
    from titleflow.operators.model import TrainConfig, feature_frame, fit_model, labelled, predict, regression_metrics, split_flag

    cfg = cfg or TrainConfig()
    s = lambda n: spark.read.parquet(f"{silver_root}/{n}")
    gold = gold.checkpoint(eager=True)
    train_keys = gold.filter(~split_flag("tconst")).select("tconst")
    store_lookups(s, train_keys, model_path)
    stats, names, fill = read_lookups(spark, model_path)
    own_out = lambda base: Fe.own_out_scores(base, names, s("title_principals"), s("title_crew"), s("title_ratings"), train_keys)
    feats = feature_frame(gold, names, stats, fill, scorer=own_out).checkpoint(eager=True)
    model = fit_model(feats.filter(~split_flag("tconst")), cfg)
    model.write().overwrite().save(model_path)
    held_out = labelled(feats.filter(split_flag("tconst")))
    return regression_metrics(predict(model, held_out, keep=("tconst", "averageRating")))


def read_lookups(spark: SparkSession, model_path: str):
    """(person stats, name index, mean rating) as stored with the model; each must be there."""
    missing = [n for n in LOOKUPS if not exists(spark, f"{lookup_path(model_path, n)}/_SUCCESS")]
    if missing:
        raise FileNotFoundError(f"model {model_path} lacks its lookups {missing}")
    stats, names, mean = (spark.read.parquet(lookup_path(model_path, n)) for n in LOOKUPS)
    return stats, names, mean.scalar()


def score_batch(spark: SparkSession, model_path: str, requests: DataFrame, max_k: int | None = None) -> DataFrame:
    """Score the valid requests of a batch with a saved model and the lookups
    stored with it: (request_id, predictions).  ``validate_requests`` tells
    why the others are left out."""
    from pyspark.ml import PipelineModel

    from titleflow.operators.scenario import score_requests, validate_requests

    stats, names, fill = read_lookups(spark, model_path)
    valid = validate_requests(requests).where("is_valid").select("request_id")
    model = PipelineModel.load(model_path)
    return score_requests(model, requests.join(valid, "request_id", "left_semi"), names, stats, fill, max_k=max_k)
