"""The stored-layer jobs end to end on the smallest scale factor:
landing -> bronze -> silver -> gold -> model -> scores."""

import pytest
from pyspark.sql import functions as F

from titleflow.operators import features as Fe
from titleflow.operators.model import TrainConfig, split_flag
from titleflow.operators.scenario import validate_requests
from titleflow.plans.domain import bronze, silver
from titleflow.plans.fixtures import EXTRACTS, scoring_requests
from titleflow.plans.medallion import bronze_to_silver, gold_to_model, landing_to_bronze, ratings_to_plots, score_batch, silver_to_gold
from titleflow.sources.landing import write_landing_many

SF = "/root/testdata/sf0.001"


def test_layers_end_to_end(spark, scratch):
    land, br, sv = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/silver"
    write_landing_many({landed: bronze(spark, SF, t) for landed, t in EXTRACTS.items()}, land, "2024-01-01")
    rep = {r.table: r.status for r in landing_to_bronze(spark, land, br).collect()}
    assert set(rep.values()) == {"ok"}, rep
    rep = {r.table: r.status for r in bronze_to_silver(spark, br, sv).collect()}
    assert set(rep.values()) == {"ok"}, rep
    # silver from the stored layers equals silver computed directly
    direct = sorted(tuple(r) for r in silver(spark, SF, "title_ratings").collect())
    stored = sorted(tuple(r) for r in spark.read.parquet(f"{sv}/title_ratings").drop("_processing_time").collect())
    assert stored == direct
    silver_to_gold(spark, sv, f"{scratch}/gold", silver(spark, SF, "title_plots"))
    gold = spark.read.parquet(f"{scratch}/gold")
    metrics = gold_to_model(spark, gold, sv, f"{scratch}/model", TrainConfig(num_trees=5, max_depth=4, svd_k=4)).collect()[0]
    assert metrics.n > 0 and metrics.rmse is not None
    requests = scoring_requests(gold)
    valid = validate_requests(requests).where("is_valid").count()
    assert 0 < valid
    scored = score_batch(spark, f"{scratch}/model", requests.drop("top_k")).collect()
    assert len(scored) == valid
    assert any(len(r.predictions) > 0 for r in scored) and all(len(r.predictions) <= 10 for r in scored)
    with pytest.raises(FileNotFoundError, match="person_stats"):
        score_batch(spark, f"{scratch}/no_model", requests)


def test_held_out_ratings_reach_no_feature(spark, scratch):
    """The lookups stored with a model are the same whatever the held-out titles are rated."""
    tables = {t: silver(spark, SF, t) for t in ("title_principals", "title_crew", "title_ratings", "name_basics")}
    gold = silver(spark, SF, "title_ratings").select("tconst")
    train = gold.where(~split_flag("tconst"))
    r = tables["title_ratings"]
    other = r.withColumn("averageRating", F.when(split_flag("tconst"), F.lit(1.0)).otherwise(F.col("averageRating")))
    for make in (lambda x: Fe.person_stats(tables["title_principals"], tables["title_crew"], x, titles=train), lambda x: Fe.global_avg(x, titles=train)):
        assert sorted(map(tuple, make(r).collect())) == sorted(map(tuple, make(other).collect()))


def test_ratings_to_plots(spark, scratch):
    ratings = [(f"tt{i}", 3.0 + i % 7, 2000) for i in range(70)]
    spark.createDataFrame(ratings, "tconst string, averageRating double, numVotes int").write.parquet(f"{scratch}/s/title_ratings")

    def fetch(sample):
        reply = F.when(F.col("averageRating") > 8, '{"Response": "False"}').otherwise('{"Response": "True", "Title": "T", "Year": "2001", "Plot": "p"}')
        return sample.select("tconst", reply.alias("body"))

    row = ratings_to_plots(spark, f"{scratch}/s", fetch, total=40).collect()[0]
    sample = spark.read.parquet(f"{scratch}/s/title_sample")
    assert {r[0]: r[1] for r in sample.groupBy("rating_group").count().collect()} == {"low": 8, "medium_low": 12, "medium_high": 12, "high": 8}
    assert (row.total, row.with_plot) == (40, 32)
    assert spark.read.parquet(f"{scratch}/s/title_plots").count() == 32


def test_tables_run_side_by_side_and_failures_stay_apart(spark):
    """Each of two steps waits for the other inside its own scheduler pool; a third fails."""
    import threading

    from titleflow.plans.medallion import run_each

    met = threading.Barrier(2, timeout=60)

    def step(table):
        if table == "bad":
            raise ValueError("broken extract")
        met.wait()
        spark.range(10).count()
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    report = [tuple(r) for r in run_each(spark, ["a", "bad", "b"], step).collect()]
    assert report == [("a", "ok", "a"), ("bad", "failed", "ValueError: broken extract"), ("b", "ok", "b")]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
