from titleflow.sources.landing import landing_path, with_load_time, write_landing
from titleflow.sources.tables import create_or_merge, read_table
from titleflow.streaming.ingest import ingest_available, latest_rows, string_schema

SCHEMA = "tconst string, averageRating string, numVotes string"


def test_stream_ingest_merges_each_load_once(spark, scratch):
    land, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    schema = string_schema(["tconst", "averageRating", "numVotes"])
    src = landing_path(land, "title.ratings")
    write_landing(spark.createDataFrame([("tt1", "7.0", "10"), ("tt2", "6.0", "5")], SCHEMA), land, "title.ratings", "2024-01-01")
    v1 = ingest_available(spark, src, schema, bronze, ckpt, ["tconst"])
    # A restart with nothing new changes nothing.
    assert ingest_available(spark, src, schema, bronze, ckpt, ["tconst"]) == v1
    write_landing(spark.createDataFrame([("tt2", "6.5", "6"), ("tt3", "5.0", "1")], SCHEMA), land, "title.ratings", "2024-01-02")
    ingest_available(spark, src, schema, bronze, ckpt, ["tconst"])
    got = {r.tconst: (r.averageRating, r.numVotes) for r in latest_rows(spark, bronze).collect()}
    assert got == {"tt1": ("7.0", "10"), "tt2": ("6.5", "6"), "tt3": ("5.0", "1")}
    assert "_processing_time" in latest_rows(spark, bronze).columns


def test_two_dates_in_one_run_and_a_new_checkpoint(spark, scratch):
    land, bronze = f"{scratch}/landing", f"{scratch}/bronze"
    schema = string_schema(["tconst", "averageRating", "numVotes"])
    src = landing_path(land, "title.ratings")
    # The later date lands first.
    write_landing(spark.createDataFrame([("tt1", "8.0", "2")], SCHEMA), land, "title.ratings", "2024-01-02")
    write_landing(spark.createDataFrame([("tt1", "7.0", "1"), ("tt2", "6.0", "5")], SCHEMA), land, "title.ratings", "2024-01-01")
    create_or_merge(spark, with_load_time(spark.createDataFrame([("tt0", "1.0", "1")], SCHEMA)), bronze, ["tconst"])
    create_or_merge(spark, with_load_time(spark.createDataFrame([("tt9", "1.0", "1")], SCHEMA)), bronze, ["tconst"])
    want = {"tt0": "1.0", "tt9": "1.0", "tt1": "8.0", "tt2": "6.0"}
    for ckpt in ("c1", "c1", "c2"):  # the third run starts over on the existing table
        ingest_available(spark, src, schema, bronze, f"{scratch}/{ckpt}", ["tconst"])
        rows = latest_rows(spark, bronze).collect()
        assert {r.tconst: r.averageRating for r in rows} == want and len(rows) == 4
    assert read_table(spark, bronze, 0).count() == 1  # history stays


def test_rerun_batch_is_exactly_once(spark, scratch):
    """Re-running a batch (as after a crash before the stream commits it)
    changes nothing: NULL-key rows are not inserted twice."""
    root = f"{scratch}/t"
    b0 = spark.createDataFrame([("a", "1"), (None, "x")], "k string, v string")
    b1 = spark.createDataFrame([("a", "2"), (None, "y")], "k string, v string")
    create_or_merge(spark, b0, root, ["k"], token="q-0")
    create_or_merge(spark, b1, root, ["k"], token="q-1")
    key = lambda t: (t[0] is None, t[0] or "", t[1])
    first = sorted((tuple(r) for r in read_table(spark, root).collect()), key=key)
    create_or_merge(spark, b1, root, ["k"], token="q-1")  # the same batch again
    again = sorted((tuple(r) for r in read_table(spark, root).collect()), key=key)
    assert first == again
    assert len([r for r in again if r[0] is None]) == 2
