import hashlib


from titleflow.functions.columns import rating_band
from titleflow.operators.sample import rating_histogram, stratified_sample


def test_bands(spark):
    vals = [4.0, 4.1, 6.0, 6.1, 8.0, 8.1, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "r double")
    got = [r[0] for r in df.select(rating_band("r")).collect()]
    assert got == ["low", "medium_low", "medium_low", "medium_high", "medium_high", "high", "high", "high"]


def test_histogram(spark):
    df = spark.createDataFrame([(1.5,), (1.9,), (7.0,)], "averageRating double")
    assert [tuple(r) for r in rating_histogram(df).collect()] == [(1, 2), (7, 1)]


def _brute(rows, quota, seed=42):
    out = set()
    for band in {b for _, b in rows}:
        members = sorted((hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k) for k, b in rows if b == band)
        out |= {k for _, k in members[: quota.get(band, 0)]}
    return out


def test_sample_matches_brute_force_and_is_partition_invariant(spark):
    rows = [(f"tt{i}", "a" if i % 3 else "b") for i in range(3000)]
    quota = {"a": 700, "b": 5000}  # band b is shorter than its quota: all of it, no top-up
    expect = _brute(rows, quota)
    base = spark.createDataFrame(rows, "tconst string, band string")
    for parts in (1, 2, 8):
        got = stratified_sample(base.repartition(parts), "tconst", "band", quota, bucket_digits=2)
        keys = [r.tconst for r in got.collect()]
        assert len(keys) == len(set(keys)) == 700 + 1000
        assert set(keys) == expect


def test_sample_edge_bucket_only_is_ranked(spark):
    df = spark.createDataFrame([(f"k{i}", "x") for i in range(500)], "tconst string, band string")
    plan = stratified_sample(df, "tconst", "band", {"x": 123})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
