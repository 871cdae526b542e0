"""Bucketed tables: merges like MERGE, untouched files stay, one job for a first load."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from titleflow.operators.upsert import DUPLICATE_KEY, merge_frames
from titleflow.sources.buckets import BUCKET, Load, bucket_of, merge_buckets, read_buckets

SCHEMA = "k string, v int"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_a_one_key_load_rewrites_one_bucket(spark, scratch):
    root = f"{scratch}/t"
    rows = [(f"k{i}", i) for i in range(500)]
    assert merge_buckets(spark, spark.createDataFrame(rows, SCHEMA), root, ["k"], buckets=16) == Load(500, 16)
    before = _files(root)
    done = merge_buckets(spark, spark.createDataFrame([("k7", -7)], SCHEMA), root, ["k"])
    after = _files(root)
    gone, made = before.keys() - after.keys(), after.keys() - before.keys()
    bucket = spark.createDataFrame([("k7",)], "k string").select(bucket_of(["k"], 16)).first()[0]
    assert done.buckets == 1 and len(before) >= 16
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in gone | made} == {str(bucket)}
    assert all(after[f] == t for f, t in before.items() if f in after) and len(before.keys() & after.keys()) >= 15
    assert _rows(read_buckets(spark, root)) == _rows(spark.createDataFrame([(k, -7 if k == "k7" else v) for k, v in rows], SCHEMA))


def test_empty_loads_and_new_columns(spark, scratch):
    root = f"{scratch}/t"
    assert read_buckets(spark, root) is None
    assert merge_buckets(spark, spark.createDataFrame([], SCHEMA), root) == Load(0, 0)
    assert read_buckets(spark, root) is None
    merge_buckets(spark, spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA), root)
    assert merge_buckets(spark, spark.createDataFrame([], SCHEMA), root) == Load(0, 0)
    merge_buckets(spark, spark.createDataFrame([("b", 3, "x"), (None, 4, "y")], "k string, v int, w string"), root)
    assert _rows(read_buckets(spark, root)) == [("a", 1, None), ("b", 3, "x"), (None, 4, "y")]


def test_a_failed_load_changes_nothing(spark, scratch):
    root = f"{scratch}/t"
    merge_buckets(spark, spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA), root)
    before = _files(root)
    with pytest.raises(Exception, match=DUPLICATE_KEY):
        merge_buckets(spark, spark.createDataFrame([("a", 5), ("a", 6)], SCHEMA), root)
    assert _files(root) == before and _rows(read_buckets(spark, root)) == [("a", 1), ("b", 2)]


_row = st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_row, min_size=1, max_size=8), st.lists(_row, min_size=1, max_size=5, unique_by=lambda r: r[0]))
def test_equals_a_whole_merge(spark, target, source):
    import tempfile

    root = tempfile.mkdtemp(prefix="titleflow-test-")
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    merge_buckets(spark, t, root, buckets=3)
    merge_buckets(spark, s, root)
    assert _rows(read_buckets(spark, root)) == _rows(merge_frames(t, s, ["k"]))
