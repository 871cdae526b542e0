import pytest

from titleflow.operators.upsert import DUPLICATE_KEY, merge_frames
from titleflow.sources.tables import create_or_merge, read_table, versions

SCHEMA = "k string, v int"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0] is None, t))


def test_merge_cases(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("d", 4), ("d", 5)], SCHEMA)
    source = spark.createDataFrame([("a", 10), ("c", 30), (None, 99), ("d", 40)], SCHEMA)
    got = _rows(merge_frames(target, source, ["k"]))
    assert got == sorted(
        [("a", 10), ("b", 2), ("c", 30), ("d", 40), ("d", 40), (None, 3), (None, 99)], key=lambda t: (t[0] is None, t)
    )


def test_repeated_source_key_raises(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    source = spark.createDataFrame([("a", 2), ("a", 3)], SCHEMA)
    with pytest.raises(Exception, match=DUPLICATE_KEY):
        merge_frames(target, source, ["k"]).collect()


def test_repeated_unmatched_source_keys_are_inserted(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    source = spark.createDataFrame([("z", 2), ("z", 3)], SCHEMA)
    assert _rows(merge_frames(target, source, ["k"])) == [("a", 1), ("z", 2), ("z", 3)]


def test_idempotent_and_key_union(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    source = spark.createDataFrame([("b", 20), ("c", 3)], SCHEMA)
    once = merge_frames(target, source, ["k"])
    twice = merge_frames(once, source, ["k"])
    assert _rows(once) == _rows(twice)
    assert {r.k for r in once.collect()} == {"a", "b", "c"}


def test_repeated_lineitem_keys_raise(spark):
    from titleflow.plans.fixtures import bronze_title_principals

    p = bronze_title_principals(spark, "/root/testdata/sf0.001")
    with pytest.raises(Exception, match=DUPLICATE_KEY):
        merge_frames(p, p, ["tconst", "ordering"]).collect()


def test_snapshots(spark, scratch):
    root = f"{scratch}/t"
    assert versions(spark, root) == []
    assert create_or_merge(spark, spark.createDataFrame([("a", 1)], SCHEMA), root) == 0
    assert create_or_merge(spark, spark.createDataFrame([("a", 2), ("b", 3)], SCHEMA), root) == 1
    assert _rows(read_table(spark, root)) == [("a", 2), ("b", 3)]
    assert _rows(read_table(spark, root, 0)) == [("a", 1)]
    assert create_or_merge(spark, spark.createDataFrame([], SCHEMA), root) == 1


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
_row_lists = st.lists(st.tuples(_keys, st.integers(0, 9)), max_size=8)


def _model(target, source):
    """MERGE by hand: each target row takes the (unique) matching source
    row's values; unmatched source rows are appended."""
    src = {}
    for k, v in source:
        if k is not None:
            src.setdefault(k, []).append((k, v))
    tkeys = {k for k, _ in target if k is not None}
    if any(len(v) > 1 and k in tkeys for k, v in src.items()):
        return None
    out = [src[k][0] if k in src else (k, v) for k, v in target]
    out += [(k, v) for k, v in source if k is None or k not in tkeys]
    return sorted(out, key=lambda t: (t[0] is None, t))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_row_lists, _row_lists)
def test_merge_matches_model(spark, target, source):
    expect = _model(target, source)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    if expect is None:
        with pytest.raises(Exception, match=DUPLICATE_KEY):
            merge_frames(t, s, ["k"]).collect()
    else:
        assert _rows(merge_frames(t, s, ["k"])) == expect


def test_store_on_a_scheme_of_its_own(spark, scratch):
    """Existing snapshots are found whatever the path looks like."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tf.link./store", f"file://{scratch}")
    root = "viewfs://tf/store/t"
    assert create_or_merge(spark, spark.createDataFrame([("a", 1)], SCHEMA), root) == 0
    assert create_or_merge(spark, spark.createDataFrame([("b", 2)], SCHEMA), root) == 1
    assert versions(spark, root) == versions(spark, f"{scratch}/t") == [0, 1]
    assert _rows(read_table(spark, root)) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="dbfs"):
        versions(spark, "dbfs:/x/y")  # a scheme this session cannot read is an error, not an empty table


def test_uncommitted_snapshot_is_invisible(spark, scratch):
    root = f"{scratch}/t"
    create_or_merge(spark, spark.createDataFrame([("a", 1)], SCHEMA), root)
    spark.createDataFrame([("half", 0)], SCHEMA).write.parquet(f"{root}/tf_snapshot=1")  # a writer that died
    assert versions(spark, root) == [0]
    assert create_or_merge(spark, spark.createDataFrame([("b", 2)], SCHEMA), root) == 1
    assert _rows(read_table(spark, root)) == [("a", 1), ("b", 2)]


def test_new_column_joins_the_table(spark, scratch):
    root = f"{scratch}/t"
    create_or_merge(spark, spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA), root)
    create_or_merge(spark, spark.createDataFrame([("b", 3, "x")], SCHEMA + ", extra string"), root)
    assert _rows(read_table(spark, root)) == [("a", 1, None), ("b", 3, "x")]
