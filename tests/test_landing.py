import os

import pytest
from pyspark.sql import functions as F

from titleflow.plans.medallion import bronze_to_silver, landing_to_bronze
from titleflow.sources.landing import (
    latest_load_date,
    read_landing,
    read_tsv,
    split_landing,
    table_name,
    write_landing,
)
from titleflow.sources.tables import read_table


def test_unclosed_quote_reads_three_fields(spark, scratch):
    path = os.path.join(scratch, "q.tsv")
    with open(path, "w") as f:
        f.write("tconst\tprimaryTitle\tgenres\n")
        f.write('tt1\t"Open quote\tDrama\n')
    row = read_tsv(spark, path).collect()[0]
    assert (row.tconst, row.primaryTitle, row.genres) == ("tt1", '"Open quote', "Drama")


def test_gzip_roundtrip_and_latest(spark, scratch):
    a = spark.createDataFrame([("tt1", "1"), ("tt2", "\\N")], "tconst string, v string")
    b = spark.createDataFrame([("tt3", "3")], "tconst string, v string")
    write_landing(a, scratch, "title.basics", "2024-01-01")
    write_landing(b, scratch, "title.basics", "2024-02-01")
    assert latest_load_date(spark, scratch) == "2024-02-01"
    assert [r.tconst for r in read_landing(spark, scratch, "title.basics").collect()] == ["tt3"]
    old = sorted(r.tconst for r in read_landing(spark, scratch, "title.basics", "2024-01-01").collect())
    assert old == ["tt1", "tt2"]
    assert any(f.endswith(".gz") for f in spark.read.text(f"{scratch}/title.basics.tsv").inputFiles())


def test_latest_read_prunes_partitions(spark, scratch):
    a = spark.createDataFrame([("tt1",)], "tconst string")
    write_landing(a, scratch, "x", "2024-01-01")
    write_landing(a, scratch, "x", "2024-03-01")
    files = read_landing(spark, scratch, "x").inputFiles()
    assert files and all("2024-03-01" in f for f in files)


def test_fields_round_trip_exactly(spark, scratch):
    values = [" lead", "trail ", "", None, '"', '""', 'a "b" c', "\\N", "N/A", "  ", "é日"]
    df = spark.createDataFrame([(str(i), v, "end") for i, v in enumerate(values)], "id string, v string, z string")
    write_landing(df, scratch, "x", "2024-01-01")
    got = {r.id: r.v for r in read_landing(spark, scratch, "x").collect()}
    assert got == {str(i): v for i, v in enumerate(values)}


@pytest.mark.parametrize("value", ["a\tb", "a\nb", "a\rb", "\u2400"])
def test_text_without_a_field_form_fails(spark, scratch, value):
    with pytest.raises(Exception, match="no TSV form"):
        write_landing(spark.createDataFrame([(value,)], "v string"), scratch, "x", "2024-01-01")


def test_each_day_has_its_own_header(spark, scratch):
    write_landing(spark.createDataFrame([("1", "x", "old")], "a string, b string, c string"), scratch, "x", "2024-01-01")
    write_landing(spark.createDataFrame([("w", "3")], "b string, a string"), scratch, "x", "2024-01-02")
    assert [r.asDict() for r in read_landing(spark, scratch, "x").collect()] == [{"b": "w", "a": "3"}]


def test_empty_extract_replaces_its_day(spark, scratch):
    df = spark.createDataFrame([("1",)], "a string")
    write_landing(df, scratch, "x", "2024-01-01")
    write_landing(df.limit(0), scratch, "x", "2024-01-01")
    assert read_landing(spark, scratch, "x").count() == 0


@pytest.mark.parametrize("ending", [".tsv", ".tsv.gz"])
def test_flat_layout(spark, scratch, ending):
    import gzip

    for day, v in (("2024-01-01", "old"), ("2024-01-02", "new")):
        os.makedirs(f"{scratch}/{day}")
        body = f"tconst\taverageRating\tnumVotes\ntt1\t{v}\t10\n".encode()
        with open(f"{scratch}/{day}/title.ratings{ending}", "wb") as f:
            f.write(gzip.compress(body) if ending.endswith("gz") else body)
        with open(f"{scratch}/{day}/notes.txt", "w") as f:
            f.write("stray")
    assert latest_load_date(spark, scratch) == "2024-01-02"
    df = read_landing(spark, scratch, "title.ratings")
    assert [r.averageRating for r in df.collect()] == ["new"]
    assert df.select(table_name()).first()[0] == "title_ratings"
    with pytest.raises(FileNotFoundError):
        read_landing(spark, scratch, "title.akas")


def test_table_name_from_path(spark):
    df = spark.createDataFrame(
        [("/l/2024/title.basics.tsv",), ("/l/title.principals.tsv.gz",), ("/l/name.basics.tsv/load_date=2024-01-01/part-0.csv.gz",)],
        "p string",
    )
    got = [r[0] for r in df.select(table_name(F.col("p"))).collect()]
    assert got == ["title_basics", "title_principals", "name_basics"]


def test_landing_to_bronze_to_silver(spark, scratch):
    land, bronze, silver = (os.path.join(scratch, x) for x in ("landing", "bronze", "silver"))
    r1 = spark.createDataFrame([("tt1", "7.5", "10"), ("tt2", "N/A", "x")], "tconst string, averageRating string, numVotes string")
    write_landing(r1, land, "title.ratings", "2024-01-01")
    rep = landing_to_bronze(spark, land, bronze, {"title.ratings": "title_ratings"})
    assert [r.status for r in rep.collect()] == ["ok"]
    r2 = spark.createDataFrame([("tt1", "8.0", "11"), ("tt3", "5.0", "3")], "tconst string, averageRating string, numVotes string")
    write_landing(r2, land, "title.ratings", "2024-01-02")
    landing_to_bronze(spark, land, bronze, {"title.ratings": "title_ratings"})
    got = {r.tconst: r.averageRating for r in read_table(spark, f"{bronze}/title_ratings").collect()}
    assert got == {"tt1": "8.0", "tt2": "N/A", "tt3": "5.0"}
    rep = bronze_to_silver(spark, bronze, silver, ["title_ratings", "title_basics"])
    status = {r.table: r.status for r in rep.collect()}
    assert status == {"title_ratings": "ok", "title_basics": "failed"}  # one failure does not stop the rest
    assert sorted(r.tconst for r in spark.read.parquet(f"{silver}/title_ratings").collect()) == ["tt1", "tt3"]


def test_catalog_publish_moves_with_snapshots(spark, scratch):
    from titleflow.sources.catalog import publish
    from titleflow.sources.tables import create_or_merge

    root = f"{scratch}/title_ratings"
    schema = "tconst string, averageRating string"
    create_or_merge(spark, spark.createDataFrame([("tt1", "7.0")], schema), root)
    publish(spark, "tf_bronze_test.title_ratings", root)
    assert [tuple(r) for r in spark.table("tf_bronze_test.title_ratings").collect()] == [("tt1", "7.0")]
    create_or_merge(spark, spark.createDataFrame([("tt1", "8.0"), ("tt2", "5.0")], schema), root)
    publish(spark, "tf_bronze_test.title_ratings", root)
    got = sorted(tuple(r) for r in spark.table("tf_bronze_test.title_ratings").collect())
    assert got == [("tt1", "8.0"), ("tt2", "5.0")]
    assert spark.catalog.tableExists("tf_bronze_test.title_ratings")


def test_silver_to_gold_job(spark, scratch):
    from titleflow.plans.domain import silver
    from titleflow.plans.medallion import silver_to_gold

    sf = "/root/testdata/sf0.001"
    for t in ("title_basics", "title_ratings", "title_principals", "title_crew", "name_basics"):
        silver(spark, sf, t).write.mode("overwrite").parquet(f"{scratch}/silver/{t}")
    silver_to_gold(spark, f"{scratch}/silver", f"{scratch}/gold", silver(spark, sf, "title_plots"))
    gold = spark.read.parquet(f"{scratch}/gold")
    assert gold.count() == silver(spark, sf, "title_plots").count()
    assert gold.columns == ["tconst", "title", "plot", "year", "genres", "averageRating", "directors", "writers", "actors"]


def test_one_gzip_file_is_split_once(spark, scratch):
    import gzip

    os.makedirs(f"{scratch}/2024-03-01")
    with gzip.open(f"{scratch}/2024-03-01/x.tsv.gz", "wt") as f:
        f.write("id\tv\n" + "".join(f"{i}\t{'' if i % 7 == 0 else i}\n" for i in range(1000)))
    assert read_landing(spark, scratch, "x").rdd.getNumPartitions() == 1
    split_landing(spark, scratch, "x", f"{scratch}/out", rows_per_file=100)
    again = read_landing(spark, f"{scratch}/out", "x")
    assert len(again.inputFiles()) == 10
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, read_landing(spark, scratch, "x").collect()))
    with pytest.raises(ValueError, match="onto itself"):
        split_landing(spark, f"{scratch}/out", "x", f"{scratch}/out")


def test_json_array_documents(spark, scratch):
    import glob
    import json

    from titleflow.sources.tables import export_json_array, read_json_array

    df = spark.createDataFrame([(1, 'a "q"\n\u00e9', ["x", None]), (2, None, None), (3, "", [])], "id int, t string, l array<string>")
    for single, frame in ((True, df), (False, df.repartition(2)), (True, df.where("id > 9"))):
        export_json_array(frame, f"{scratch}/array", single=single)
        parts = [json.load(open(p, encoding="utf-8")) for p in glob.glob(f"{scratch}/array/part-*")]
        assert not single or len(parts) == 1
        rows = sorted(map(tuple, (r.values() for part in parts for r in part)))
        assert rows == sorted((r.id, r.t, r.l) for r in frame.collect())
        assert sorted(read_json_array(spark, f"{scratch}/array", df.schema).collect()) == sorted(frame.collect())


def test_fields_are_checked_without_a_pattern(spark, scratch):
    """Every field is searched for the few characters it cannot hold; a pattern per field was slow."""
    from titleflow.sources import landing as La

    df = spark.createDataFrame([("a", "b\tc"), ("x", None)], "k string, v string")
    plan = La._encoded(df)._jdf.queryExecution().analyzed().toString()
    assert "RLIKE" not in plan.upper() and "Contains" in plan
    for bad in ("b\tc", "b\rc", "b\nc", La.EMPTY):
        rows = spark.createDataFrame([("a", bad)], "k string, v string")
        try:
            La.write_tsv(rows, f"{scratch}/{ord(bad[-1])}-{len(bad)}")
        except Exception as e:
            assert "has no TSV form" in str(e)
        else:
            raise AssertionError(bad)
