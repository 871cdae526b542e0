import math

from pyspark.sql import functions as F

from titleflow.operators import features as Fe


def test_zscore_cases(spark):
    one = spark.createDataFrame([("t1", 2000)], "tconst string, year int")
    assert Fe.year_zscore(one).collect()[0].startYear_z == 0.0  # one row: sigma NULL -> 1
    same = spark.createDataFrame([("t1", 2000), ("t2", 2000)], "tconst string, year int")
    assert [r.startYear_z for r in Fe.year_zscore(same).collect()] == [0.0, 0.0]
    mixed = spark.createDataFrame([("t1", 1990), ("t2", 2010), ("t3", None)], "tconst string, year int")
    z = {r.tconst: r.startYear_z for r in Fe.year_zscore(mixed).collect()}
    assert z["t3"] is None and math.isclose(z["t1"], -10 / math.sqrt(200))
    empty = spark.createDataFrame([], "tconst string, year int")
    assert Fe.year_zscore(empty).count() == 0


def test_role_scores_cases(spark):
    base = spark.createDataFrame(
        [
            ("t1", None, ["D1"], ["W1"]),  # NULL actor list
            ("t2", [], [], []),  # empty lists
            ("t3", ["Nobody"], ["D1"], ["W1"]),  # unknown name
            ("t4", ["Same"], ["D1"], ["W1"]),  # homonyms
            ("t5", ["D1"], ["D1"], ["W1"]),  # known person, but not as an actor
        ],
        "tconst string, actors array<string>, directors array<string>, writers array<string>",
    )
    idx = spark.createDataFrame(
        [("D1", "n1"), ("W1", "n2"), ("Same", "n3"), ("Same", "n4")], "name string, nconst string"
    )
    stats = spark.createDataFrame(
        [("n1", "director", 6.0), ("n2", "writer", 8.0), ("n3", "actor", 5.0), ("n4", "actor", 9.0)],
        "nconst string, role string, score_role double",
    )
    out = {r.tconst: r for r in Fe.role_scores(base, idx, stats, 7.0).collect()}
    assert out["t1"].actor_score_mean == 7.0 and out["t1"].director_score_mean == 6.0 and out["t1"].writer_score_max == 8.0
    assert all(out["t2"][c] == 7.0 for c in Fe.SCORE_COLS)
    assert out["t3"].actor_score_mean == 7.0
    assert out["t4"].actor_score_mean == 7.0 and out["t4"].actor_score_max == 9.0
    assert out["t5"].actor_score_mean == 7.0 and out["t5"].director_score_mean == 6.0


def test_person_stats_counts_titles_once(spark):
    pr = spark.createDataFrame(
        [("t1", 1, "n1", "actor"), ("t1", 2, "n1", "actress"), ("t2", 1, "n1", "actor")],
        "tconst string, ordering int, nconst string, category string",
    )
    crew = spark.createDataFrame([("t1", "n2", "\\N")], "tconst string, directors string, writers string")
    ratings = spark.createDataFrame([("t1", 4.0), ("t2", 8.0)], "tconst string, averageRating double")
    got = {(r.nconst, r.role): r.score_role for r in Fe.person_stats(pr, crew, ratings).collect()}
    assert got == {("n1", "actor"): 6.0, ("n2", "director"): 4.0}


def test_normalize_and_multihot(spark):
    df = spark.createDataFrame([("t1", "Drama, Comedy"), ("t2", None), ("t3", "\\N"), ("t4", " ,Drama")], "tconst string, genres string")
    n = Fe.normalize_list(df, "genres")
    got = {r.tconst: r.genres for r in n.collect()}
    assert got == {"t1": ["Drama", "Comedy"], "t2": [], "t3": [], "t4": ["Drama"]}
    assert Fe.genre_vocabulary(n) == ["Comedy", "Drama"]
    mh = {r.tconst: r.v for r in Fe.genre_multihot(n).select("tconst", Fe.multihot_text("genres_vec").alias("v")).collect()}
    assert mh == {"t1": "1|1", "t2": "0|0", "t3": "0|0", "t4": "0|1"}
    arr = spark.createDataFrame([("t1", ["A", " ", "B "])], "tconst string, genres array<string>")
    assert Fe.normalize_list(arr, "genres").collect()[0].genres == ["A", "B"]


def test_own_rating_never_enters_own_features(spark):
    """Changing a training title's rating leaves its own features as they are, and changes others'."""
    pr = spark.createDataFrame(
        [("t1", 1, "n1", "actor"), ("t2", 1, "n1", "actor"), ("t3", 1, "n1", "actress"), ("t1", 2, "n2", "actor"), ("t4", 1, "n2", "actor")],
        "tconst string, ordering int, nconst string, category string",
    )
    crew = spark.createDataFrame([("t1", "n3", "n4"), ("t2", "n3", "\\N")], "tconst string, directors string, writers string")
    idx = spark.createDataFrame([("A", "n1"), ("A", "n2"), ("D", "n3"), ("W", "n4")], "name string, nconst string")
    base = spark.createDataFrame(
        [("t1", ["A"], ["D"], ["W"]), ("t2", ["A"], ["D"], []), ("t9", ["A"], None, ["W"])],
        "tconst string, actors array<string>, directors array<string>, writers array<string>",
    )
    train = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "tconst string")

    def scores(t1):
        ratings = spark.createDataFrame([("t1", t1), ("t2", 6.0), ("t3", 7.0), ("t4", 1.0)], "tconst string, averageRating double")
        return {r.tconst: r for r in Fe.own_out_scores(base, idx, pr, crew, ratings, train).collect()}

    low, high = scores(2.0), scores(10.0)
    assert low["t1"] == high["t1"] and low["t2"] != high["t2"] and low["t9"] != high["t9"]
    # n1's other titles: 6 and 7; n2 and the writer have no other training title, so the writer is filled by the others' mean.
    assert low["t1"].actor_score_mean == 6.5 == low["t1"].actor_score_max
    assert low["t1"].director_score_mean == 6.0 and low["t1"].writer_score_mean == 6.5
    # t9 is no training title: nothing is left out.
    assert low["t9"].actor_score_max == 5.0 and low["t9"].writer_score_mean == 2.0 and low["t9"].director_score_mean == 5.0


def test_credits_get_more_tasks_than_the_session_names(spark, monkeypatch):
    from titleflow.operators import features as Fe

    principals = spark.createDataFrame(
        [(f"t{i % 40}" if i % 11 else None, str(i % 3), f"n{i % 7}", "actor" if i % 2 else "self") for i in range(300)], "tconst string, ordering string, nconst string, category string"
    )
    crew = spark.createDataFrame([(f"t{i}", f"n{i % 5},n1", "\\N" if i % 3 else "n2") for i in range(40)], "tconst string, directors string, writers string")
    ratings = spark.createDataFrame([(f"t{i % 38}", i / 10) for i in range(60)], "tconst string, averageRating double")
    plain = sorted(map(str, Fe.person_stats(principals, crew, ratings).collect()))
    monkeypatch.setattr(Fe, "TASK_CREDITS", 10)
    dealt = Fe.title_credits(principals, crew, ratings)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString() and "hashpartitioning(tconst" in dealt._jdf.queryExecution().toString()
    assert sorted(map(str, Fe.person_stats(principals, crew, ratings).collect())) == plain and plain
