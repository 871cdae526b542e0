from titleflow.operators.enrich import PLOT_SCHEMA, coverage, parse_replies, title_plots


def test_replies(spark):
    bodies = {
        "k1": '{"Title": "Salt Road", "Year": "1987", "Plot": "Two carriers lose their way.", "Response": "True"}',
        "k2": '{"Title": "Dry Run", "Year": "1990-92", "Plot": "", "Response": "True", "Extra": 1}',
        "k3": '{"Plot": "N/A", "Title": "Blank", "Response": "True"}',
        "k4": '{"Plot": "Not to be used.", "Response": "False"}',
        "k5": '{"Plot": "broken off',
        "k6": None,
        "k7": '{"Plot": "No title given.", "Response": "True"}',
    }
    df = spark.createDataFrame(list(bodies.items()), "tconst string, body string")
    parsed = {r.tconst: (r.title, r.year, r.plot) for r in parse_replies(df).collect()}
    assert parsed == {
        "k1": ("Salt Road", 1987, "Two carriers lose their way."),
        "k2": ("Dry Run", None, ""),
        "k3": ("Blank", None, "N/A"),
        "k4": (None, None, None),
        "k5": (None, None, None),
        "k6": (None, None, None),
        "k7": (None, None, "No title given."),
    }
    assert sorted(r.tconst for r in title_plots(df).collect()) == ["k1", "k2", "k7"]
    c = coverage(parse_replies(df)).collect()[0]
    assert (c.total, c.with_plot) == (7, 3) and abs(c.pct_with_plot - 300 / 7) < 1e-9


def test_no_replies(spark):
    empty = spark.createDataFrame([], "tconst string, body string")
    out = title_plots(empty)
    assert out.count() == 0 and [f.name for f in out.schema] == [f.name for f in PLOT_SCHEMA]
    c = coverage(parse_replies(empty)).collect()[0]
    assert (c.total, c.with_plot, c.pct_with_plot) == (0, 0, None)
