"""Every registered query that has an SQL form, against DuckDB, on the
smallest scale factor (values and column types)."""

import math

import pytest

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v  # values compare exactly, as the driver's hash does


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _sql_keys():
    import __spark_entry__ as E

    return sorted(E.oracle_sql())


@pytest.mark.parametrize("name", _sql_keys())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in res.description}
    for c, t in df.dtypes:
        assert TYPES.get(t, t) == dtypes[c], (c, t, dtypes[c])
    idx = [dcols.index(c) for c in df.columns]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    srows = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=_key)
    assert srows == drows
