import pytest
from pyspark.sql import types as T

#: Extra columns with names the operators use inside.
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("score", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("fp", T.StringType()),
        T.StructField("n_words", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text[, lang[, source]])"""
        full = []
        for r in rows:
            doc_id, text, lang, source = [*r, "en", "s"][:2] + ([*r[2:], *["en", "s"][len(r) - 2 :]])
            full.append((doc_id, text, lang, source, None, "x", "y", "z", "w"))
        return spark.createDataFrame(full, DOCS)

    return make


LONG = "long text of many words " * 8000
EDGE = [
    (1, "One line here\nanother line\nOne line here"),
    (2, None, None, None),
    (3, ""),
    (4, " \t\x0b\r\n\f\n  "),
    (None, "A text without an id é 日本 😀"),
    (5, "same text twice"),
    (5, "same text twice"),
    (6, LONG, "en", None),
    (7, "\n\n"),
]


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(EDGE)


@pytest.fixture(scope="session")
def none(make_docs):
    return make_docs([])
