"""Lookup-service replies -> plot rows, and enrichment coverage.

The source pipeline fetched one reply per sampled title from a web service
on the driver.  Here the replies are data (a table of raw JSON bodies, as a
fetch job or a landing folder would store them) and parsing is a projection
with a fixed schema, so it runs on the executors and never meets an empty
list or a schema-inference failure.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titleflow.functions.observed import observed

# Field names of the service's reply (fixed values).
REPLY_FIELDS = ("Response", "Title", "Year", "Plot")
MISSING_PLOT = "N/A"

REPLY_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in REPLY_FIELDS] + [T.StructField("_corrupt_record", T.StringType())]
)
PLOT_SCHEMA = T.StructType(
    [
        T.StructField("tconst", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("plot", T.StringType()),
    ]
)


def parse_replies(replies: DataFrame, key: str = "tconst", body: str = "body") -> DataFrame:
    """One row per reply: (tconst, title, year, plot).  A reply that is not
    ``Response: "True"`` or is malformed gives NULL title, year and plot."""
    j = F.from_json(F.col(body), REPLY_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = replies.select(F.col(key).alias("tconst"), j.alias("j"))
    ok = (F.col("j.Response") == "True") & F.col("j._corrupt_record").isNull()
    return parsed.select(
        "tconst",
        F.when(ok, F.col("j.Title")).alias("title"),
        F.when(ok, F.col("j.Year").try_cast("int")).alias("year"),
        F.when(ok, F.col("j.Plot")).alias("plot"),
    )


def has_plot(plot_col: str = "plot"):
    return F.col(plot_col).isNotNull() & (F.col(plot_col) != MISSING_PLOT)


def title_plots(replies: DataFrame, key: str = "tconst", body: str = "body") -> DataFrame:
    """The plots table: parsed replies that carry a usable plot."""
    return parse_replies(replies, key, body).filter(has_plot())


def observed_coverage(parsed: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``parsed``, and a function that gives its :func:`coverage` once a job
    has run over it: the counts ride in that job."""
    seen = Observation()
    watched = parsed.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(has_plot()).alias("with_plot"))

    def counted() -> DataFrame:
        total, with_plot = observed(seen, "total", "with_plot")
        row = (total, with_plot, with_plot * 100.0 / total if total else None)
        return parsed.sparkSession.createDataFrame([row], "total bigint, with_plot bigint, pct_with_plot double")

    return watched, counted


def coverage(parsed: DataFrame) -> DataFrame:
    """One row: replies, replies with a plot, and the percentage (NULL when
    there are no replies)."""
    return parsed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(has_plot()).alias("with_plot"),
    ).select(
        "total",
        "with_plot",
        F.try_divide(F.col("with_plot") * F.lit(100.0), F.col("total")).alias("pct_with_plot"),
    )
