"""Quality rules with adaptive thresholds.

Fixed cutoffs are replaced by outlier fences that each (language, source)
group sets itself: two quantiles of every feature, ``low`` and ``high``, come
from a mergeable quantile sketch, and a document fails when a feature lies
beyond ``high + max(spread * (high - low), floor)`` (for word length also
below the mirrored fence).  Features that vary in any text take the quartiles;
repetition, which most texts have none of, takes the median and the upper
tenth; repeated lines the upper tenth and hundredth.  ``floor`` allows
for the rounding of the sketch and, for repetition, for groups that have next to none.

The sketch is a log-linear histogram over whole numbers: a value below
``2 * SUB`` is its own bucket, above that each power of two is cut in ``SUB``
buckets, so a quantile is off by at most 1/SUB of its value.  Two sketches
merge by adding their counts; Spark therefore builds them map-side and a hot
source costs one small row per bucket and task.  To every group's sketch the
corpus's is added with the weight of ``prior`` documents: a small group leans
on the corpus, a large one hardly, and no size makes a jump.

Features are whole numbers in thousandths, so every engine gets the same
values.  Cases: a null or empty text has no words (base_failed); null lang or
source form groups of their own; repeated rows count each; extra columns pass
through ``apply_rules``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from titleflow.llm.common import map_texts, materialise

SYMBOLS = b"#*$%&|<>"
#: ASCII punctuation and symbols.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SUB_BITS = 5
SUB = 1 << SUB_BITS

class Fence(NamedTuple):
    low: int  # the two quantiles, in hundredths
    high: int
    spread: int
    floor: int  # least distance of a fence from its quantile, in thousandths
    both: bool = False  # a fence on the low side too


FEATURES: dict[str, Fence] = {
    "f_marks": Fence(25, 75, 4, 20),  # ASCII punctuation and symbols per word
    "f_dup_line": Fence(90, 99, 1, 50),  # lines equal to an earlier one
    "f_repeat": Fence(50, 90, 8, 200),  # words in repeated three-word windows
    "f_upper": Fence(25, 75, 12, 20),  # A-Z per word character
    "f_word_len": Fence(25, 75, 4, 1000, both=True),  # code points per word
}
PRIOR = 30
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

_MARKS = MARKS.encode()
_UPPER = bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a ``width``-word window occurring twice or more."""
    n = len(words)
    if n <= width:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    window = code[: n - width + 1]
    for k in range(1, width):
        window = window * len(ids) + code[k : n - width + 1 + k]
        if len(ids) > 1 << 20:  # keep codes small enough for the next product
            window = np.unique(window, return_inverse=True)[1]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(ranked), bool)
    again[1:] |= same
    again[:-1] |= same
    hit = np.zeros(n, bool)
    at = order[again]
    for k in range(width):
        hit[at + k] = True
    return int(hit.sum())


def _text_stats(text: bytes) -> tuple[int, ...]:
    words = text.split()
    joined = b"".join(words)
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        lines += 1
        if line in seen:
            dup += bool(line.strip())
        else:
            seen.add(line)
    chars = len(joined) - len(joined.translate(None, bytes(set(range(256)) - set(_CONTINUATION)))) if joined else 0
    n_upper = len(joined) - len(joined.translate(None, _UPPER))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    n_marks = len(text) - len(text.translate(None, _MARKS))
    return len(words), chars, n_symbols, dup, repeated_window_words(words), lines, n_upper, n_marks


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]


def text_stats(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """One row per document: ``keep`` and the counts ``STATS`` over its whole text."""

    def make():
        return lambda texts: list(zip(*map(_text_stats, texts))) or [[] for _ in STATS]

    return map_texts(docs, text, keep, [(s, "bigint", pa.int64()) for s in STATS], make)


def with_features(stats: DataFrame) -> DataFrame:
    """The features in thousandths; zero where there is nothing to divide by."""

    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.expr(f"1000 * {a} div {b}")).otherwise(F.lit(0)).cast("bigint")

    return stats.withColumns(
        {
            "f_marks": per("n_marks", "n_words"),
            "f_dup_line": per("n_dup_lines", "n_lines"),
            "f_repeat": per("n_repeat_words", "n_words"),
            "f_upper": per("n_upper", "word_chars"),
            "f_word_len": per("word_chars", "n_words"),
        }
    )


def bucket(value: Column) -> Column:
    """The sketch bucket of a whole number >= 0."""
    bits = F.greatest(F.length(F.bin(value)) - (SUB_BITS + 1), F.lit(0)).cast("int")
    return (bits * SUB + F.call_function("shiftright", value, bits)).cast("int")


def bucket_top(b: Column) -> Column:
    """The largest value that falls into a bucket."""
    bits = F.greatest(F.floor(b / SUB) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (b - bits * SUB + 1).cast("bigint"), bits) - 1


def sketch(features: DataFrame, group: list[str], names: list[str]) -> DataFrame:
    """(group, feature, bucket, n): one mergeable sketch per group and feature."""
    long = features.select(
        *group,
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), bucket(F.col(f)).alias("bucket")) for f in names])).alias("x"),
    ).select(*group, "x.*")
    return long.groupBy(*group, "feature", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, group: list[str]) -> DataFrame:
    return sketches.groupBy(*group, "feature", "bucket").agg(F.sum("n").alias("n"))


def by_feature(part: str) -> Column:
    """A field of each feature's ``Fence``, looked up by the column ``feature``."""
    return F.create_map(*[x for f, fence in FEATURES.items() for x in (F.lit(f), F.lit(getattr(fence, part)).cast("bigint"))])[F.col("feature")]


def quantiles(sketches: DataFrame, group: list[str]) -> DataFrame:
    """(group, feature, low, high): the top of the bucket where each of the feature's two quantiles is reached."""
    per = Window.partitionBy(*group, "feature")
    running = per.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    at = sketches.withColumns({"upto": F.sum("n").over(running), "total": F.sum("n").over(per), "top": bucket_top(F.col("bucket"))})
    reached = lambda part: F.min(F.when(F.col("upto") * 100 >= F.col("total") * by_feature(part), F.col("top")))
    return at.groupBy(*group, "feature").agg(reached("low").alias("low"), reached("high").alias("high"))


def leaning(sketches: DataFrame, group: list[str], prior: int) -> DataFrame:
    """Each group's sketch and the corpus's with the weight of ``prior`` documents, all weights times the corpus's size (so they stay whole)."""
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    corpus = merge(sketches, [])
    sizes = corpus.groupBy("feature").agg(F.sum("n").alias("size"))
    own = sketches.join(sizes, "feature").select(*group, "feature", "bucket", (whole("n") * whole("size")).cast("decimal(38,0)").alias("n"))
    added = sketches.select(*group, "feature").distinct().join(corpus, "feature").select(*group, "feature", "bucket", (whole("n") * prior).cast("decimal(38,0)").alias("n"))
    return merge(own.unionByName(added), group)


def fences(sketches: DataFrame, group: list[str], prior: int = PRIOR) -> DataFrame:
    """One row per group with ``<feature>_lo`` and ``<feature>_hi``."""
    own = quantiles(leaning(sketches, group, prior), group)
    gap = F.greatest((F.col("high") - F.col("low")) * by_feature("spread"), by_feature("floor"))
    wide = own.select(*group, "feature", (F.col("low") - gap).alias("lo"), (F.col("high") + gap).alias("hi"))
    picks = [F.max(F.when(F.col("feature") == f, F.col(side))).alias(f"{f}_{side}") for f in FEATURES for side in ("lo", "hi")]
    return wide.groupBy(*group).agg(*picks)


def _renamed(docs: DataFrame, keep: list[str], text: str, lang: str, source: str) -> DataFrame:
    """The columns needed, under names of their own, so that no extra column can clash."""
    return docs.select(
        *[F.col(c).alias(f"k_{c}") for c in keep],
        F.col(lang).alias("g_lang"),
        F.col(source).alias("g_source"),
        *([] if text in keep else [F.col(text).alias("t")]),
    )


def _stats(renamed: DataFrame, text: str) -> DataFrame:
    body = "t" if "t" in renamed.columns else f"k_{text}"
    return with_features(text_stats(renamed, [c for c in renamed.columns if c != "t"], body))


def _judge(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """``stats`` with ``base_failed`` and ``kept``, by the fences of each row's group."""
    limits = limits.withColumnsRenamed({"g_lang": "l_lang", "g_source": "l_source"})
    joined = stats.join(limits, F.col("g_lang").eqNullSafe(F.col("l_lang")) & F.col("g_source").eqNullSafe(F.col("l_source")), "left")
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    outlier = F.lit(False)
    for f, fence in FEATURES.items():
        outlier = outlier | (F.col(f) > F.col(f"{f}_hi"))
        if fence.both:
            outlier = outlier | (F.col(f) < F.col(f"{f}_lo"))
    return joined.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & ~outlier)


GROUP = ["g_lang", "g_source"]


def apply_rules(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Columns ``keep``, ``STATS``, ``base_failed``, ``kept``.

    The texts are read once; the counts are written to the shared folder and
    serve both the sketches and the verdicts.
    """
    stats = materialise(_stats(_renamed(docs, keep, text, lang, source), text), "quality-stats")
    judged = _judge(stats, fences(sketch(stats, GROUP, list(FEATURES)), GROUP))
    return judged.select(*[F.col(f"k_{c}").alias(c) for c in keep], *STATS, "base_failed", "kept")


def filter_docs(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns.

    Reads the texts twice (for the fences, then for the verdicts) so that no
    text is written or shuffled on the way.
    """
    learned = _stats(_renamed(docs, [], text, lang, source), text)
    limits = materialise(fences(sketch(learned, GROUP, list(FEATURES)), GROUP), "quality-fences")
    judged = _judge(_stats(_renamed(docs, docs.columns, text, lang, source), text), limits)
    return judged.where("kept").select(*[F.col(f"k_{c}").alias(c) for c in docs.columns])
