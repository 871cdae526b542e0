"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

# Fixed values that must match the source files' conventions.
# The catalogue extracts write a missing value as a backslash followed by N.
NULL_MARKER = "\\N"
# Rating band names and their upper bounds (inclusive); anything above the
# last bound, and NULL or NaN ratings, fall in the last band.
RATING_BANDS = (("low", 4.0), ("medium_low", 6.0), ("medium_high", 8.0), ("high", None))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient(c: str | Column, to: str | DataType) -> Column:
    """Cast that yields NULL instead of failing (ANSI-safe)."""
    return _col(c).try_cast(to)


def marker_to_null(c: str | Column, marker: str = NULL_MARKER) -> Column:
    """Turn the textual null marker into a real NULL."""
    return F.nullif(_col(c), F.lit(marker))


def rating_band(rating: str | Column) -> Column:
    """Four-way banding of a rating: ``<=4``, ``(4,6]``, ``(6,8]``, else high.

    NULL and NaN compare false everywhere, so they land in the last band.
    """
    r = _col(rating)
    expr = None
    for name, upper in RATING_BANDS:
        if upper is None:
            expr = expr.otherwise(F.lit(name))
        elif expr is None:
            expr = F.when(r <= upper, F.lit(name))
        else:
            expr = expr.when(r <= upper, F.lit(name))
    return expr


def seeded_order_key(key: str | Column, seed: int) -> Column:
    """A repeatable pseudo-random sort key: md5 of ``key:seed``.

    Unlike ``rand(seed)`` it does not depend on partitioning, so a sample is
    the same at any parallelism (and equal to the SQL oracle's).
    """
    return F.md5(F.concat(_col(key).cast("string"), F.lit(f":{seed}")))


def hash_fraction(key: str | Column, seed: int) -> Column:
    """Map ``key`` to a repeatable number in [0, 1) from its seeded md5."""
    head = F.substring(seeded_order_key(key, seed), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def as_list(
    c: str | Column, dtype: DataType, sep_regex: str = r"\s*,\s*", drop: tuple[str, ...] = (NULL_MARKER,)
) -> Column:
    """Normalise a list column: arrays pass through, text is split on commas.

    NULL text becomes an empty array; items are trimmed, and blanks and the
    values in ``drop`` (by default the null marker) are removed.
    """
    col = _col(c)
    if isinstance(dtype, ArrayType):
        arr = F.coalesce(col, F.array().cast(dtype))
        arr = F.transform(arr, lambda x: F.trim(x.cast("string")))
    else:
        arr = F.when(col.isNull(), F.array().cast(ArrayType(StringType()))).otherwise(
            F.split(F.trim(col), sep_regex)
        )
    banned = F.array(*[F.lit(v) for v in ("",) + tuple(drop)])
    return F.filter(arr, lambda x: x.isNotNull() & ~F.array_contains(banned, x))


def sorted_values(collected: Column, field: str) -> Column:
    """Sort an array of structs (by their leading fields) and keep one field."""
    return F.transform(F.array_sort(collected), lambda x: x[field])


def render_list(c: str | Column, sep: str = "|") -> Column:
    """Arrays as text for order-insensitive comparison: NULL stays NULL,
    an empty array becomes the empty string."""
    return F.array_join(_col(c), sep)
