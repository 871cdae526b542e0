"""Column-level helpers: every one returns a :class:`pyspark.sql.Column`
built from Spark built-ins, so it stays inside whole-stage codegen."""

from titleflow.functions.columns import (  # noqa: F401
    NULL_MARKER,
    as_list,
    hash_fraction,
    lenient,
    marker_to_null,
    rating_band,
    render_list,
    seeded_order_key,
    sorted_values,
)
