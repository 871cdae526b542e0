"""Keyed upsert (MERGE: matched -> update all columns, unmatched -> insert).

Parquet has no MERGE, so the merged table is computed as two joins whose
results are appended:

* ``target LEFT JOIN source`` on the key: a target row takes the source's
  values when matched, otherwise keeps its own (updated + untouched rows);
* ``source LEFT ANTI JOIN distinct(target keys)``: source rows matching no
  target row (inserted rows).

That keeps MERGE semantics exactly: several target rows with one key are
each updated; NULL keys never match (NULL-key target rows are kept, NULL-key
source rows inserted); a key repeated in the source that matches the target
is an error, as in MERGE; repeats that match nothing are all inserted.

Why not one full outer join: Spark's adaptive skew handling does not split
full outer joins, and a key may hold a large share of the target (a table
keyed on a column that repeats).  The left join's streamed side is the
target, which AQE splits when one key is hot; the anti join only needs the
target's distinct keys, which a partial aggregate collapses map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


DUPLICATE_KEY = "source has repeated keys that match the target"


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after ``MERGE source ON keys`` (update all, insert all).

    Columns are matched by name; the result has the target's columns.  If a
    key repeated in the source matches a target row, the job that runs the
    result fails with ``DUPLICATE_KEY``: the check rides in the join itself.
    """
    keys = list(keys)
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns])
    # NULL keys match nothing, so they (however many) stay out of the count and the join.
    s = source.dropna(subset=keys).select(*[F.col(c).alias(f"s_{c}") for c in target.columns])
    s = s.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*[f"s_{k}" for k in keys])))
    cond = None
    for k in keys:
        term = F.col(f"t_{k}") == F.col(f"s_{k}")
        cond = term if cond is None else cond & term
    hit = F.col("_copies").isNotNull()
    clash = F.raise_error(F.concat(F.lit(f"{DUPLICATE_KEY}: "), F.to_json(F.struct(*[f"s_{k}" for k in keys]))))
    kept_or_updated = (
        t.join(s, cond, "left")
        .withColumn("_hit", F.when(F.col("_copies") > 1, clash.cast("boolean")).otherwise(hit))
        .select(*[F.when(F.col("_hit"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in target.columns])
    )
    inserted = source.select(*target.columns).join(target.select(*keys).distinct(), keys, "left_anti")
    return kept_or_updated.unionByName(inserted.select(*target.columns))
