"""Bronze -> silver cleaning: declarative per-table specs, one projection and
one filter per table (a narrow plan: no shuffle)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.functions.columns import NULL_MARKER, lenient, marker_to_null


@dataclass(frozen=True)
class CleanSpec:
    """What to do with each named column; other columns pass through.

    * ``marker_int``: null marker -> NULL, then lenient cast to int
    * ``ints`` / ``doubles`` / ``booleans``: lenient casts
    * ``required``: rows with NULL in any of these (after casting) are dropped
    """

    marker_int: tuple[str, ...] = ()
    ints: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    marker: str = NULL_MARKER
    renames: dict[str, str] = field(default_factory=dict)

    def column(self, name: str) -> Column:
        c = F.col(name)
        if name in self.marker_int:
            return lenient(marker_to_null(c, self.marker), "int").alias(name)
        if name in self.ints:
            return lenient(c, "int").alias(name)
        if name in self.doubles:
            return lenient(c, "double").alias(name)
        if name in self.booleans:
            return lenient(c, "boolean").alias(name)
        return c


# The seven catalogue tables and how each is cleaned.
SPECS: dict[str, CleanSpec] = {
    "title_basics": CleanSpec(
        marker_int=("startYear", "endYear", "runtimeMinutes"), booleans=("isAdult",), required=("tconst",)
    ),
    "title_akas": CleanSpec(booleans=("isOriginalTitle",), required=("title",)),
    "title_crew": CleanSpec(required=("tconst",)),
    "title_episode": CleanSpec(marker_int=("seasonNumber", "episodeNumber"), required=("parentTconst",)),
    "title_principals": CleanSpec(ints=("ordering",), required=("tconst", "nconst")),
    "title_ratings": CleanSpec(doubles=("averageRating",), ints=("numVotes",), required=("averageRating", "numVotes")),
    "name_basics": CleanSpec(marker_int=("birthYear", "deathYear"), required=("primaryName",)),
}


def apply_spec(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply a spec: one ``select`` for the casts, one ``filter`` for the
    required columns.  ``isNotNull`` per column (not ``na.drop``, which would
    also drop NaN)."""
    out = df.select(*[spec.column(c) for c in df.columns])
    cond = None
    for r in spec.required:
        term = F.col(r).isNotNull()
        cond = term if cond is None else cond & term
    return out if cond is None else out.filter(cond)


def clean(df: DataFrame, table: str) -> DataFrame:
    return apply_spec(df, SPECS[table])
