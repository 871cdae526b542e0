"""Secret scans with corpus-wide ownership frequency (Spark SQL functions only).

``scan`` finds spans in whole texts.  Spark returns matches without positions,
so each pattern also splits the text: the lengths of the pieces between and of
the matches add up to code-point offsets.

``ownership`` hashes every candidate value and counts, over the whole corpus,
the distinct owners and repositories it appears with.  A value that is spread
over more than ``max_owners`` owners, or by few owners over more than
``max_repos`` repositories each on average, is a copied example; one that
stays with few owners and repositories and looks live (mixed characters, no
run of one character) is taken for a real credential.  Base spans stay whatever their verdict; long
mixed tokens that no base pattern covers become ``owned`` spans when they are
owner-specific and live-looking.

Cases: a null text is empty and has no spans; null owners and repositories
count as one (unknown) owner; repeated rows get a row each; rows meet their
verdicts through a row key written with the scan, not by document id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import materialise

#: The base kinds in order, each with its pattern, the group that holds the value and its least length.
ASSIGN = r"""((?:(?i)password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS: list[tuple[str, str, int, int]] = [
    ("assign", ASSIGN, 2, 6),
    # A whole run either has the length or no part of it has, so the least length can stand in the pattern.
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
]
#: The method's own candidates: long tokens; ``scan`` keeps those with letters and digits.
OWNED = ("owned", r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}", 0, 20)
MAX_OWNERS = 2
MAX_REPOS = 3


def spans(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """array<struct<start,rank,end,kind,value>> of a kind, in text order."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.split(text, pattern, -1)
    # Offsets: sum over i of gap lengths and match lengths up to the match.
    paired = F.arrays_zip(whole.alias("m"), values.alias("v"), F.slice(gaps, 1, F.size(whole)).alias("g"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    walked = F.aggregate(
        paired,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["g"]) + F.char_length(x["m"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + F.char_length(x["g"])).alias("start"),
                        F.lit(rank).alias("rank"),
                        (acc["at"] + F.char_length(x["g"]) + F.char_length(x["m"])).alias("end"),
                        F.lit(kind).alias("kind"),
                        x["v"].alias("value"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(pattern), F.filter(walked, lambda s: F.char_length(s["value"]) >= least)).otherwise(empty)


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``base`` and ``candidate`` (arrays of spans)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kinds = [spans(F.col("_body"), k, i, p, g, n) for i, (k, p, g, n) in enumerate(KINDS)]
    own = F.filter(spans(F.col("_body"), OWNED[0], len(KINDS), *OWNED[1:]), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return docs.select(*keep, body.alias("_body")).select(*keep, F.array_sort(F.concat(*kinds)).alias("base"), own.alias("candidate"))


def live_looking(value: Column) -> Column:
    """Letters and digits mixed, and no character four times in a row."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(r"(.)\1{3}")


def ownership(found: DataFrame, owner: str, repo: str, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """(secret, n_owners, n_repos, n_uses, verdict) of every candidate hash in ``found`` (secret, live, owner, repo).

    Rows are first cut to one per (secret, owner, repository), map-side, so a
    value copied into a third of the corpus reaches the last step as counts.
    """
    per_repo = found.groupBy("secret", F.col(owner).alias("o"), F.col(repo).alias("r")).agg(F.count(F.lit(1)).alias("n"), F.max("live").alias("live"))
    per_owner = per_repo.groupBy("secret", "o").agg(F.count(F.lit(1)).alias("n_repos"), F.sum("n").alias("n"), F.max("live").alias("live"))
    totals = per_owner.groupBy("secret").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n_repos").alias("n_repos"), F.sum("n").alias("n_uses"), F.max("live").alias("live"))
    spread = (F.col("n_owners") > max_owners) | (F.col("n_repos") > F.col("n_owners") * max_repos)
    verdict = F.when(spread, F.lit("example")).when(F.col("live"), F.lit("live")).otherwise(F.lit("weak"))
    return totals.select("secret", "n_owners", "n_repos", "n_uses", verdict.alias("verdict"))


def find(docs: DataFrame, keep: list[str], owner: list[str], repo: list[str], text: str = "text", max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Columns ``keep``, ``base`` and ``all`` (arrays of spans), ``n_live`` and ``n_example``.

    ``owner`` and ``repo`` name the columns that make up an owner and a repository.
    """
    kept = [f"k_{c}" for c in keep]
    source = docs.select(
        *[F.col(c).alias(f"k_{c}") for c in keep],
        F.struct(*[F.col(c) for c in owner]).alias("o"),
        F.struct(*[F.col(c) for c in repo]).alias("r"),
        F.col(text).alias("t"),
    )
    # The row key is fixed by writing it; rows without a span need no join at all.
    scanned = materialise(scan(source, [*kept, "o", "r"], "t").withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    each = scanned.select("row", "o", "r", F.explode(F.concat("base", "candidate")).alias("s")).select(
        "row", "o", "r", "s", F.sha2(F.col("s.value"), 256).alias("secret"), live_looking(F.col("s.value")).alias("live")
    )
    judged = materialise(ownership(each, "o", "r", max_owners, max_repos).select("secret", "verdict"), "secret-owners")
    verdicts = (
        each.join(judged, "secret")
        .groupBy("row")
        .agg(
            F.collect_list(F.when((F.col("s.kind") == OWNED[0]) & (F.col("verdict") == "live"), F.col("s"))).alias("owned"),
            F.count_if((F.col("s.kind") != OWNED[0]) & (F.col("verdict") == "live")).alias("n_live"),
            F.count_if((F.col("s.kind") != OWNED[0]) & (F.col("verdict") == "example")).alias("n_example"),
        )
    )
    outside = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    joined = scanned.join(verdicts, "row", "left")
    owned = F.filter(F.coalesce("owned", F.expr("filter(base, b -> false)")), outside)
    return joined.select(
        *[F.col(f"k_{c}").alias(c) for c in keep],
        "base",
        F.array_sort(F.concat("base", owned)).alias("all"),
        F.coalesce("n_live", F.lit(0).cast("bigint")).alias("n_live"),
        F.coalesce("n_example", F.lit(0).cast("bigint")).alias("n_example"),
    )


def rendered(column: str) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(column: str, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("bigint")
