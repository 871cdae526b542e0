"""DuckDB SQL for every registered query (the correctness oracle).

The driver pre-registers the generated tables as views.  The domain tables
of :mod:`titleflow.plans.fixtures` are re-derived here as CTEs, written
independently in SQL; each query's SQL pulls in the CTEs it needs.
"""

from __future__ import annotations

import re

# name -> (sql body); dependencies are found by name.
CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _deps(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", sql)]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) references, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for d in _deps(CTES[name]):
            if d != name:
                visit(d)
        ordered.append(name)

    for n in _deps(body):
        visit(n)
    if not ordered:
        return body.strip()
    head = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in ordered)
    return f"WITH {head}\n{body.strip()}"


# ---------------------------------------------------------------- bronze
cte(
    "genre_lists",
    """
SELECT l.l_orderkey AS k, string_agg(DISTINCT p.p_type, ',' ORDER BY p.p_type) AS genres
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY l.l_orderkey
""",
)
cte(
    "writer_lists",
    """
SELECT l_orderkey AS k, string_agg('ns' || l_suppkey, ',' ORDER BY l_linenumber, l_suppkey) AS writers
FROM lineitem WHERE l_returnflag = 'N'
GROUP BY l_orderkey
""",
)
cte(
    "bronze_title_basics",
    r"""
SELECT 'tt' || o.o_orderkey AS tconst,
       'movie' AS titleType,
       'Title ' || o.o_orderkey AS primaryTitle,
       CASE WHEN o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P' THEN '\N'
            ELSE CAST(year(o.o_orderdate) AS VARCHAR) END AS startYear,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(year(o.o_orderdate) + 1 AS VARCHAR) ELSE '\N' END AS endYear,
       CASE WHEN o.o_orderpriority = '3-MEDIUM' AND o.o_orderstatus = 'O' THEN '\N'
            ELSE CAST(CAST(60 + floor(o.o_totalprice / 5000) AS BIGINT) AS VARCHAR) END AS runtimeMinutes,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END AS isAdult,
       coalesce(g.genres, '\N') AS genres
FROM orders o LEFT JOIN genre_lists g ON o.o_orderkey = g.k
""",
)
cte(
    "bronze_title_ratings",
    """
SELECT 'tt' || o_orderkey AS tconst,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'N/A'
            ELSE CAST(CAST(floor(o_totalprice / 5000) AS BIGINT) / 10.0 AS VARCHAR) END AS averageRating,
       CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) AS numVotes
FROM orders
""",
)
cte(
    "bronze_name_basics",
    r"""
SELECT 'ns' || s_suppkey AS nconst,
       regexp_replace(s_name, '^Supplier', 'Person') AS primaryName,
       CASE WHEN s_acctbal < 0 THEN '\N' ELSE CAST(1930 + s_nationkey AS VARCHAR) END AS birthYear,
       '\N' AS deathYear
FROM supplier
UNION ALL
SELECT 'nc' || c_custkey AS nconst,
       regexp_replace(c_name, '^Customer', 'Person') AS primaryName,
       CAST(1940 + c_nationkey AS VARCHAR) AS birthYear,
       CASE WHEN c_acctbal < 0 THEN CAST(2000 + c_nationkey AS VARCHAR) ELSE '\N' END AS deathYear
FROM customer
""",
)
cte(
    "bronze_title_principals",
    """
SELECT 'tt' || l_orderkey AS tconst,
       CAST(l_linenumber AS VARCHAR) AS ordering,
       'ns' || l_suppkey AS nconst,
       CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'R' THEN 'actress' ELSE 'self' END AS category
FROM lineitem
""",
)
cte(
    "bronze_title_crew",
    r"""
SELECT 'tt' || o.o_orderkey AS tconst,
       CASE WHEN o.o_orderstatus = 'P' THEN '\N'
            WHEN o.o_orderpriority = '1-URGENT' THEN 'nc' || o.o_custkey || ',nx' || o.o_custkey
            ELSE 'nc' || o.o_custkey END AS directors,
       coalesce(w.writers, '\N') AS writers
FROM orders o LEFT JOIN writer_lists w ON o.o_orderkey = w.k
""",
)
cte(
    "bronze_title_akas",
    r"""
SELECT 'tt' || l_orderkey AS titleId,
       CAST(l_linenumber AS VARCHAR) AS ordering,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE 'Aka ' || l_partkey END AS title,
       CASE WHEN l_linenumber = 1 THEN '1' WHEN l_linestatus = 'O' THEN '0' ELSE '\N' END AS isOriginalTitle
FROM lineitem
""",
)
cte(
    "bronze_title_episode",
    r"""
SELECT 'tt' || l_orderkey || '-' || l_linenumber AS tconst,
       'tt' || l_orderkey AS parentTconst,
       CASE WHEN l_returnflag = 'N' THEN '\N' ELSE CAST(l_linenumber AS VARCHAR) END AS seasonNumber,
       CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS episodeNumber
FROM lineitem
""",
)
cte(
    "silver_title_plots",
    """
SELECT 'tt' || doc_id AS tconst,
       'Doc ' || doc_id AS title,
       CAST(CASE lang WHEN 'en' THEN 2001 WHEN 'fr' THEN 2002 WHEN 'es' THEN 2003 ELSE 2004 END AS INTEGER) AS year,
       text AS plot
FROM documents
""",
)
cte(
    "lookup_responses",
    """
SELECT 'tt' || event_id AS tconst,
       '{"Response": "' || CASE WHEN event_type = 'error' THEN 'False' ELSE 'True' END
       || '", "Title": "Title ' || user_id
       || '", "Year": "' || year(ts)
       || '", "Plot": "' || CASE WHEN event_type = 'view' THEN 'N/A' ELSE 'Plot of ' || event_type || ' ' || event_id END
       || '", "Meta": ' || props
       || CASE WHEN event_type = 'signup' THEN '' ELSE '}' END AS body
FROM events
""",
)

# ---------------------------------------------------------------- silver
cte(
    "silver_title_basics",
    r"""
SELECT tconst, titleType, primaryTitle,
       TRY_CAST(nullif(startYear, '\N') AS INTEGER) AS startYear,
       TRY_CAST(nullif(endYear, '\N') AS INTEGER) AS endYear,
       TRY_CAST(nullif(runtimeMinutes, '\N') AS INTEGER) AS runtimeMinutes,
       TRY_CAST(isAdult AS BOOLEAN) AS isAdult,
       genres
FROM bronze_title_basics WHERE tconst IS NOT NULL
""",
)
cte(
    "silver_title_ratings",
    """
SELECT tconst, averageRating, numVotes FROM (
  SELECT tconst, TRY_CAST(averageRating AS DOUBLE) AS averageRating, TRY_CAST(numVotes AS INTEGER) AS numVotes
  FROM bronze_title_ratings) r
WHERE averageRating IS NOT NULL AND numVotes IS NOT NULL
""",
)
cte(
    "silver_name_basics",
    r"""
SELECT nconst, primaryName,
       TRY_CAST(nullif(birthYear, '\N') AS INTEGER) AS birthYear,
       TRY_CAST(nullif(deathYear, '\N') AS INTEGER) AS deathYear
FROM bronze_name_basics WHERE primaryName IS NOT NULL
""",
)
cte(
    "silver_title_principals",
    """
SELECT tconst, TRY_CAST(ordering AS INTEGER) AS ordering, nconst, category
FROM bronze_title_principals WHERE tconst IS NOT NULL AND nconst IS NOT NULL
""",
)
cte("silver_title_crew", "SELECT tconst, directors, writers FROM bronze_title_crew WHERE tconst IS NOT NULL")
cte(
    "silver_title_akas",
    """
SELECT titleId, ordering, title, TRY_CAST(isOriginalTitle AS BOOLEAN) AS isOriginalTitle
FROM bronze_title_akas WHERE title IS NOT NULL
""",
)
cte(
    "silver_title_episode",
    r"""
SELECT tconst, parentTconst,
       TRY_CAST(nullif(seasonNumber, '\N') AS INTEGER) AS seasonNumber,
       TRY_CAST(nullif(episodeNumber, '\N') AS INTEGER) AS episodeNumber
FROM bronze_title_episode WHERE parentTconst IS NOT NULL
""",
)

# ---------------------------------------------------------------- people lists
# One long table (title, role, position, person id), as in the Spark plan.
cte(
    "crew_long",
    r"""
SELECT tconst, 'director' AS role, pos, nconst FROM (
  SELECT tconst, unnest(s) AS nconst, generate_subscripts(s, 1) - 1 AS pos
  FROM (SELECT tconst, string_split(directors, ',') AS s FROM silver_title_crew WHERE directors IS NOT NULL) x) d
UNION ALL
SELECT tconst, 'writer' AS role, pos, nconst FROM (
  SELECT tconst, unnest(s) AS nconst, generate_subscripts(s, 1) - 1 AS pos
  FROM (SELECT tconst, string_split(writers, ',') AS s FROM silver_title_crew WHERE writers IS NOT NULL) x) w
WHERE nconst <> '\N'
""",
)
cte(
    "people_long",
    """
SELECT tconst, 'actor' AS role, ordering AS pos, nconst FROM silver_title_principals
WHERE category IN ('actor', 'actress')
UNION ALL
SELECT tconst, role, pos, nconst FROM crew_long
""",
)
cte(
    "people_named",
    """
SELECT l.tconst, l.role, l.pos, l.nconst, n.primaryName
FROM people_long l LEFT JOIN silver_name_basics n ON l.nconst = n.nconst
""",
)
cte(
    "people_lists",
    """
SELECT tconst,
  CASE WHEN count(*) FILTER (WHERE role = 'actor') > 0 THEN coalesce(
    list(primaryName ORDER BY pos NULLS FIRST, nconst) FILTER (WHERE role = 'actor' AND primaryName IS NOT NULL),
    []) END AS actors,
  CASE WHEN count(*) FILTER (WHERE role = 'director') > 0 THEN coalesce(
    list(primaryName ORDER BY pos NULLS FIRST, nconst) FILTER (WHERE role = 'director' AND primaryName IS NOT NULL),
    []) END AS directors,
  CASE WHEN count(*) FILTER (WHERE role = 'writer') > 0 THEN coalesce(
    list(primaryName ORDER BY pos NULLS FIRST, nconst) FILTER (WHERE role = 'writer' AND primaryName IS NOT NULL),
    []) END AS writers
FROM people_named GROUP BY tconst
""",
)
cte(
    "gold_prediction_input",
    """
SELECT p.tconst, b.primaryTitle AS title, p.plot, b.startYear AS year, b.genres, r.averageRating,
       l.directors, l.writers, l.actors
FROM silver_title_plots p
JOIN silver_title_basics b ON p.tconst = b.tconst
LEFT JOIN silver_title_ratings r ON p.tconst = r.tconst
LEFT JOIN people_lists l ON p.tconst = l.tconst
""",
)


def r6(expr: str, offset: float = 0.5) -> str:
    """Six decimals, computed as in the Spark queries (ties alike)."""
    return f"floor(({expr}) * 1e6 + {offset}) / 1e6"


#: Means of tenths often end on a half of the last decimal, where the order of a
#: double sum would decide; they never end on this offset's complement.
OFF_TIES = 0.3137


def _render(col: str) -> str:
    return f"array_to_string({col}, '|') AS {col}"


SQL: dict[str, str] = {}


def query(name: str, body: str) -> None:
    SQL[name] = with_ctes(body)


query(
    "assemble_gold",
    f"""
SELECT tconst, title, plot, year, genres, averageRating,
       {_render('directors')}, {_render('writers')}, {_render('actors')}
FROM gold_prediction_input
""",
)
query(
    "people_list",
    f"""
SELECT tconst, {_render('actors')} FROM people_lists WHERE actors IS NOT NULL
""",
)
query(
    "csv_people_list",
    f"""
SELECT tconst, {_render('directors')}, {_render('writers')} FROM people_lists
WHERE directors IS NOT NULL OR writers IS NOT NULL
""",
)

# ------------------------------------------------------------------ cleaning
for _key, _table in (
    ("clean_sentinel_int", "title_basics"),
    ("clean_numeric", "title_ratings"),
    ("clean_boolean", "title_akas"),
    ("clean_required", "title_principals"),
    ("clean_title_episode", "title_episode"),
    ("clean_title_crew", "title_crew"),
    ("clean_name_basics", "name_basics"),
):
    query(_key, f"SELECT * FROM silver_{_table}")

# ------------------------------------------------------------------ sampling
cte(
    "banded_ratings",
    """
SELECT tconst, averageRating, numVotes,
       CASE WHEN averageRating <= 4 THEN 'low'
            WHEN averageRating <= 6 THEN 'medium_low'
            WHEN averageRating <= 8 THEN 'medium_high'
            ELSE 'high' END AS rating_group
FROM silver_title_ratings WHERE numVotes >= 1000
""",
)
query(
    "rating_histogram",
    """
SELECT CAST(floor(averageRating) AS BIGINT) AS rating_floor, count(*) AS count
FROM silver_title_ratings GROUP BY 1
""",
)
query("rating_band", "SELECT * FROM banded_ratings")
cte(
    "drawn_titles",
    """
SELECT tconst, averageRating, numVotes, rating_group FROM (
  SELECT *, row_number() OVER (PARTITION BY rating_group ORDER BY md5(tconst || ':42'), tconst) AS rn
  FROM banded_ratings) s
WHERE rn <= CASE rating_group WHEN 'low' THEN 60000 WHEN 'medium_low' THEN 90000
                              WHEN 'medium_high' THEN 90000 WHEN 'high' THEN 60000 ELSE 0 END
""",
)
query("stratified_sample", "SELECT * FROM drawn_titles")
query(
    "stratified_sample_share",
    """
SELECT tconst, averageRating, numVotes, rating_group FROM (
  SELECT *, row_number() OVER (PARTITION BY rating_group ORDER BY md5(tconst || ':42'), tconst) AS rn,
         (SELECT count(*) // 10 FROM silver_title_ratings) AS total
  FROM banded_ratings) s
WHERE rn <= floor(total * CASE rating_group WHEN 'low' THEN 0.2::DOUBLE WHEN 'medium_low' THEN 0.3::DOUBLE
                                            WHEN 'medium_high' THEN 0.3::DOUBLE WHEN 'high' THEN 0.2::DOUBLE ELSE 0 END)
""",
)

# ------------------------------------------------------------------ upsert
cte(
    "ratings_load_1",
    """
SELECT 'tt' || o_orderkey AS tconst,
       CAST(CAST(floor(o_totalprice / 5000) AS BIGINT) / 10.0 AS VARCHAR) AS averageRating,
       CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) AS numVotes
FROM orders WHERE o_orderstatus <> 'P'
""",
)
cte(
    "ratings_load_2",
    """
SELECT 'tt' || o_orderkey AS tconst,
       CAST(CAST(floor(o_totalprice / 5000) AS BIGINT) / 10.0 AS VARCHAR) AS averageRating,
       CAST(CAST(floor(o_totalprice / 100) AS BIGINT) + 1 AS VARCHAR) AS numVotes
FROM orders WHERE o_orderstatus <> 'F'
""",
)
query(
    "upsert",
    """
SELECT tconst, averageRating, numVotes FROM ratings_load_2
UNION ALL
SELECT t.tconst, t.averageRating, t.numVotes FROM ratings_load_1 t
WHERE NOT EXISTS (SELECT 1 FROM ratings_load_2 s WHERE s.tconst = t.tconst)
""",
)

# ------------------------------------------------------------------ enrichment
cte(
    "parsed_replies",
    """
SELECT tconst,
       CASE WHEN ok THEN json_extract_string(jb, '$.Title') END AS title,
       CASE WHEN ok THEN TRY_CAST(json_extract_string(jb, '$.Year') AS INTEGER) END AS year,
       CASE WHEN ok THEN json_extract_string(jb, '$.Plot') END AS plot
FROM (SELECT tconst, jb, coalesce(json_extract_string(jb, '$.Response') = 'True', false) AS ok
      FROM (SELECT tconst, CASE WHEN json_valid(body) THEN body END AS jb FROM lookup_responses) v) r
""",
)
query("parse_lookup_response", "SELECT * FROM parsed_replies WHERE plot IS NOT NULL AND plot <> 'N/A'")
query(
    "title_plots_job",
    "SELECT * FROM parsed_replies WHERE plot IS NOT NULL AND plot <> 'N/A' AND tconst IN (SELECT tconst FROM drawn_titles)",
)
query(
    "enrichment_coverage",
    """
SELECT count(*) AS total,
       count(*) FILTER (WHERE plot IS NOT NULL AND plot <> 'N/A') AS with_plot,
       CASE WHEN count(*) = 0 THEN NULL
            ELSE count(*) FILTER (WHERE plot IS NOT NULL AND plot <> 'N/A') * 100.0 / count(*) END AS pct_with_plot
FROM parsed_replies
""",
)

# ------------------------------------------------------------------ features
cte(
    "person_stats",
    r"""
SELECT nconst, role, CAST(avg(CAST(rating AS DECIMAL(38,18))) AS DOUBLE) AS score_role FROM (
  SELECT l.tconst, l.role, l.nconst, max(r.averageRating) AS rating
  FROM people_long l JOIN silver_title_ratings r ON l.tconst = r.tconst
  WHERE l.nconst <> '\N'
  GROUP BY l.tconst, l.role, l.nconst) t
GROUP BY nconst, role
""",
)
cte("name_index", "SELECT DISTINCT primaryName AS name, nconst FROM silver_name_basics")
cte("global_avg", "SELECT avg(averageRating) AS global_avg FROM silver_title_ratings")
cte(
    "gold_role_long",
    """
SELECT tconst, 'actor' AS role, unnest(actors) AS name FROM gold_prediction_input
UNION ALL SELECT tconst, 'director' AS role, unnest(directors) AS name FROM gold_prediction_input
UNION ALL SELECT tconst, 'writer' AS role, unnest(writers) AS name FROM gold_prediction_input
""",
)
cte(
    "gold_role_agg",
    """
SELECT l.tconst,
  avg(CASE WHEN l.role = 'actor' THEN s.score_role END) AS actor_score_mean,
  max(CASE WHEN l.role = 'actor' THEN s.score_role END) AS actor_score_max,
  avg(CASE WHEN l.role = 'director' THEN s.score_role END) AS director_score_mean,
  max(CASE WHEN l.role = 'director' THEN s.score_role END) AS director_score_max,
  avg(CASE WHEN l.role = 'writer' THEN s.score_role END) AS writer_score_mean,
  max(CASE WHEN l.role = 'writer' THEN s.score_role END) AS writer_score_max
FROM gold_role_long l
JOIN name_index n ON l.name = n.name
JOIN person_stats s ON s.nconst = n.nconst AND s.role = l.role
GROUP BY l.tconst
""",
)
query("person_stats", f"SELECT nconst, role, {r6('score_role')} AS score_role FROM person_stats")
query("name_index", "SELECT name, nconst FROM name_index")
_score_cols = [f"{r}_score_{s}" for r in ("actor", "director", "writer") for s in ("mean", "max")]
query(
    "role_scores",
    "SELECT g.tconst, "
    + ", ".join(f"{r6(f'coalesce(a.{c}, ga.global_avg)')} AS {c}" for c in _score_cols)
    + """
FROM gold_prediction_input g LEFT JOIN gold_role_agg a ON g.tconst = a.tconst, global_avg ga
""",
)
query(
    "year_zscore",
    f"""
SELECT g.tconst, g.year, {r6('(g.year - s.mu) / s.sigma')} AS startYear_z
FROM gold_prediction_input g, (
  SELECT coalesce(avg(year), 0.0) AS mu,
         CASE WHEN stddev_samp(year) IS NULL OR stddev_samp(year) = 0 THEN 1.0 ELSE stddev_samp(year) END AS sigma
  FROM gold_prediction_input) s
""",
)
cte(
    "basics_genres",
    r"""
SELECT tconst,
       CASE WHEN genres IS NULL THEN []::VARCHAR[]
            ELSE list_filter(list_transform(string_split_regex(trim(genres), '\s*,\s*'), lambda x: trim(x)),
                             lambda x: x IS NOT NULL AND x <> '' AND x <> '\N') END AS genres_list
FROM silver_title_basics
""",
)
query("normalize_list", "SELECT tconst, array_to_string(genres_list, '|') AS genres_list FROM basics_genres")
query(
    "genre_multihot",
    """
SELECT g.tconst,
       string_agg(CASE WHEN list_contains(g.genres_list, v.genre) THEN '1' ELSE '0' END, '|' ORDER BY v.genre) AS genre_vector
FROM basics_genres g, (SELECT DISTINCT unnest(genres_list) AS genre FROM basics_genres) v
GROUP BY g.tconst
""",
)

# ------------------------------------------------------------------ text
cte(
    "plot_tokens",
    r"""
SELECT tconst, term, count(*) AS tf FROM (
  SELECT tconst, unnest(regexp_extract_all(lower(coalesce(plot, '')), '[\p{L}\p{N}_]{2,}')) AS term
  FROM silver_title_plots) t
GROUP BY tconst, term
""",
)
cte(
    "plot_vocab",
    """
SELECT term, df FROM (
  SELECT term, count(*) AS df, sum(tf) AS cf FROM plot_tokens GROUP BY term) s
WHERE df >= 3
ORDER BY cf DESC, term ASC
LIMIT 2000
""",
)
cte(
    "plot_tfidf",
    """
SELECT tconst, term, w / sqrt(sum(w * w) OVER (PARTITION BY tconst)) AS weight FROM (
  SELECT t.tconst, t.term, t.tf * (ln((n.n + 1.0) / (v.df + 1.0)) + 1.0) AS w
  FROM plot_tokens t JOIN plot_vocab v ON t.term = v.term,
       (SELECT count(*) AS n FROM silver_title_plots) n) x
""",
)
query("tokens", "SELECT tconst, term, tf FROM plot_tokens")
query("tfidf", f"SELECT tconst, term, {r6('weight')} AS weight FROM plot_tfidf")

# ------------------------------------------------------------------ model
SPLIT = "(('0x' || substr(md5({k} || ':42'), 1, 8))::BIGINT / 4294967296.0 < 0.2)"
query("train_test_split", f"SELECT tconst, {SPLIT.format(k='tconst')} AS is_test FROM silver_title_ratings")
cte("train_titles", f"SELECT tconst, genres FROM gold_prediction_input WHERE NOT {SPLIT.format(k='tconst')}")
cte(
    "train_stats",
    r"""
SELECT nconst, role, CAST(avg(CAST(rating AS DECIMAL(38,18))) AS DOUBLE) AS score_role FROM (
  SELECT l.tconst, l.role, l.nconst, max(r.averageRating) AS rating
  FROM people_long l JOIN silver_title_ratings r ON l.tconst = r.tconst
  WHERE l.nconst <> '\N' AND l.tconst IN (SELECT tconst FROM train_titles)
  GROUP BY l.tconst, l.role, l.nconst) t
GROUP BY nconst, role
""",
)
cte("train_avg", "SELECT avg(averageRating) AS fill FROM silver_title_ratings WHERE tconst IN (SELECT tconst FROM train_titles)")
cte(
    "train_role_agg",
    "SELECT l.tconst, "
    + ", ".join(
        f"{fn}(CASE WHEN l.role = '{role}' THEN s.score_role END) AS {role}_score_{name}"
        for role in ("actor", "director", "writer")
        for fn, name in (("avg", "mean"), ("max", "max"))
    )
    + """
FROM gold_role_long l JOIN name_index n ON l.name = n.name
JOIN train_stats s ON s.nconst = n.nconst AND s.role = l.role
GROUP BY l.tconst
""",
)
query(
    "regression_metrics",
    f"""
SELECT count(*) AS n,
       {r6('sqrt(avg((p - y) * (p - y)))')} AS rmse,
       {r6('avg(abs(p - y))')} AS mae,
       {r6('1.0 - avg((p - y) * (p - y)) / nullif(var_pop(y), 0.0)')} AS r2
FROM (
  SELECT g.averageRating AS y, coalesce(a.actor_score_mean, fill) AS p
  FROM gold_prediction_input g LEFT JOIN train_role_agg a ON g.tconst = a.tconst, train_avg
  WHERE {SPLIT.format(k='g.tconst')}) t
""",
)

cte(
    "train_credits",
    r"""
SELECT l.tconst, l.role, l.nconst, max(CAST(round(r.averageRating * 1000000) AS BIGINT)) AS own
FROM people_long l JOIN silver_title_ratings r ON l.tconst = r.tconst
WHERE l.nconst <> '\N' AND l.tconst IN (SELECT tconst FROM train_titles)
GROUP BY l.tconst, l.role, l.nconst
""",
)
cte(
    "own_out_agg",
    "SELECT tconst, "
    + ", ".join(
        f"{fn}(CASE WHEN role = '{role}' THEN score END) AS {role}_score_{name}"
        for role in ("actor", "director", "writer")
        for fn, name in (("avg", "mean"), ("max", "max"))
    )
    + """
FROM (SELECT l.tconst, l.role, (s.total - coalesce(c.own, 0)) / CAST(nullif(s.n - (c.own IS NOT NULL)::BIGINT, 0) AS DOUBLE) / 1000000 AS score
  FROM gold_role_long l JOIN name_index n ON l.name = n.name
  JOIN (SELECT nconst, role, sum(own)::BIGINT AS total, count(*) AS n FROM train_credits GROUP BY nconst, role) s ON s.nconst = n.nconst AND s.role = l.role
  LEFT JOIN train_credits c ON c.tconst = l.tconst AND c.role = l.role AND c.nconst = n.nconst) t
GROUP BY tconst
""",
)
cte(
    "own_out_fill",
    """
SELECT g.tconst, (total - coalesce(own, 0)) / CAST(nullif(n - (own IS NOT NULL)::BIGINT, 0) AS DOUBLE) / 1000000 AS fill
FROM gold_prediction_input g LEFT JOIN (SELECT tconst, CAST(round(averageRating * 1000000) AS BIGINT) AS own
  FROM silver_title_ratings WHERE tconst IN (SELECT tconst FROM train_titles)) r ON g.tconst = r.tconst,
  (SELECT sum(CAST(round(averageRating * 1000000) AS BIGINT))::BIGINT AS total, count(averageRating) AS n
   FROM silver_title_ratings WHERE tconst IN (SELECT tconst FROM train_titles)) k
""",
)
query(
    "role_scores_own_out",
    "SELECT f.tconst, "
    + ", ".join(f"{r6(f'coalesce(a.{c}, f.fill)', OFF_TIES)} AS {c}" for c in _score_cols)
    + "\nFROM own_out_fill f LEFT JOIN own_out_agg a ON f.tconst = a.tconst\n",
)
cte(
    "gold_genres",
    r"""
SELECT tconst, CASE WHEN genres IS NULL THEN []::VARCHAR[]
  ELSE list_filter(list_transform(string_split_regex(trim(genres), '\s*,\s*'), lambda x: trim(x)),
                   lambda x: x IS NOT NULL AND x <> '' AND x <> '\N') END AS genres_list
FROM gold_prediction_input
""",
)
cte("train_vocab", "SELECT DISTINCT unnest(genres_list) AS genre FROM gold_genres WHERE tconst IN (SELECT tconst FROM train_titles)")
query(
    "train_features",
    "SELECT g.tconst, "
    + ", ".join(f"{r6(f'coalesce(a.{c}, o.fill)', OFF_TIES)} AS {c}" for c in _score_cols)
    + f""", 0.0::DOUBLE AS numVotes_log1p, {r6('coalesce((g.year - y.mu) / y.sigma, 0.0)')} AS startYear_z,
  coalesce(b.genre_vector, '') AS genre_vector, CAST(8 + n_genres + 64 AS INTEGER) AS width, g.averageRating
FROM gold_prediction_input g JOIN own_out_fill o ON g.tconst = o.tconst LEFT JOIN own_out_agg a ON g.tconst = a.tconst
LEFT JOIN (
  SELECT t.tconst, string_agg(CASE WHEN list_contains(t.genres_list, v.genre) THEN '1' ELSE '0' END, '|' ORDER BY v.genre) AS genre_vector
  FROM gold_genres t, train_vocab v GROUP BY t.tconst) b ON g.tconst = b.tconst,
(SELECT count(*) AS n_genres FROM train_vocab) k, (
  SELECT coalesce(avg(year), 0.0) AS mu,
         CASE WHEN stddev_samp(year) IS NULL OR stddev_samp(year) = 0 THEN 1.0 ELSE stddev_samp(year) END AS sigma
  FROM gold_prediction_input) y
""",
)
query("score_titles", f"SELECT tconst, averageRating, true AS in_label_range FROM gold_prediction_input WHERE {SPLIT.format(k='tconst')}")
#: The leading right singular vector by power iteration from the all-ones vector
#: (weights are not negative, so it is not orthogonal to it); lengths are left alone until the end.
SVD_STEPS = 24
cte("svd_v0", "SELECT DISTINCT term, 1.0::DOUBLE AS x FROM plot_tfidf")
for _step in range(SVD_STEPS):
    cte(f"svd_u{_step}", f"SELECT t.tconst, sum(t.weight * v.x) AS x FROM plot_tfidf t JOIN svd_v{_step} v ON t.term = v.term GROUP BY t.tconst")
    cte(f"svd_v{_step + 1}", f"SELECT t.term, sum(t.weight * u.x) AS x FROM plot_tfidf t JOIN svd_u{_step} u ON t.tconst = u.tconst GROUP BY t.term")
cte("svd_first", f"SELECT term, x / sqrt((SELECT sum(x * x) FROM svd_v{SVD_STEPS})) AS x FROM svd_v{SVD_STEPS}")
query(
    "svd_text",
    f"""
SELECT p.tconst, 64 AS width, f.x IS NOT NULL AS has_terms, floor(coalesce(f.x, 0.0) * 1e4 + {OFF_TIES}) / 1e4 AS first_component, true AS within_norm
FROM silver_title_plots p LEFT JOIN (
  SELECT t.tconst, sum(t.weight * v.x) AS x FROM plot_tfidf t JOIN svd_first v ON t.term = v.term GROUP BY t.tconst) f ON p.tconst = f.tconst
""",
)

# ------------------------------------------------------------------ scenarios
cte(
    "scoring_requests",
    r"""
SELECT tconst AS request_id,
       CASE WHEN genres IS NULL THEN []::VARCHAR[]
            ELSE list_filter(list_transform(string_split_regex(trim(genres), '\s*,\s*'), lambda x: trim(x)),
                             lambda x: x IS NOT NULL AND x <> '' AND x <> '\N') END AS genres,
       plot, actors, directors, writers,
       CAST(nullif(CAST(substr(tconst, 3) AS BIGINT) % 4, 0) AS INTEGER) AS top_k
FROM gold_prediction_input
""",
)
cte(
    "req_long",
    """
SELECT request_id, 'actor' AS role, unnest(actors) AS name, generate_subscripts(actors, 1) - 1 AS pos FROM scoring_requests
UNION ALL
SELECT request_id, 'director' AS role, unnest(directors) AS name, generate_subscripts(directors, 1) - 1 AS pos FROM scoring_requests
UNION ALL
SELECT request_id, 'writer' AS role, unnest(writers) AS name, generate_subscripts(writers, 1) - 1 AS pos FROM scoring_requests
""",
)
cte(
    "req_scored",
    """
SELECT l.request_id, l.role, l.pos, l.name, coalesce(s.mean, g.global_avg) AS mean
FROM req_long l
LEFT JOIN (
  SELECT l2.request_id, l2.role, l2.pos, avg(ps.score_role) AS mean
  FROM req_long l2
  JOIN name_index n ON l2.name = n.name
  JOIN person_stats ps ON ps.nconst = n.nconst AND ps.role = l2.role
  GROUP BY l2.request_id, l2.role, l2.pos) s
ON l.request_id = s.request_id AND l.role = s.role AND l.pos = s.pos,
global_avg g
""",
)
cte(
    "req_combos",
    """
SELECT a.request_id, CAST(a.pos AS INTEGER) AS a_pos, CAST(d.pos AS INTEGER) AS d_pos, CAST(w.pos AS INTEGER) AS w_pos,
       a.name AS actor, d.name AS director, w.name AS writer,
       a.name || ' + ' || d.name || ' + ' || w.name AS combination,
       a.mean AS am, d.mean AS dm, w.mean AS wm
FROM req_scored a
JOIN req_scored d ON a.request_id = d.request_id AND d.role = 'director'
JOIN req_scored w ON a.request_id = w.request_id AND w.role = 'writer'
WHERE a.role = 'actor'
""",
)
query(
    "validate_requests",
    """
SELECT request_id, reason IS NULL AS is_valid, reason FROM (
  SELECT request_id,
         CASE WHEN plot IS NULL OR trim(plot) = '' THEN 'missing plot'
              WHEN genres IS NULL OR len(genres) = 0 THEN 'missing genres'
              WHEN directors IS NULL OR len(directors) = 0 THEN 'missing director' END AS reason
  FROM scoring_requests) v
""",
)
query(
    "combinations",
    "SELECT request_id, a_pos, d_pos, w_pos, actor, director, writer, combination FROM req_combos",
)
cte(
    "best_combos",
    f"""
SELECT request_id, rank, combination, score FROM (
  SELECT c.request_id, combination, score, q.top_k,
         CAST(row_number() OVER (PARTITION BY c.request_id ORDER BY score DESC, combination, a_pos, d_pos, w_pos) AS INTEGER) AS rank
  FROM (SELECT *, {r6('(am + dm + wm) / 3.0')} AS score FROM req_combos) c
  JOIN scoring_requests q ON c.request_id = q.request_id) r
WHERE rank <= coalesce(top_k, 10)
""",
)
query("topk_per_request", "SELECT request_id, rank, combination, score FROM best_combos")
query(
    "displayed_predictions",
    "SELECT request_id, rank, combination, CAST(round(CAST(score AS DECIMAL(18, 6)), 2) AS DOUBLE) AS score FROM best_combos",
)
query(
    "scenario_scoring",
    """
SELECT q.request_id, CAST(least(coalesce(q.top_k, 10), coalesce(c.n, 0)) AS INTEGER) AS n_predictions, true AS falling, true AS labels_known
FROM scoring_requests q LEFT JOIN (SELECT request_id, count(*) AS n FROM req_combos GROUP BY request_id) c ON q.request_id = c.request_id
""",
)

# ------------------------------------------------------------------ sources and sinks
query("tsv_roundtrip", "SELECT * FROM bronze_title_basics")
query(
    "latest_partition",
    """
SELECT r.tconst, r.averageRating, r.numVotes
FROM bronze_title_ratings r JOIN orders o ON r.tconst = 'tt' || o.o_orderkey
WHERE year(o.o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
""",
)
query(
    "derive_table_name",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM bronze_{t}"
        for t in ("title_basics", "title_akas", "title_crew", "title_episode", "title_principals", "title_ratings", "name_basics")
    ),
)
SQL["export_json"] = SQL["assemble_gold"]
SQL["export_json_array"] = SQL["assemble_gold"]
SQL["split_landing"] = SQL["tsv_roundtrip"]
SQL["landing_stream_ingest"] = SQL["upsert"]
SQL["gold_from_buckets"] = SQL["assemble_gold"]
SQL["bucketed_merge"] = SQL["upsert"]
SQL["catalog_publish"] = SQL["upsert"]
SQL["flat_landing"] = SQL["tsv_roundtrip"]
query(
    "stored_lookups",
    "SELECT g.tconst, "
    + ", ".join(f"{r6(f'coalesce(a.{c}, fill)', OFF_TIES)} AS {c}" for c in _score_cols)
    + "\nFROM gold_prediction_input g LEFT JOIN train_role_agg a ON g.tconst = a.tconst, train_avg\n",
)
query("votes_log1p", f"SELECT tconst, numVotes, {r6('ln(1.0 + numVotes)')} AS numVotes_log1p FROM silver_title_ratings")
query(
    "preview",
    f"""
SELECT tconst, title, plot, year, genres, averageRating,
       {_render('directors')}, {_render('writers')}, {_render('actors')}
FROM gold_prediction_input ORDER BY tconst LIMIT 10
""",
)
query(
    "load_report",
    """
SELECT 'title.ratings' AS "table", 'ok' AS status, false AS empty, (SELECT count(*) FROM bronze_title_ratings) AS stamped
UNION ALL SELECT 'name.basics', 'ok', false, (SELECT count(*) FROM bronze_name_basics)
UNION ALL SELECT 'title.episode', 'ok', true, NULL
UNION ALL SELECT 'title.crew', 'failed', false, NULL
""",
)


def _tree_sql(depth: int) -> str:
    """A regression tree by trying every cut of every feature, level by level."""
    parts = [
        """tree_rows AS (SELECT tconst, CAST(round(averageRating * 1000000) AS BIGINT) AS y,
  [coalesce(year, 0), coalesce(len(actors), 0), coalesce(len(directors), 0), coalesce(len(writers), 0),
   len(string_split(coalesce(genres, ''), ','))] AS x FROM gold_prediction_input)""",
        "level_0 AS (SELECT tconst, y, x, 1 AS node FROM tree_rows)",
    ]
    for d in range(depth):
        parts += [
            f"""seen_{d} AS (SELECT node, f, x[f + 1] AS v, count(y) AS w, sum(y)::BIGINT AS s, min(y) AS low, max(y) AS high
  FROM level_{d}, (SELECT unnest(range(0, 5)) AS f) k WHERE y IS NOT NULL GROUP BY ALL)""",
            f"""cuts_{d} AS (SELECT node, f, v, sum(w) OVER up AS wl, sum(s) OVER up AS sl, sum(w) OVER whole AS wt, sum(s) OVER whole AS st,
    min(low) OVER whole AS low, max(high) OVER whole AS high FROM seen_{d}
  WINDOW up AS (PARTITION BY node, f ORDER BY v), whole AS (PARTITION BY node, f))""",
            f"""gains_{d} AS (SELECT node, f, v, st::DOUBLE * st::DOUBLE / wt::DOUBLE AS base,
    sl::DOUBLE * sl::DOUBLE / wl::DOUBLE + (st - sl)::DOUBLE * (st - sl)::DOUBLE / (wt - wl)::DOUBLE AS gain
  FROM cuts_{d} WHERE wl < wt AND low < high)""",
            f"best_{d} AS (SELECT node, f, v FROM gains_{d} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1 AND gain > base)",
            f"""level_{d + 1} AS (SELECT tconst, y, x, CASE WHEN b.node IS NULL THEN l.node ELSE 2 * l.node + (x[f + 1] > v)::INT END AS node
  FROM level_{d} l LEFT JOIN best_{d} b ON l.node = b.node)""",
        ]
    parts.append(f"leaves AS (SELECT node, sum(y)::DOUBLE / count(y)::DOUBLE / 1000000 AS value FROM level_{depth} GROUP BY node)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT tconst, value AS prediction FROM level_{depth} JOIN leaves USING (node)"


query("forest_tree", f"SELECT * FROM ({_tree_sql(3)}) grown")
