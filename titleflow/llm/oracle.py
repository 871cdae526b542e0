"""DuckDB SQL of the queries that SQL can express (column names as in ``queries``)."""

from __future__ import annotations

from titleflow.llm import quality_rules as rules

#: The six ASCII blanks and the only letters with a lower-case form here.
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_sql(source: str, min_docs: int = 10) -> str:
    """CTEs ending in ``kept_lines(rid, n_lines, n_dropped, kept)`` over ``source(rid, text)``."""
    return f"""
split_lines AS (SELECT rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM {source}),
line_rows AS (SELECT rid, i, ls[i] AS line, translate(trim(ls[i], {BLANKS}), '{UPPER}', '{LOWER}') AS k
  FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS i FROM split_lines)),
frequent_keys AS (SELECT k FROM line_rows WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= {min_docs}),
marked_lines AS (SELECT l.rid, l.i, l.line, f.k IS NOT NULL AS gone FROM line_rows l LEFT JOIN frequent_keys f ON l.k = f.k),
kept_lines AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM marked_lines GROUP BY rid)"""


OP10 = f"""
WITH rowed AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents), {lines_sql("rowed")}
SELECT r.doc_id, k.n_lines, k.n_dropped, sha256(k.kept) AS kept_sha256 FROM rowed r JOIN kept_lines k USING (rid)"""


def rules_sql(source: str) -> str:
    """CTEs ending in ``judged(rid, counts, base_failed, kept)`` over ``source(rid, text, lang, source)``."""
    sub, bits = rules.SUB, rules.SUB_BITS
    features = {
        "f_marks": ("n_marks", "n_words"),
        "f_dup_line": ("n_dup_lines", "n_lines"),
        "f_repeat": ("n_repeat_words", "n_words"),
        "f_upper": ("n_upper", "word_chars"),
        "f_word_len": ("word_chars", "n_words"),
    }
    made = ", ".join(f"CASE WHEN {b} > 0 THEN 1000 * {a} // {b} ELSE 0 END AS {f}" for f, (a, b) in features.items())
    long = " UNION ALL ".join(f"SELECT lang, source, '{f}' AS feature, {f} AS v FROM featured" for f in features)
    marks = rules.MARKS.replace("'", "''")

    def by_feature(part: str) -> str:
        return "CASE feature " + " ".join(f"WHEN '{f}' THEN {getattr(fence, part)}" for f, fence in rules.FEATURES.items()) + " END"

    tops = f"(((b - e * {sub} + 1) << e) - 1)"
    per = "OVER (PARTITION BY lang, source, feature"

    outlier = " OR ".join(
        f"({f} > {f}_hi)" + (f" OR ({f} < {f}_lo)" if fence.both else "")
        for f, fence in rules.FEATURES.items()
    )
    wide = ", ".join(f"max(hi) FILTER (WHERE feature = '{f}') AS {f}_hi, max(lo) FILTER (WHERE feature = '{f}') AS {f}_lo" for f in features)
    return rf"""
worded AS (SELECT rid, lang, source, coalesce(text, '') AS t, {WORDS} AS ws, string_split(coalesce(text, ''), chr(10)) AS ls FROM {source}),
word_rows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM worded)),
twice AS (SELECT rid, g FROM word_rows GROUP BY rid, g HAVING count(*) > 1),
repeated AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM word_rows JOIN twice USING (rid, g), (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
line_copies AS (SELECT rid, sum(n - 1) AS n_dup_lines FROM (SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(ls) AS line FROM worded)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line) GROUP BY rid),
counted AS (SELECT w.rid, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines, length(t) - length(translate(t, '{UPPER}', '')) AS n_upper,
  length(t) - length(translate(t, '{marks}', '')) AS n_marks
  FROM worded w LEFT JOIN repeated USING (rid) LEFT JOIN line_copies USING (rid)),
featured AS (SELECT *, {made} FROM counted),
long_features AS ({long}),
bucketed AS (SELECT lang, source, feature, (e * {sub} + (v >> e)) AS b, count(*) AS n
  FROM (SELECT *, greatest(length(bin(v)) - {bits + 1}, 0) AS e FROM long_features) GROUP BY ALL),
corpus_bucketed AS (SELECT feature, b, sum(n) AS n FROM bucketed GROUP BY feature, b),
sizes AS (SELECT feature, sum(n) AS size FROM corpus_bucketed GROUP BY feature),
leaning AS (SELECT lang, source, feature, b, sum(n) AS n FROM (
    SELECT lang, source, feature, b, n * size AS n FROM bucketed JOIN sizes USING (feature)
    UNION ALL SELECT lang, source, feature, b, n * {rules.PRIOR} FROM (SELECT DISTINCT lang, source, feature FROM bucketed) JOIN corpus_bucketed USING (feature))
  GROUP BY ALL),
running AS (SELECT lang, source, feature, {tops} AS top, sum(n) {per} ORDER BY b) AS upto, sum(n) {per}) AS total
  FROM (SELECT *, greatest(b // {sub} - 1, 0) AS e FROM leaning)),
drawn AS (SELECT lang, source, feature, min(top) FILTER (WHERE upto * 100 >= total * {by_feature("low")}) AS low,
  min(top) FILTER (WHERE upto * 100 >= total * {by_feature("high")}) AS high FROM running GROUP BY lang, source, feature),
fence AS (SELECT lang, source, feature, low - gap AS lo, high + gap AS hi
  FROM (SELECT *, greatest((high - low) * {by_feature("spread")}, {by_feature("floor")}) AS gap FROM drawn)),
fence_row AS (SELECT lang, source, {wide} FROM fence GROUP BY lang, source),
based AS (SELECT f.*, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PCT} * n_words AS base_failed FROM featured f),
judged AS (SELECT b.*, NOT base_failed AND NOT ({outlier}) AS kept
  FROM based b JOIN fence_row r ON b.lang IS NOT DISTINCT FROM r.lang AND b.source IS NOT DISTINCT FROM r.source)"""


OP5 = f"""
WITH rowed AS (SELECT row_number() OVER () AS rid, doc_id, text, lang, source FROM documents), {rules_sql("rowed")}
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM rowed r JOIN judged j USING (rid)"""

TERMS = rf"translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), '{UPPER}', '{LOWER}')"

OP11 = f"""
WITH word_rows AS (SELECT rid, doc_id, {TERMS} AS term FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
counted AS (SELECT rid, doc_id, term, count(*) AS tf FROM word_rows GROUP BY ALL),
doc_sizes AS (SELECT rid, sum(tf)::BIGINT AS n FROM counted GROUP BY rid),
corpus AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM doc_sizes),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, corpus GROUP BY term),
impacts AS (SELECT c.rid, c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))) AS impact
  FROM counted c JOIN doc_sizes USING (rid) JOIN weights USING (term), corpus),
asked AS (SELECT qid, item_id, {TERMS} AS term FROM (SELECT row_number() OVER () AS qid, item_id, text FROM benchmark)),
scored AS (SELECT qid, item_id, rid, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""

#: crc32 of the id's digits, a bit at a time (-1 stands for one shift); fixed values: the polynomial and both ends.
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT],
  flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END), 4294967295::BIGINT)"""

OP13 = f"""
WITH hashed AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS ws, {CRC32} AS h FROM documents),
aimed AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a, 3 + (h // 10) % 8 AS d FROM hashed),
planted AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
  THEN list_select(ws, list_concat(range(1, a + 1), list_transform(range(0, n - a), lambda i: a + 1 + i % (1 + (n - a) // d)))) ELSE ws END AS ws FROM aimed),
word_at AS (SELECT rid, unnest(range(0, n)) AS i, unnest(ws) AS w FROM planted),
usual AS (SELECT rid, i, w FROM word_at QUALIFY count(*) OVER (PARTITION BY rid, w) >= 4),
same AS (SELECT x.rid, x.i, y.i - x.i AS q FROM usual x JOIN usual y ON x.rid = y.rid AND x.w = y.w AND x.i < y.i),
stretch AS (SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM same)
  GROUP BY rid, q, island HAVING count(*) >= 3 * q AND count(*) + q >= 6),
runs AS (SELECT rid, start, length, min(q) AS period FROM stretch GROUP BY rid, start, length),
best AS (SELECT rid, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length::DOUBLE / period DESC, start, period) = 1),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS t FROM word_at ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM planted p LEFT JOIN listed l USING (rid) LEFT JOIN best b USING (rid) LEFT JOIN kept k USING (rid)"""

SQL: dict[str, str] = {"op5_quality_rules": OP5, "op10_line_dedup": OP10, "op11_ranked_search": OP11, "op13_periodic_runs": OP13}
