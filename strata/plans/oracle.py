"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark plans from the operator semantics;
the tables are the driver's views. Parameters come from ``params`` so
both sides use the same values.
"""

from __future__ import annotations

from strata.plans import params as P


def _str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_str(v) if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)


TERMS_CTE = ("terms(term, pos) AS (VALUES "
             + _values((t, i) for i, t in enumerate(P.DOC_TERMS)) + ")")

HAS_TERM = "list_contains(string_split(d.text, ' '), t.term)"

SQL: dict[str, str] = {}

SQL["term_count"] = f"""
SELECT {_str(P.COUNT_TERM)} AS term,
       CAST(count(*) FILTER (WHERE list_contains(string_split(text, ' '), {_str(P.COUNT_TERM)})) AS BIGINT) AS n
FROM documents
"""

SQL["term_rank"] = f"""
WITH {TERMS_CTE}
SELECT t.term, CAST(count(*) AS BIGINT) AS n
FROM documents d JOIN terms t ON {HAS_TERM}
GROUP BY t.term
ORDER BY n DESC, t.term
"""

SQL["term_rank_all"] = f"""
WITH {TERMS_CTE}
SELECT t.term, CAST(count(*) FILTER (WHERE {HAS_TERM}) AS BIGINT) AS n
FROM terms t CROSS JOIN documents d
GROUP BY t.term
ORDER BY n DESC, t.term
"""

# every two-letter lowercase word, with the document count of each
SQL["term_rank_vocabulary"] = """
WITH letters AS (SELECT chr(CAST(97 + i AS INTEGER)) AS c FROM range(26) t(i)),
vocab AS (SELECT a.c || b.c AS term FROM letters a CROSS JOIN letters b),
toks AS (SELECT DISTINCT doc_id_row, tok FROM (
           SELECT row_number() OVER () AS doc_id_row, unnest(string_split(text, ' ')) AS tok
           FROM documents)),
counts AS (SELECT tok AS term, count(*) AS n FROM toks GROUP BY tok)
SELECT v.term, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM vocab v LEFT JOIN counts c USING (term)
ORDER BY n DESC, v.term
"""

SQL["inverted_index"] = f"""
WITH {TERMS_CTE}
SELECT t.term, d.doc_id
FROM documents d JOIN terms t ON {HAS_TERM}
"""

SQL["indexed_articles"] = f"""
WITH {TERMS_CTE}
SELECT d.doc_id, t.term, d.text, d.lang, d.source, d.n_chars
FROM documents d JOIN terms t ON {HAS_TERM}
"""

SQL["posting_lists"] = f"""
WITH {TERMS_CTE},
idx AS (SELECT t.term, d.doc_id FROM documents d JOIN terms t ON {HAS_TERM})
SELECT term, CAST(floor(doc_id / {P.POSTING_BLOCK}) AS BIGINT) AS block,
       CAST(count(*) AS BIGINT) AS n,
       string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids
FROM idx
GROUP BY term, CAST(floor(doc_id / {P.POSTING_BLOCK}) AS BIGINT)
"""

SQL["rank_from_index"] = SQL["term_rank"]
SQL["rank_from_posting_lists"] = SQL["term_rank"]

# --- survey time use ------------------------------------------------------
# events pivoted per user: view t010101, click t050101, purchase t120101,
# signup t180101, error t180501; telfs/tesex/teage from the user id.
# Groups by prefix: primary = t180101, t010101 (reverse header order),
# work = t180501, t050101, other = t120101.

def _minutes(kind: str, name: str) -> str:
    return (f"CAST(sum(CASE WHEN event_type = {_str(kind)} THEN CAST(value AS DECIMAL(18,2)) "
            f"ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS {name}")


SURVEY_CTE = f"""survey AS (
  SELECT CAST(user_id AS VARCHAR) AS tucaseid,
         CAST(user_id % 5 + 1 AS DOUBLE) AS telfs,
         CAST(user_id % 2 + 1 AS DOUBLE) AS tesex,
         CAST(user_id % 60 + 15 AS DOUBLE) AS teage,
         {_minutes('view', 't010101')},
         {_minutes('click', 't050101')},
         {_minutes('purchase', 't120101')},
         {_minutes('signup', 't180101')},
         {_minutes('error', 't180501')}
  FROM events GROUP BY user_id),
summary AS (
  SELECT CASE WHEN telfs < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage >= 15 AND teage <= 22 THEN 'young'
              WHEN teage >= 23 AND teage <= 55 THEN 'active'
              ELSE 'elder' END AS age,
         ((CAST(0 AS DOUBLE) + t180101) + t010101) / CAST(60 AS DOUBLE) AS primaryNeeds,
         ((CAST(0 AS DOUBLE) + t180501) + t050101) / CAST(60 AS DOUBLE) AS work,
         (CAST(0 AS DOUBLE) + t120101) / CAST(60 AS DOUBLE) AS other
  FROM survey WHERE telfs <= 4)"""

SQL["time_use_summary"] = f"WITH {SURVEY_CTE}\nSELECT * FROM summary"
SQL["typed_rows"] = SQL["time_use_summary"]
SQL["time_use_grouped"] = f"""WITH {SURVEY_CTE}
SELECT working, sex, age,
       round(avg(primaryNeeds), 1) AS primaryNeeds,
       round(avg(work), 1) AS work,
       round(avg(other), 1) AS other
FROM summary GROUP BY working, sex, age ORDER BY working, sex, age"""
SQL["time_use_grouped_sql"] = SQL["time_use_grouped"]
SQL["time_use_grouped_typed"] = SQL["time_use_grouped"]

# --- questions and answers --------------------------------------------------
# questions = orders (id o_orderkey, score floor(o_totalprice/1000), tag
# o_orderpriority); answers = lineitem (id l_orderkey*100+l_linenumber,
# parent l_orderkey, score floor(l_extendedprice/100)-500).

POSTINGS_CTE = """q AS (
  SELECT 1 AS posting_type, o_orderkey AS id, CAST(NULL AS BIGINT) AS accepted_answer,
         CAST(NULL AS BIGINT) AS parent_id, CAST(floor(o_totalprice / 1000) AS INTEGER) AS score,
         o_orderpriority AS tags
  FROM orders),
a AS (
  SELECT 2 AS posting_type, l_orderkey * 100 + l_linenumber AS id, l_orderkey AS parent_id,
         CAST(floor(l_extendedprice / 100) - 500 AS INTEGER) AS score
  FROM lineitem)"""

BEST_CTE = POSTINGS_CTE + """,
top AS (SELECT parent_id, max(score) AS top FROM a GROUP BY parent_id),
best AS (
  SELECT q.posting_type, q.id, q.accepted_answer, q.parent_id, q.score, q.tags,
         greatest(top.top, 0) AS high_score
  FROM (SELECT DISTINCT * FROM q) q JOIN top ON q.id = top.parent_id)"""

SQL["answered_questions"] = f"""WITH {POSTINGS_CTE}
SELECT q.id, q.score, q.tags, a.id AS a_id, a.score AS a_score
FROM q JOIN a ON q.id = a.parent_id"""

SQL["nested_answers"] = f"""WITH {POSTINGS_CTE}
SELECT q.id, a.id // {P.ANSWER_BLOCK} AS block, CAST(count(*) AS BIGINT) AS n,
       string_agg(CAST(a.id AS VARCHAR) || ':' || CAST(a.score AS VARCHAR), ',' ORDER BY a.id, a.score) AS answers
FROM q JOIN a ON q.id = a.parent_id
GROUP BY q.id, a.id // {P.ANSWER_BLOCK}"""

SQL["best_answer"] = f"WITH {BEST_CTE}\nSELECT * FROM best"
# --- clustering -------------------------------------------------------------

_CAT_LIST = "[" + ", ".join(_str(c) for c in P.CATEGORIES) + "]"
_KEY = f"md5(CAST(id AS VARCHAR) || '#{P.SEED}')"


def _nearest(points: str, centers: str) -> str:
    """arg-min over centers by squared distance, ties to the lowest index."""
    return (f"arg_min({centers}.cluster, (({points}.x - {centers}.x) * ({points}.x - {centers}.x)"
            f" + ({points}.y - {centers}.y) * ({points}.y - {centers}.y)) * 1000 + {centers}.cluster)")


def _vectors(categories=P.CATEGORIES, spread: int = P.SPREAD,
             rows: str = "SELECT id, tags, high_score FROM best") -> str:
    case = "CASE tags " + " ".join(f"WHEN {_str(c)} THEN {i}" for i, c in enumerate(categories)) + " END"
    return BEST_CTE + f""",
vectors AS (
  SELECT id, CAST(({case}) * {spread} AS BIGINT) AS x, CAST(high_score AS BIGINT) AS y
  FROM ({rows}) WHERE ({case}) IS NOT NULL)"""


def _seeds(kernels: int) -> str:
    return f"""
  SELECT x, y, id, CAST(rank AS INTEGER) AS rank FROM (
    SELECT x, y, id, row_number() OVER (PARTITION BY x ORDER BY {_KEY}, id, y) AS rank
    FROM vectors) WHERE rank <= {kernels // len(P.CATEGORIES)}"""


SEEDS, MANY_SEEDS = _seeds(P.KERNELS), _seeds(P.MANY_KERNELS)
GLOBAL_SEEDS = f"""
  SELECT x, y, id, CAST(row_number() OVER (ORDER BY {_KEY}, id, x, y) AS INTEGER) AS rank
  FROM vectors QUALIFY rank <= {P.KERNELS}"""


def _kmeans(vectors: str, seeds: str = SEEDS, order: str = "x, rank", cap: int = P.MAX_ITERATIONS) -> str:
    return vectors + f""",
seeds AS ({seeds}),
centers0 AS (
  SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS cluster, x, y FROM seeds),
points AS (SELECT x, y, count(*) AS n FROM vectors GROUP BY x, y),
km(it, cluster, old_x, old_y, x, y, d, total) AS (
  SELECT 0, cluster, x, y, x, y, CAST(0 AS DOUBLE), CAST('inf' AS DOUBLE) FROM centers0
  UNION ALL
  SELECT it, cluster, old_x, old_y, x, y, d, sum(d) OVER () FROM (
    SELECT k.it + 1 AS it, k.cluster, k.x AS old_x, k.y AS old_y,
           coalesce(m.x, k.x) AS x, coalesce(m.y, k.y) AS y,
           CAST(coalesce(m.x, k.x) - k.x AS DOUBLE) * CAST(coalesce(m.x, k.x) - k.x AS DOUBLE)
           + CAST(coalesce(m.y, k.y) - k.y AS DOUBLE) * CAST(coalesce(m.y, k.y) - k.y AS DOUBLE) AS d
    FROM km k LEFT JOIN (
      SELECT cluster, CAST(sum(x * n) // sum(n) AS BIGINT) AS x,
             CAST(sum(y * n) // sum(n) AS BIGINT) AS y
      FROM (SELECT p.x, p.y, p.n, {_nearest('p', 'c')} AS cluster
            FROM points p CROSS JOIN km c GROUP BY p.x, p.y, p.n)
      GROUP BY cluster) m ON m.cluster = k.cluster
    WHERE k.total >= {P.ETA} AND k.it < {cap})),
final AS (SELECT cluster, x, y FROM km WHERE it = (SELECT max(it) FROM km))"""


VECTORS_CTE, KMEANS_CTE = _vectors(), _kmeans(_vectors())
HISTORY = ("SELECT it AS iter, cluster, old_x, old_y, x AS new_x, y AS new_y, d AS dist "
           "FROM km WHERE it >= 1")

SQL["category_vectors"] = f"WITH {_vectors(P.KNOWN_CATEGORIES)}\nSELECT id, x, y FROM vectors"
SQL["weighted_points"] = (f"WITH {VECTORS_CTE}\n"
                          "SELECT x, y, count(*) AS n FROM vectors GROUP BY x, y")
SQL["seed_points_per_category"] = f"WITH {VECTORS_CTE}\nSELECT x, y, id, rank FROM ({SEEDS})"
SQL["seed_points_global"] = f"""WITH {VECTORS_CTE}
SELECT x, y, id FROM vectors ORDER BY {_KEY}, id, x, y LIMIT {P.KERNELS}"""
SQL["nearest_center"] = f"""WITH RECURSIVE {KMEANS_CTE},
v AS (SELECT row_number() OVER () AS pk, id, x, y FROM vectors)
SELECT v.id, v.x, v.y, {_nearest('v', 'c')} AS cluster
FROM v CROSS JOIN centers0 c GROUP BY v.pk, v.id, v.x, v.y"""
SQL["kmeans_step"] = f"WITH RECURSIVE {KMEANS_CTE}\nSELECT cluster, x, y FROM km WHERE it = 1"
SQL["kmeans_centers"] = f"WITH RECURSIVE {KMEANS_CTE}\nSELECT cluster, x, y FROM final"
SQL["kmeans_history"] = f"WITH RECURSIVE {KMEANS_CTE}\n{HISTORY}"
SQL["kmeans_global_sample"] = "WITH RECURSIVE " + _kmeans(
    _vectors(spread=P.NARROW_SPREAD), GLOBAL_SEEDS, "rank") + "\nSELECT cluster, x, y FROM final"
SQL["kmeans_capped"] = "WITH RECURSIVE " + _kmeans(VECTORS_CTE, cap=P.FEW_ITERATIONS) + "\n" + HISTORY
SQL["kmeans_signed"] = "WITH RECURSIVE " + _kmeans(_vectors(
    rows="SELECT a.id, q.tags, a.score AS high_score FROM q JOIN a ON q.id = a.parent_id")) \
    + "\nSELECT cluster, x, y FROM final"

MANY_CTE = _kmeans(VECTORS_CTE, MANY_SEEDS)


def _report(kmeans: str) -> str:
    return kmeans + f""",
v AS (SELECT row_number() OVER () AS pk, x, y FROM vectors),
asg AS (SELECT v.x, v.y, {_nearest('v', 'c')} AS cluster
        FROM v CROSS JOIN final c GROUP BY v.pk, v.x, v.y),
stats AS (SELECT cluster, CAST(count(*) AS BIGINT) AS size,
                 CAST(trunc(quantile_cont(y, 0.5)) AS BIGINT) AS median_score
          FROM asg GROUP BY cluster),
modes AS (SELECT cluster, x, cnt FROM (
            SELECT cluster, x, count(*) AS cnt,
                   row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, x) AS r
            FROM asg GROUP BY cluster, x) WHERE r = 1),
report AS (
  SELECT {_CAT_LIST}[x // {P.SPREAD} + 1] AS label,
         CAST(cnt AS DOUBLE) * 100.0 / CAST(size AS DOUBLE) AS percent,
         size, median_score
  FROM stats JOIN modes USING (cluster))"""


REPORT_CTE = _report(KMEANS_CTE)
SQL["cluster_report"] = f"""WITH RECURSIVE {REPORT_CTE}
SELECT * FROM report ORDER BY median_score, label, size"""
SQL["cluster_report_lines"] = f"""WITH RECURSIVE {REPORT_CTE}
SELECT printf('%7d  %-17s (%-5.1f%%)      %7d', median_score, label, percent, size) AS line
FROM report"""

# --- through files --------------------------------------------------------------
# what is written and read again must equal what the tables give

SQL["time_use_grouped_aggregated"] = SQL["time_use_grouped"]
SQL["cluster_report_from_text"] = SQL["cluster_report"]
SQL["stored_index_lookup"] = SQL["inverted_index"]
SQL["stored_index_rank"] = SQL["term_rank"]
SQL["stored_index_vocabulary"] = SQL["term_rank_vocabulary"].replace(
    "LEFT JOIN", "JOIN")
SQL["articles_from_text"] = "SELECT doc_id, text FROM documents"
SQL["article_positions"] = """
SELECT count(*) AS articles, count(*) AS lines, count(*) AS ids, CAST(0 AS BIGINT) AS gaps,
       CAST(0 AS BIGINT) AS scattered
FROM documents"""
SQL["article_rejects"] = """
SELECT 'no line: ' || n_name AS line, true AS in_bad_file FROM nation
UNION ALL SELECT CAST(count(*) AS VARCHAR), false FROM documents"""
_FLAT_TERMS = f"""{TERMS_CTE},
flat AS (SELECT translate(text, chr(13) || chr(10) || '<', '   ') AS text FROM documents
         WHERE text IS NOT NULL),
ranked AS (SELECT t.term, CAST(count(*) FILTER (WHERE {HAS_TERM}) AS BIGINT) AS n
           FROM terms t CROSS JOIN flat d GROUP BY t.term)"""
SQL["term_popularity_from_text"] = f"""
WITH {_FLAT_TERMS}
SELECT 'all' AS ranking, term, n FROM ranked
UNION ALL SELECT 'index', term, n FROM ranked WHERE n > 0
UNION ALL SELECT 'reduction', term, n FROM ranked WHERE n > 0"""
SQL["ranking_file"] = f"""
WITH ranked AS ({SQL["term_rank"]})
SELECT row_number() OVER (ORDER BY n DESC, term) - 1 AS pos, '(' || term || ',' || n || ')' AS line
FROM ranked"""
SQL["answered_questions_from_text"] = SQL["answered_questions"]
SQL["posting_rejects"] = """
SELECT 'no line: ' || n_name AS line, 'no-postings' AS folder FROM nation
UNION ALL SELECT CAST(count(*) AS VARCHAR), 'postings'
FROM (SELECT 1 FROM orders UNION ALL SELECT 1 FROM lineitem)"""
# fixed values: the report's heading
_HEADING = ("Resulting clusters:", "  Score  Dominant language (%percent)  Questions",
            "================================================")
SQL["cluster_report_file"] = f"""WITH RECURSIVE {REPORT_CTE},
heading(pos, line) AS (VALUES {_values(enumerate(_HEADING))})
SELECT CAST(pos AS BIGINT) AS pos, line FROM heading
UNION ALL
SELECT row_number() OVER (ORDER BY median_score, label, size) + {len(_HEADING) - 1},
       printf('%7d  %-17s (%-5.1f%%)      %7d', median_score, label, percent, size)
FROM report"""
_SURVEY_COLUMNS = ("tucaseid", "telfs", "tesex", "teage", "t010101", "t050101", "t120101", "t180101", "t180501")
SQL["survey_rows_from_files"] = f"WITH {SURVEY_CTE}\nSELECT {', '.join(_SURVEY_COLUMNS)} FROM survey"
SQL["survey_schema"] = f"""
SELECT pos, name, CASE WHEN pos = 0 THEN 'string' ELSE 'double' END AS type, false AS nullable
FROM (VALUES {_values(enumerate(_SURVEY_COLUMNS))}) t(pos, name)"""
SQL["time_use_summary_from_files"] = SQL["time_use_summary"]
SQL["time_use_from_files"] = SQL["time_use_grouped"]
SQL["time_use_checked"] = SQL["time_use_grouped"]
# one of the headers in mid-file is the first line of its file
SQL["survey_rejects"] = f"""
WITH {SURVEY_CTE},
bad AS (
  SELECT n_name || repeat(',x', {len(_SURVEY_COLUMNS) - 1}) AS line FROM nation
  UNION ALL SELECT n_name || ',1.5' FROM nation
  UNION ALL SELECT '{",".join(_SURVEY_COLUMNS)}' FROM nation WHERE n_nationkey > 0)
SELECT line, true AS named FROM bad UNION ALL SELECT CAST(count(*) AS VARCHAR), true FROM survey"""

# --- the reference's number of clusters ---------------------------------------------

SQL["nearest_center_many"] = f"""WITH RECURSIVE {MANY_CTE},
v AS (SELECT row_number() OVER () AS pk, id, x, y FROM vectors)
SELECT v.id, v.x, v.y, {_nearest('v', 'c')} AS cluster
FROM v CROSS JOIN centers0 c GROUP BY v.pk, v.id, v.x, v.y"""
SQL["kmeans_centers_many"] = f"WITH RECURSIVE {MANY_CTE}\nSELECT cluster, x, y FROM final"
SQL["cluster_report_many"] = f"""WITH RECURSIVE {_report(MANY_CTE)}
SELECT * FROM report ORDER BY median_score, label, size"""
