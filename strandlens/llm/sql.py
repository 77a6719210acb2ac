"""What SQL can say of the corpus operators, in DuckDB's dialect, for the driver's comparison on small tables."""

from __future__ import annotations

from . import centroids, filter_audit, mixing
from .secret_scan import ACCESS, ASSIGN_LEFT, ASSIGN_VALUE, COPIED_OWNERS, COPIED_REPOS, HEX, LIVE_CHARACTERS


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _kind(number: int, pattern: str, least: int, left: str) -> str:
    value = f"regexp_replace(hit, '^{_quoted(left)}', '')" if left else "hit"
    return f"""SELECT doc_id, repo, {number} AS kind, e - length(hit) AS s, e, e - length(v) AS vs, v FROM (
      SELECT doc_id, repo, hit, {value} AS v, e FROM (
        SELECT doc_id, repo, regexp_extract(piece, '{_quoted(pattern)}') AS hit, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS e
        FROM (SELECT doc_id, repo, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM (
          SELECT doc_id, coalesce(source, '') AS repo, regexp_extract_all(coalesce(text, ''), '(?s).*?(?:{_quoted(pattern)})', 0) AS p FROM documents))))
    WHERE length(v) >= {least}"""


NAMES = "['assign', 'access', 'hex', 'live'][kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
SECRETS = f"""
WITH found AS ({_kind(0, ASSIGN_LEFT + ASSIGN_VALUE, 12, ASSIGN_LEFT)} UNION ALL {_kind(1, ACCESS, 18, "")} UNION ALL {_kind(2, HEX, 16, "")}),
held AS (SELECT v, count(DISTINCT split_part(repo, '/', 1)) AS n_owners, count(DISTINCT repo) AS n_repos FROM found GROUP BY 1),
owned AS (SELECT *, n_owners >= {COPIED_OWNERS} AND n_repos >= {COPIED_REPOS} AS copied FROM held),
judged AS (SELECT f.*, n_owners, n_repos, NOT copied AND len(list_distinct(string_split(v, ''))) >= {LIVE_CHARACTERS} AS live, copied FROM found f JOIN owned USING (v)),
spans AS (SELECT doc_id, kind, s, e FROM judged UNION SELECT doc_id, 3, vs, e FROM judged WHERE live),
base AS (SELECT doc_id, string_agg({NAMES}, ',' ORDER BY s, kind) AS t FROM judged GROUP BY 1),
every AS (SELECT doc_id, string_agg({NAMES}, ',' ORDER BY s, kind, e) AS t FROM spans GROUP BY 1),
counts AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE copied) AS n_copied, max(n_owners) AS most_owners, max(n_repos) AS most_repos FROM judged GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base.t, '')) AS base_sha256,
  coalesce(every.t, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied,
  coalesce(most_owners, 0) AS most_owners, coalesce(most_repos, 0) AS most_repos
FROM documents d LEFT JOIN base ON base.doc_id = d.doc_id LEFT JOIN every ON every.doc_id = d.doc_id LEFT JOIN counts ON counts.doc_id = d.doc_id
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
each AS (SELECT doc_id, len(w) AS n, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM words),
threes AS (SELECT doc_id, n, i, a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o AS s FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
sets AS (SELECT DISTINCT doc_id, s FROM threes WHERE s IS NOT NULL UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) IN (1, 2)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c.n >= 85 * (p.n + q.n - c.n)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, y FROM reach JOIN links ON x = reach.r),
least AS (SELECT d, min(r) AS c FROM reach GROUP BY 1)
SELECT d AS doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, c = d AS kept FROM least LEFT JOIN sizes ON doc_id = d
"""

REPEATED_PASSAGES = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
each AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM words),
wins AS (SELECT *, string_agg(a, ' ') OVER o AS k, count(*) OVER o AS n FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
later AS (SELECT doc_id, i, a, n = 20 AND row_number() OVER (PARTITION BY CASE WHEN n = 20 THEN k END ORDER BY doc_id, i) > 1 AS rep FROM wins),
covered AS (SELECT doc_id, i, a, bool_or(rep) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM later),
per AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(a, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM covered GROUP BY 1)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents d LEFT JOIN per ON per.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": SECRETS, "op3_near_duplicates": NEAR_DUPLICATES, "op6_temperature_mixing": mixing.sql(), "op9_repeated_passages": REPEATED_PASSAGES, "op11_centroid_clusters": centroids.sql(), "op13_filter_audit": filter_audit.sql()}
