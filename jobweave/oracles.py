"""The queries of `queries.py` in DuckDB SQL, written the direct way: pairs are listed and ranked, and
inputs that the engine decodes from text are taken from the tables they were made of."""

from __future__ import annotations

from . import standins as st

ORACLES: dict[str, str] = {}


def _posting_fields(key: str, title: str, seen: str) -> str:
    day = "DATE '2025-01-01' + p_size"
    return f"""
      CAST({key} AS VARCHAR) AS job_id, p_brand AS source_id, {title} AS title,
      CASE WHEN p_size % 7 = 0 THEN '' ELSE 'City ' || p_size END AS location,
      CASE p_size % 4 WHEN 0 THEN 'Staff' WHEN 1 THEN 'PERMANENT' WHEN 2 THEN 'Short-Term' ELSE p_type END AS contract_type,
      CASE ({key}) % 10 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'open until filled'
        WHEN 3 THEN strftime({day}, '%Y-%-m-%-d') WHEN 4 THEN strftime({day}, '%Y-%m-%d') || 'T00:00:00'
        ELSE strftime({day}, '%Y-%m-%d') END AS deadline,
      CASE WHEN ({key}) % 9 = 4 THEN '' ELSE p_type || ' ' || p_name || ' at ' || p_brand END AS description_raw,
      CASE WHEN ({key}) % 15 = 8 THEN '' ELSE '{st.BASE_URL}/vacancy/' || CAST({key} AS VARCHAR) END AS url,
      {seen} AS scraped_at"""


TITLE = "CASE p_partkey % 40 WHEN 7 THEN '' WHEN 23 THEN NULL ELSE p_name END"
STAMP = "TIMESTAMP '2024-01-01' + to_minutes(p_partkey)"
ISO = "'%Y-%m-%dT%H:%M:%S'"
NEW_KEY = "p_partkey + CASE WHEN l_returnflag = 'N' THEN 1000000000 ELSE 0 END"
DOMAIN = "@example.org"
SECOND = "'Brand#' || (CAST(split_part({b}, '#', 2) AS INTEGER) % 25 + 1)"
PROFILE_LIKE = "'Professional in ' || lower(c_mktsegment) || ' with customer number ' || c_custkey"

TAGS = """list_sort(list_filter((SELECT list(w) FROM words), lambda w: list_contains(
    string_split_regex(lower(coalesce(title, '') || ' ' || coalesce(description_raw, '')), '[^a-z0-9]+'), w)))"""

TABLES = {
    "one_board": f"SELECT {_posting_fields('p_partkey', TITLE, f'strftime({STAMP}, {ISO})')} FROM part",
    # Some ids are on two boards.
    "jobs": f"SELECT * FROM one_board UNION ALL SELECT * REPLACE ({SECOND.format(b='source_id')} AS source_id, replace(description_raw, ' at ' || source_id, ' at ' || {SECOND.format(b='source_id')}) AS description_raw) FROM one_board WHERE CAST(job_id AS BIGINT) % 50 = 3",
    "old_jobs": f"SELECT * EXCLUDE (source_id) REPLACE (CASE WHEN CAST(job_id AS BIGINT) % 21 <> 5 THEN CAST(scraped_at AS TIMESTAMP) END AS scraped_at) FROM one_board",
    "seen": f"""SELECT {_posting_fields(NEW_KEY, "p_name || ' v' || l_linenumber", f'strftime(l_shipdate, {ISO})')},
      l_orderkey AS seq, l_linenumber AS line FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "users": f"""SELECT CAST(c_custkey AS VARCHAR) AS user_id,
      CASE WHEN c_custkey % 23 <> 5 THEN 'c' || c_custkey || '{DOMAIN}' END AS email,
      CASE WHEN c_custkey % 29 = 3 THEN '' WHEN c_custkey % 31 <> 4 THEN c_name END AS name,
      CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 13 = 1 THEN ' ' || chr(9) || ' '
        WHEN c_custkey % 17 <> 2 THEN {PROFILE_LIKE} END AS profile_text,
      CASE WHEN c_custkey % 11 <> 0 THEN CAST(5 + c_custkey % 5 AS INTEGER) END AS score_threshold,
      CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 19 = 1 THEN CAST([] AS VARCHAR[])
        ELSE ['Brand#' || (c_custkey % 25 + 1), 'Brand#' || ((c_custkey * 7 + 3) % 25 + 1)] END AS enabled_sources,
      CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'notify' || c_custkey || '{DOMAIN}' END AS notification_email,
      c_acctbal > 0 AS verified,
      CASE WHEN NOT c_acctbal > 0 THEN 'token-' || c_custkey END AS verification_token,
      CAST(NULL AS VARCHAR) AS updated_at
      FROM customer""",
    "active": f"""SELECT * REPLACE (coalesce(score_threshold, 7) AS score_threshold,
      coalesce(enabled_sources, ['{st.DEFAULT_SOURCES[0]}']) AS enabled_sources) FROM users WHERE verified""",
    "log": f"""SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS job_id,
      CASE WHEN l_partkey % 50 = 3 AND l_linenumber % 2 = 1 THEN {SECOND.format(b='p_brand')} ELSE p_brand END AS source_id,
      CAST(CASE WHEN l_linenumber = 7 THEN 0 WHEN l_linenumber = 5 AND l_quantity > 45 THEN NULL
        ELSE (CAST(l_quantity AS INTEGER) - 1) % 10 + 1 END AS INTEGER) AS score,
      'Line ' || l_orderkey || '/' || l_linenumber AS summary,
      CASE WHEN l_linenumber = 4 AND l_quantity > 48 THEN NULL ELSE l_returnflag = 'R' END AS email_sent,
      l_shipdate AS evaluated_at, l_orderkey AS seq, l_linenumber AS line
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "evals": "SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY user_id, source_id, job_id ORDER BY evaluated_at DESC, seq DESC, line DESC, score DESC NULLS LAST, email_sent DESC NULLS LAST) = 1",
    "old_evals": "SELECT * EXCLUDE (user_id, source_id) FROM log QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY evaluated_at DESC, seq DESC, line DESC, score DESC NULLS LAST, email_sent DESC NULLS LAST) = 1",
    "subs": "SELECT DISTINCT user_id, unnest(enabled_sources) AS source_id FROM active",
    "boards": f"""SELECT source_id, n,
      CASE WHEN n % 5 <> 0 THEN 'Board ' || n || ' (B' || n || ')' END AS display_name,
      CASE WHEN n % 3 <> 0 THEN 'Board' || n END AS label,
      CASE WHEN n % 7 <> 0 THEN n % 4 <> 3 END AS enabled,
      CASE WHEN n % 5 <> 1 THEN n % 6 = 0 END AS enabled_by_default,
      CASE WHEN n % 3 <> 0 THEN '#0000' || lpad(CAST(n AS VARCHAR), 2, '0') END AS color,
      [['ring', 'Hot', 'LARGE', 'bolt', 'old w', 'gear'][1 + n % 6], ['ring', 'Hot', 'LARGE', 'bolt', 'old w', 'gear'][1 + (n + 2) % 6]] AS search_keywords
      FROM (SELECT DISTINCT p_brand AS source_id, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n FROM part)""",
    "full_boards": "SELECT source_id, coalesce(display_name, source_id) AS display_name, coalesce(label, upper(source_id)) AS label, coalesce(enabled, false) AS enabled, coalesce(enabled_by_default, false) AS enabled_by_default, coalesce(color, '#555555') AS color, search_keywords FROM boards",
    "requests": f"""SELECT o_orderkey AS request_id, 'acc-' || o_orderkey AS user_id,
      CASE o_orderkey % 17 WHEN 3 THEN 'no address' WHEN 4 THEN NULL
        ELSE CASE WHEN o_orderstatus = 'F' THEN 'c' ELSE 'new' END || o_custkey || '{DOMAIN}' END AS email,
      CASE o_orderkey % 19 WHEN 2 THEN '' WHEN 5 THEN repeat('n', 121) ELSE 'Person ' || o_custkey END AS name,
      CASE o_orderkey % 23 WHEN 1 THEN 'Too short' ELSE 'Interested in orders of priority ' || o_orderpriority END AS profile_text,
      CASE WHEN o_orderkey % 13 <> 6 THEN CAST(o_orderkey % 12 AS INTEGER) END AS score_threshold,
      CASE WHEN o_orderkey % 4 <> 1 THEN ['Brand#' || (o_orderkey % 30 + 1)] END AS enabled_sources
      FROM orders""",
    "checked": f"""SELECT *, list_filter([
        CASE WHEN NOT coalesce(regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$'), false) THEN 'email' END,
        CASE WHEN NOT length(name) BETWEEN 1 AND 120 THEN 'name' END,
        CASE WHEN NOT length(profile_text) BETWEEN 20 AND 10000 THEN 'profile_text' END,
        CASE WHEN NOT coalesce(score_threshold, 7) BETWEEN 1 AND 10 THEN 'score_threshold' END
      ], lambda r: r IS NOT NULL) AS reasons FROM requests""",
    "judged": """SELECT *, CASE WHEN len(reasons) > 0 THEN 'invalid'
        WHEN email IN (SELECT email FROM users WHERE email IS NOT NULL) THEN 'conflict'
        WHEN row_number() OVER (PARTITION BY email, len(reasons) = 0 ORDER BY request_id) > 1 THEN 'duplicate'
        ELSE 'accepted' END AS status FROM checked""",
    "changes": f"""SELECT o_orderkey AS request_id, CAST(o_custkey AS VARCHAR) AS user_id,
      CASE WHEN o_orderkey % 3 = 0 THEN 'Renamed ' || o_orderkey END AS name,
      CASE WHEN o_orderkey % 8 = 0 THEN 'short text' WHEN o_orderkey % 4 = 0 THEN 'A new profile from order ' || o_orderkey END AS profile_text,
      CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 14 AS INTEGER) END AS score_threshold,
      CASE WHEN o_orderkey % 2 = 0 THEN ['Brand#' || (o_orderkey % 25 + 1), 'Brand#' || (o_orderkey % 40 + 1)] END AS enabled_sources,
      CASE WHEN o_orderkey % 6 = 0 THEN 'n' || o_orderkey || '{DOMAIN}' END AS notification_email
      FROM orders""",
    "offenders": """SELECT request_id, list(DISTINCT s ORDER BY s) AS unknown FROM
      (SELECT request_id, unnest(enabled_sources) AS s FROM changes) WHERE s NOT IN (SELECT p_brand FROM part) GROUP BY request_id""",
    "judged_changes": """SELECT c.*, list_filter([
        CASE WHEN length(name) > 120 THEN 'name' END,
        CASE WHEN length(profile_text) NOT BETWEEN 20 AND 10000 THEN 'profile_text' END,
        CASE WHEN score_threshold NOT BETWEEN 1 AND 10 THEN 'score_threshold' END,
        CASE WHEN o.request_id IS NOT NULL THEN 'enabled_sources' END
      ], lambda r: r IS NOT NULL) AS reasons FROM changes c LEFT JOIN offenders o USING (request_id)""",
    "claims": f"""SELECT o_orderkey AS request_id,
      CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'sub-' || o_custkey END AS claim_id,
      CASE o_orderkey % 5 WHEN 1 THEN NULL WHEN 2 THEN '' ELSE 'c' || o_custkey || '{DOMAIN}' END AS email FROM orders""",
    "texts": f"""SELECT CAST(doc_id AS VARCHAR) AS job_id, source AS source_id, 'Text in ' || lang AS title,
      CASE WHEN doc_id % 6 <> 2 THEN 'Site ' || source END AS location, CAST(NULL AS VARCHAR) AS contract_type,
      '' AS deadline, text AS description_raw, '{st.BASE_URL}/doc/' || doc_id AS url FROM documents""",
    "runs": """SELECT min(ts) AS run_at, CASE WHEN day(d) % 5 = 0 THEN 'manual' ELSE 'scheduled' END AS trigger,
      count(*) AS jobs_in_db,
      CASE WHEN day(d) % 6 <> 0 THEN count(*) FILTER (event_type = 'signup' AND value > 40) ELSE 0 END AS new_jobs,
      count(*) FILTER (event_type = 'view') AS evaluated, count(*) FILTER (event_type = 'purchase') AS emails_sent,
      CASE WHEN day(d) % 7 <> 0 THEN CASE WHEN day(d) % 3 = 0
        THEN CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) % 60 ELSE CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) END END AS duration_s,
      CASE WHEN count(*) FILTER (event_type = 'error') % 4 = 0 THEN 'failed' ELSE 'ok' END AS status,
      'day ' || day(d) AS notes
      FROM (SELECT *, CAST(ts AS DATE) AS d FROM events) GROUP BY d""",
    # What each shape of answer must give; the scorer's text itself is never read here.
    "answers": """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, kind,
      CASE WHEN kind IN (3, 4, 5, 6, 7, 9, 11) THEN NULL WHEN kind = 8 THEN 1 WHEN s BETWEEN 1 AND 10 THEN s END AS score,
      CASE WHEN kind = 3 THEN 'score is not an integer' WHEN kind = 9 THEN 'score is not an integer'
        WHEN kind IN (4, 6, 7) THEN 'invalid JSON' WHEN kind = 5 THEN 'missing summary' WHEN kind = 11 THEN 'missing score'
        WHEN kind <> 8 AND s NOT BETWEEN 1 AND 10 THEN 'score out of bounds' END AS error
      FROM (SELECT *, CAST(l_quantity AS INTEGER) % 13 AS s, (l_orderkey * 7 + l_linenumber) % 16 AS kind FROM lineitem)""",
    "parsed": "SELECT *, CASE WHEN error IS NULL THEN 'Part ' || l_partkey END AS summary FROM answers",
    "messages": """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE (l_orderkey * 7 + l_linenumber) % 9 WHEN 0 THEN '429 PerDay limit used up' WHEN 1 THEN '429 Too Many Requests'
        WHEN 2 THEN 'Quota exceeded' WHEN 3 THEN 'could not generate text' WHEN 4 THEN 'limit_per_DAY reached'
        WHEN 5 THEN NULL WHEN 6 THEN 'Rate limit' ELSE 'connection reset' END AS message FROM lineitem""",
    "due": """SELECT e.user_id, j.source_id, e.job_id, e.score, e.summary FROM evals e
      JOIN active u ON e.user_id = u.user_id JOIN jobs j ON e.job_id = j.job_id AND e.source_id = j.source_id
      WHERE e.score >= u.score_threshold AND e.email_sent = false AND list_contains(u.enabled_sources, j.source_id)""",
    "fresh": "SELECT * FROM seen s WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.source_id = s.source_id AND j.job_id = s.job_id) QUALIFY row_number() OVER (PARTITION BY source_id, job_id ORDER BY scraped_at DESC, seq DESC, line DESC) = 1",
    "stub": "SELECT source_id, job_id, CASE WHEN line = 2 THEN job_id || chr(10) || 'Closed Job' WHEN line = 3 THEN 'TRK' || job_id ELSE '  ' || title || ' ' END AS title, location, contract_type, deadline FROM seen QUALIFY row_number() OVER (PARTITION BY source_id, job_id ORDER BY scraped_at DESC, seq DESC, line DESC) = 1",
    # What the detail page of each part says.
    "details": f"""SELECT p_partkey AS page_id, '{st.BASE_URL}/vacancy/' || p_partkey AS url, p_name || ' <' || p_brand || '>' AS title, 'City ' || p_size AS location,
      CASE WHEN p_partkey % 5 <> 2 THEN p_type ELSE '' END AS contract_type, '' AS deadline,
      CASE WHEN p_partkey % 6 < 3 THEN '' ELSE
        CASE WHEN p_partkey % 4 < 2 THEN p_name || ' <' || p_brand || '>' || chr(10) ELSE '' END || 'City ' || p_size || chr(10)
        || CASE WHEN p_partkey % 5 <> 2 THEN p_type || chr(10) ELSE '' END END
      || 'Work on ' || p_name || chr(10) || 'at ' || p_brand AS description_raw FROM part""",
    "matched": """SELECT j.*, s.job_id IS NOT NULL AS matched,
      CASE WHEN s.job_id IS NOT NULL THEN s.title ELSE d.title END AS new_title, CASE WHEN s.job_id IS NOT NULL THEN s.location ELSE d.location END AS new_location,
      CASE WHEN s.job_id IS NOT NULL THEN s.contract_type ELSE d.contract_type END AS new_contract_type,
      CASE WHEN s.job_id IS NOT NULL THEN s.deadline ELSE d.deadline END AS new_deadline, d.description_raw AS new_description_raw
      FROM (SELECT * FROM jobs WHERE title IS NULL OR title = '') j LEFT JOIN stub s USING (source_id, job_id) LEFT JOIN details d ON d.url = j.url""",
    "patched": """SELECT *,
      CASE WHEN trim(coalesce(title, '')) = '' AND trim(coalesce(new_title, '')) <> '' AND new_title NOT LIKE '%Closed Job%' AND new_title NOT LIKE 'TRK%' THEN trim(new_title) ELSE title END AS patched_title,
      CASE WHEN trim(coalesce(location, '')) = '' AND trim(coalesce(new_location, '')) <> '' THEN trim(new_location) ELSE location END AS patched_location,
      CASE WHEN trim(coalesce(contract_type, '')) = '' AND trim(coalesce(new_contract_type, '')) <> '' THEN trim(new_contract_type) ELSE contract_type END AS patched_contract_type,
      CASE WHEN trim(coalesce(deadline, '')) = '' AND trim(coalesce(new_deadline, '')) <> '' THEN trim(new_deadline) ELSE deadline END AS patched_deadline,
      CASE WHEN trim(coalesce(description_raw, '')) = '' AND coalesce(new_description_raw, '') <> '' THEN new_description_raw ELSE description_raw END AS patched_description_raw
      FROM matched""",
    "flagged": "SELECT *, (patched_title IS DISTINCT FROM title OR patched_location IS DISTINCT FROM location OR patched_contract_type IS DISTINCT FROM contract_type OR patched_deadline IS DISTINCT FROM deadline OR patched_description_raw IS DISTINCT FROM description_raw) AS changed FROM patched",
    "words": "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part",
    "job_tags": f"SELECT source_id, job_id, {TAGS} AS tags FROM jobs",
    "user_tags": """SELECT CAST(c_custkey AS VARCHAR) AS user_id,
      CASE WHEN c_custkey % 9 = 4 OR p_name IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_distinct(string_split(p_name, ' ')) END AS tags
      FROM customer LEFT JOIN part ON p_partkey = c_custkey""",
    "feed": """SELECT s.user_id, j.*, e.score, e.summary FROM subs s JOIN jobs j USING (source_id)
      LEFT JOIN evals e ON e.user_id = s.user_id AND e.job_id = j.job_id AND e.source_id = j.source_id""",
    "ranked": "SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC NULLS LAST, source_id, job_id) AS INTEGER) AS position, count(*) OVER (PARTITION BY user_id) AS total FROM feed",
    "detail": f"""SELECT j.*, e.score, e.email_sent, TRY_CAST(TRY_STRPTIME(substr(deadline, 1, 10), '%Y-%m-%d') AS DATE) AS deadline_date
      FROM old_jobs j LEFT JOIN old_evals e USING (job_id)""",
}


def _needed(sql: str, found: dict[str, str]) -> dict[str, str]:
    """Table definitions that `sql` refers to, in the order of TABLES."""
    import re

    for name, body in TABLES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            found[name] = body
            _needed(body, found)
    return found


def _oracle(name: str, sql: str) -> None:
    used = _needed(sql, {})
    ctes = ", ".join(f"{t} AS ({TABLES[t]})" for t in TABLES if t in used)
    if ctes:
        start = next((w for w in ("WITH RECURSIVE ", "WITH ") if sql.startswith(w)), None)
        sql = f"{start}{ctes}, {sql[len(start):]}" if start else f"WITH {ctes} {sql}"
    ORACLES[name] = sql


POSTING = "source_id, job_id, title, location, contract_type, deadline, description_raw, url, scraped_at"

_oracle("known_ids", "SELECT DISTINCT source_id, job_id FROM jobs")
_oracle("jobs_for_sources", f"SELECT {POSTING} FROM jobs WHERE source_id IN ('Brand#3', 'Brand#14', 'Brand#21')")
_oracle("user_lookup", """WITH wanted AS (SELECT DISTINCT 'user_id' AS by, claim_id AS key FROM claims UNION ALL SELECT DISTINCT 'email', email FROM requests
    UNION ALL SELECT DISTINCT 'verification_token', 'token-' || claim_id FROM claims),
  accounts AS (SELECT 'user_id' AS by, user_id AS key, * FROM users UNION ALL SELECT 'email', email, * FROM users UNION ALL SELECT 'verification_token', verification_token, * FROM users)
  SELECT w.by, w.key, a.user_id AS account, a.name, a.verified FROM wanted w LEFT JOIN accounts a ON w.by = a.by AND w.key = a.key""")
_oracle("source_registry", "SELECT source_id, display_name, enabled, enabled_by_default, color, CASE WHEN enabled THEN enabled_by_default END AS preselected FROM full_boards")
_oracle("extract_payload", f"""SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_name AS title,
  CASE WHEN p_partkey % 8 <> 3 THEN 'City ' || p_size ELSE '' END AS location, p_type AS contract_type, '' AS deadline,
  CASE WHEN p_partkey % 3 = 2 THEN 'https://other.example.net/' || p_partkey ELSE '{st.BASE_URL}/vacancy/' || p_partkey || '?a=1&b=2' END AS url
  FROM part WHERE p_partkey % 33 <> 9""")
_oracle("extract_listing_rows", f"""SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_name || ' & Söhne' AS title,
  'City' || chr(10) || p_size AS location, CASE WHEN p_partkey % 6 <> 5 THEN p_type ELSE '' END AS contract_type,
  CASE WHEN p_partkey % 6 <> 5 THEN '2025-02-' || p_size ELSE '' END AS deadline,
  '{st.BASE_URL}/v/' || p_partkey || '?a=1&b=2' AS url FROM part WHERE p_partkey % 33 <> 9""")
_oracle("extract_metadata", "SELECT page_id, title, location, contract_type, deadline, description_raw FROM details")
_oracle("insert_if_absent", f"""SELECT {POSTING} FROM seen s WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.source_id = s.source_id AND j.job_id = s.job_id)
  QUALIFY row_number() OVER (PARTITION BY source_id, job_id ORDER BY scraped_at, seq, line) = 1""")
_oracle("upsert_jobs", f"""SELECT {POSTING} FROM (SELECT {POSTING}, seq, line, 1 AS fresh FROM seen UNION ALL SELECT {POSTING}, 0, 0, 0 FROM jobs)
  QUALIFY row_number() OVER (PARTITION BY source_id, job_id ORDER BY fresh DESC, scraped_at DESC, seq DESC, line DESC) = 1""")
_oracle("upsert_evaluations", f"""SELECT user_id, source_id, job_id, score, summary, email_sent, strftime(evaluated_at, {ISO}) AS evaluated_at FROM log
  QUALIFY row_number() OVER (PARTITION BY user_id, source_id, job_id ORDER BY coalesce(email_sent, false), evaluated_at DESC, seq DESC, line DESC, score DESC NULLS LAST, email_sent DESC NULLS LAST) = 1""")
_oracle("upsert_users", """SELECT id, email, name FROM (
    SELECT coalesce(CASE WHEN request_id % 2 = 0 THEN CAST(request_id % 50000 AS VARCHAR) END, email, '') AS id, email, name, request_id FROM requests
    UNION ALL SELECT user_id, email, name, -1 FROM users)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY request_id DESC) = 1""")
REACHABLE = "user_id IN (SELECT user_id FROM active WHERE coalesce(notification_email, '') <> '' OR coalesce(email, '') <> '')"
_oracle("mark_sent", f"""SELECT user_id, source_id, job_id, score,
  CASE WHEN (user_id, source_id, job_id) IN (SELECT (user_id, source_id, job_id) FROM due WHERE {REACHABLE}) THEN true ELSE email_sent END AS email_sent FROM evals""")
_oracle("reset_evaluations", "SELECT count(*) AS n_cleared FROM evals")
_oracle("migrate_jobs", f"""SELECT 'legacy|' || job_id AS id, job_id, 'legacy' AS source_id, coalesce(title, '') AS title, location, contract_type,
  coalesce(deadline, '') AS deadline, description_raw, url, coalesce(strftime(scraped_at, {ISO}), '{st.RUN_AT}') AS scraped_at FROM old_jobs""")
_oracle("migrate_evaluations", f"""SELECT 'owner|' || job_id AS id, 'owner' AS user_id, job_id, 'legacy' AS source_id, score, summary,
  coalesce(email_sent, false) AS email_sent, strftime(evaluated_at, {ISO}) AS evaluated_at FROM old_evals WHERE score <> 0""")
_oracle("normalize_jobs", f"""SELECT job_id, 'board' AS source_id, coalesce(title, '') AS title, location, contract_type, coalesce(deadline, '') AS deadline,
  description_raw, '' AS url, coalesce(strftime(scraped_at, {ISO}), '{st.RUN_AT}') AS scraped_at FROM old_jobs""")
_oracle("composite_keys", "SELECT source_id || '|' || job_id AS id, 'posting' AS kind FROM jobs UNION ALL SELECT user_id || '|' || source_id || '|' || job_id, 'evaluation' FROM evals")
_oracle("merge_extras", """SELECT source_id || '|' || job_id AS id, CASE WHEN CAST(job_id AS INTEGER) % 3 = 0 THEN 'own title' ELSE title END AS title, location,
  CASE CAST(job_id AS INTEGER) % 3 WHEN 0 THEN 'P4' WHEN 1 THEN job_id END AS grade,
  CAST(CASE CAST(job_id AS INTEGER) % 3 WHEN 2 THEN 10 ELSE 11 END AS INTEGER) AS n_fields FROM jobs""")
_oracle("build_prompts", f"""SELECT job_id, source_id, 'Candidate:' || chr(10) || 'Somebody who reads and writes long texts' || chr(10) || chr(10) || 'Posting:' || chr(10)
  || 'board: ' || upper(source_id) || chr(10) || 'position: ' || title || chr(10) || 'place: ' || coalesce(location, 'not given') || chr(10)
  || 'kind of contract: not given' || chr(10) || 'open until: ' || chr(10) || 'link: ' || url || chr(10) || chr(10)
  || description_raw || chr(10) || chr(10)
  || 'Rate from 1 to 10 how well the posting fits the candidate and describe the role in a few sentences. Answer with one JSON object: {{"score": <1-10>, "summary": "<text>"}}.' AS prompt
  FROM texts""")
LISTED = "array_to_string(enabled_sources, ',') AS enabled_sources"
_oracle("profile_view", f"SELECT user_id, email, name, score_threshold, {LISTED}, verified FROM users")
_oracle("profile_patch", f"""SELECT u.user_id, coalesce(c.name, u.name) AS name, coalesce(c.profile_text, u.profile_text) AS profile_text,
  coalesce(c.score_threshold, u.score_threshold) AS score_threshold,
  array_to_string(coalesce(c.enabled_sources, u.enabled_sources), ',') AS enabled_sources,
  coalesce(c.notification_email, u.notification_email) AS notification_email,
  CASE WHEN c.request_id IS NOT NULL THEN '{st.RUN_AT}' END AS updated_at FROM users u LEFT JOIN
  (SELECT * FROM judged_changes WHERE len(reasons) = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY request_id DESC) = 1) c ON c.user_id = u.user_id""")
_oracle("register_accounts", f"""SELECT request_id, user_id, status, CASE WHEN status = 'accepted' THEN email END AS email,
  CASE WHEN status = 'accepted' THEN coalesce(score_threshold, 7) END AS score_threshold,
  CASE WHEN status = 'accepted' THEN array_to_string(coalesce(enabled_sources, ['{st.DEFAULT_SOURCES[0]}']), ',') END AS enabled_sources,
  CASE WHEN status = 'accepted' THEN email END AS notification_email, CASE WHEN status = 'accepted' THEN false END AS verified,
  CASE WHEN status = 'accepted' THEN '{st.RUN_AT}' END AS created_at FROM judged""")
_oracle("verify_accounts", """SELECT user_id, verified OR coalesce(hit, false) AS verified, CASE WHEN NOT coalesce(hit, false) THEN verification_token END AS verification_token
  FROM users LEFT JOIN (SELECT DISTINCT 'token-' || claim_id AS token, true AS hit FROM claims) ON token = verification_token""")
_oracle("active_users", f"SELECT user_id, email, score_threshold, {LISTED} FROM active")
_oracle("pending_alerts", "SELECT job_id, score, summary, title, url FROM old_evals JOIN old_jobs USING (job_id) WHERE score >= 7 AND email_sent = false")
_oracle("feed_min_score", """SELECT user_id, position, job_id, source_id, coalesce(title, '') AS title, location, contract_type, coalesce(deadline, '') AS deadline, url,
  score, summary, scraped_at, total, CAST(greatest(ceil(total / 20.0), 1) AS BIGINT) AS n_pages FROM
  (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, source_id, job_id) AS INTEGER) AS position, count(*) OVER (PARTITION BY user_id) AS total
   FROM feed WHERE score >= 7) WHERE position <= 20""")
_oracle("unevaluated_jobs", """SELECT DISTINCT s.source_id, s.job_id FROM seen s LEFT JOIN old_evals e USING (job_id) WHERE e.job_id IS NULL OR e.score = 0""")
_oracle("empty_jobs", "SELECT source_id, job_id, title FROM jobs WHERE title = '' OR title IS NULL")
_oracle("feed_source_filter", """SELECT DISTINCT user_id, unnest(CASE WHEN asked <> '' AND list_contains(enabled_sources, asked) THEN [asked] ELSE enabled_sources END) AS source_id FROM
  (SELECT *, CASE WHEN CAST(user_id AS INTEGER) % 2 = 0 THEN enabled_sources[2] ELSE 'Brand#' || (CAST(user_id AS INTEGER) % 26) END AS asked FROM active)""")
_oracle("scorable_users", """SELECT user_id, trim(coalesce(profile_text, ''), ' ' || chr(9)) AS profile_text,
  CASE WHEN trim(coalesce(profile_text, ''), ' ' || chr(9)) = '' THEN 'no profile text' END AS reject_reason FROM users""")
_oracle("validate_accounts", "SELECT request_id, array_to_string(reasons, ',') AS reasons FROM checked")
_oracle("validate_updates", "SELECT request_id, array_to_string(reasons, ',') AS reasons FROM judged_changes")
_oracle("keyword_match", """SELECT source_id, job_id, string_agg(DISTINCT w, ',' ORDER BY w) AS keywords FROM
  (SELECT j.*, unnest(b.search_keywords) AS w FROM jobs j JOIN boards b USING (source_id))
  WHERE contains(lower(coalesce(title || ' ', '') || description_raw), lower(w)) GROUP BY source_id, job_id""")
_oracle("new_jobs", "SELECT source_id, job_id, title, scraped_at FROM fresh")
_oracle("seen_flag", "SELECT DISTINCT s.source_id, s.job_id, j.job_id IS NOT NULL AS seen FROM seen s LEFT JOIN jobs j ON s.source_id = j.source_id AND s.job_id = j.job_id")
_oracle("user_job_candidates", "SELECT user_id, source_id, count(*) AS n_postings FROM subs JOIN jobs USING (source_id) GROUP BY ALL")
_oracle("evaluation_worklist", """SELECT s.user_id, s.source_id, count(*) AS n_todo FROM subs s JOIN jobs j USING (source_id)
  WHERE NOT EXISTS (SELECT 1 FROM evals e WHERE e.user_id = s.user_id AND e.source_id = j.source_id AND e.job_id = j.job_id) GROUP BY ALL""")
_oracle("worklist_summary", """WITH settled AS (SELECT * FROM evals WHERE score IS NULL OR score <> 0),
  pairs AS (SELECT s.user_id, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM settled e WHERE e.user_id = s.user_id AND e.source_id = j.source_id AND e.job_id = j.job_id)) AS todo
    FROM subs s JOIN jobs j USING (source_id) GROUP BY 1),
  done AS (SELECT user_id, count(*) AS n FROM settled GROUP BY 1)
  SELECT a.user_id, coalesce(p.n, 0) AS n_candidates, coalesce(d.n, 0) AS n_evaluated, coalesce(p.todo, 0) AS n_todo
  FROM active a LEFT JOIN pairs p USING (user_id) LEFT JOIN done d USING (user_id)""")
_oracle("user_feed", """SELECT user_id, position, job_id, source_id, coalesce(title, '') AS title, location, contract_type, coalesce(deadline, '') AS deadline, url,
  score, summary, scraped_at FROM ranked WHERE position <= 100""")
_oracle("feed_page", """SELECT user_id, position, job_id, source_id, score, total, CAST(greatest(ceil(total / 25.0), 1) AS BIGINT) AS n_pages
  FROM ranked WHERE position BETWEEN 51 AND 75""")
COLOR = "CASE WHEN d.score >= 9 THEN '#2e7d32' WHEN d.score >= 7 THEN '#1565c0' WHEN d.score >= 5 THEN '#e65100' ELSE '#b71c1c' END"
_oracle("digest_lines", f"""SELECT d.user_id, CAST(row_number() OVER (PARTITION BY d.user_id ORDER BY d.score DESC, d.source_id, d.job_id) AS INTEGER) AS line_no,
  d.source_id, d.job_id, d.score, b.label AS source_label, {COLOR} AS color, coalesce(title, 'Unknown Position') AS title,
  CASE WHEN coalesce(title, '') = '' THEN 'Position Closed' ELSE title END AS card_title,
  CASE WHEN location = '' THEN 'Not specified' ELSE location END AS location, contract_type,
  CASE WHEN coalesce(deadline, '') = '' THEN 'Not specified' ELSE deadline END AS deadline, url,
  '[' || b.label || '] ' || coalesce(title, 'N/A') || ' — Score ' || d.score || '/10' AS headline, coalesce(d.summary, '') AS short_summary
  FROM due d JOIN jobs j USING (source_id, job_id) JOIN full_boards b USING (source_id)""")
_oracle("user_digest", f"""SELECT user_id, recipient, '[{st.PRODUCT}] ' || n_matches || ' job match' || CASE WHEN n_matches = 1 THEN '' ELSE 'es' END || ' — ' || source_labels AS subject,
  'Hi ' || coalesce(CASE WHEN name <> '' THEN name END, email, 'there') || ' — ' || n_matches || ' new match' || CASE WHEN n_matches = 1 THEN '' ELSE 'es' END || ' from ' || source_labels AS greeting,
  n_matches, best_score, source_labels FROM
  (SELECT user_id, count(*) AS n_matches, max(score) AS best_score, string_agg(DISTINCT label, ', ' ORDER BY label) AS source_labels FROM due JOIN full_boards USING (source_id) GROUP BY user_id)
  JOIN (SELECT *, CASE WHEN notification_email <> '' THEN notification_email ELSE email END AS recipient FROM active) USING (user_id) WHERE recipient IS NOT NULL""")
_oracle("identity_resolve", """SELECT c.request_id, c.claim_id, c.email, coalesce(i.user_id, m.user_id) AS user_id,
  CASE WHEN i.user_id IS NOT NULL THEN 'id' WHEN m.user_id IS NOT NULL THEN 'email' END AS resolved_by
  FROM claims c LEFT JOIN users i ON c.claim_id = i.user_id LEFT JOIN users m ON c.email = m.email""")
_oracle("backfill_match", "SELECT source_id, job_id, matched, new_title FROM matched")
_oracle("backfill_patch", "SELECT source_id, job_id, changed, patched_title, patched_location, patched_contract_type, patched_deadline, patched_description_raw FROM flagged")
_oracle("backfill_diff", " UNION ALL ".join(
    f"SELECT source_id, job_id, '{f}' AS field, {f} AS old, patched_{f} AS new FROM patched WHERE patched_{f} IS DISTINCT FROM {f}"
    for f in ("title", "location", "contract_type", "deadline")))
_oracle("backfill_summary", "SELECT count(*) AS n_empty, count(*) FILTER (matched) AS n_matched, count(*) FILTER (changed) AS n_patched FROM flagged")
_oracle("report_kpis", """SELECT count(*) AS total, count(score) AS evaluated, count(*) FILTER (email_sent) AS sent, round(avg(score), 6) AS avg_score,
  count(*) FILTER (score >= 9) AS n_top FROM detail""")
_oracle("audit_counts", """SELECT (SELECT count(*) FROM jobs) AS n_jobs, count(*) AS n_evaluations, count(*) FILTER (score > 0) AS n_scored,
  count(*) FILTER (email_sent = true) AS n_sent FROM evals""")
_oracle("new_by_source", "SELECT source_id, count(*) AS n_new FROM fresh GROUP BY 1 UNION ALL SELECT '(all)', count(*) FROM fresh")
BEST = "(SELECT job_id, score FROM old_evals WHERE score > 0 ORDER BY score DESC, seq, line, job_id LIMIT 1)"
_oracle("best_match", f"SELECT job_id AS best_job_id, score AS best_score FROM {BEST}")
_oracle("run_summary", f"""SELECT (SELECT count(*) FROM jobs) + n AS jobs_in_db, n AS new_jobs, evaluated, emails_sent, job_id AS best_job_id, score AS best_score,
  'scheduled' AS trigger, n || ' new job(s); best: ' || job_id || ' (' || score || '/10)' AS notes FROM {BEST},
  (SELECT count(*) AS n FROM fresh), (SELECT count(*) AS evaluated, count(*) FILTER (email_sent) AS emails_sent FROM old_evals WHERE score IS NOT NULL)""")
KIND = """CASE WHEN {m} IS NULL THEN NULL WHEN contains({m}, 'PerDay') OR contains(lower({m}), 'per_day') THEN 'daily_quota'
  WHEN contains({m}, '429') OR contains(lower({m}), 'quota') OR contains(lower({m}), 'rate') THEN 'quota' ELSE 'other' END"""
_oracle("quota_cutoff", f"""SELECT user_id, l_orderkey, l_linenumber, l_partkey, error,
  CASE WHEN sum(CASE WHEN {KIND.format(m='error')} = 'daily_quota' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY l_orderkey, l_linenumber, l_partkey, error NULLS FIRST) > 0 THEN 'stopped'
    WHEN error IS NULL THEN 'evaluated' ELSE 'failed' END AS state FROM
  (SELECT CAST(l_orderkey % 997 AS VARCHAR) AS user_id, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 11 = 0 THEN message END AS error FROM messages)""")
_oracle("latest_evaluations", f"SELECT user_id, source_id, job_id, score, summary, email_sent, strftime(evaluated_at, {ISO}) AS evaluated_at FROM evals")
CONTRACT = "CASE WHEN lower(contract_type) IN ('staff', 'permanent') THEN 'staff' WHEN lower(contract_type) = 'short-term' THEN 'short-term' ELSE 'other' END"
DAYS = f"date_diff('day', DATE '{st.AS_OF}', deadline_date)"
SHOWN = "CASE WHEN coalesce(deadline, '') = '' THEN '—' ELSE substr(deadline, 1, 10) END"
_oracle("report_detail", f"""SELECT job_id, title, score, coalesce(score, -1) AS score_key,
  CAST(CASE WHEN score IS NULL THEN -1 WHEN email_sent THEN 1 ELSE 0 END AS INTEGER) AS sent_key,
  CASE WHEN score IS NULL THEN 'unevaluated' WHEN score >= 9 THEN 'excellent' WHEN score >= 7 THEN 'good' ELSE 'low' END AS score_band,
  CASE WHEN score IS NOT NULL THEN {CONTRACT} END AS contract_class, {SHOWN} AS deadline_text,
  coalesce({DAYS} <= 7, false) AS is_soon, coalesce({DAYS} < 0, false) AS is_expired FROM detail""")
_oracle("report_sorted", "SELECT job_id, title, score, strftime(deadline_date, '%Y-%m-%d') AS deadline_day FROM detail")
RUN_TIME = "strftime(run_at, '%Y-%m-%dT%H:%M:%S.%f')"
_oracle("run_history_top", f"SELECT CASE WHEN {RUN_TIME} LIKE '%.000000' THEN strftime(run_at, {ISO}) ELSE {RUN_TIME} END AS run_at, trigger, jobs_in_db, new_jobs, evaluated, emails_sent, status, notes FROM runs ORDER BY runs.run_at DESC, notes LIMIT 10")
_oracle("run_history_fmt", """SELECT strftime(run_at, '%Y-%m-%d %H:%M') AS run_at_text, trigger AS trigger_text, jobs_in_db,
  CASE WHEN new_jobs > 0 THEN '+' || new_jobs || ' new' ELSE 'none' END AS new_text, evaluated, emails_sent,
  CASE WHEN duration_s IS NULL THEN '—' WHEN duration_s < 60 THEN printf('%.1f s', duration_s)
    ELSE CAST(floor(duration_s / 60) AS BIGINT) || ' m ' || lpad(CAST(CAST(floor(duration_s % 60) AS BIGINT) AS VARCHAR), 2, '0') || ' s' END AS duration_text,
  CASE WHEN status = 'ok' THEN 'ok' ELSE 'error' END AS status_text, notes FROM runs""")
_oracle("latest_jobs", "SELECT job_id, title, scraped_at FROM jobs ORDER BY scraped_at DESC, job_id LIMIT 20")
_oracle("audit_listing", f"SELECT job_id, score, email_sent, strftime(evaluated_at, {ISO}) AS evaluated_at FROM old_evals")
_oracle("carry_over", """SELECT min(source_id) AS source_id, job_id FROM (SELECT source_id, job_id FROM fresh UNION SELECT source_id, job_id FROM jobs)
  WHERE job_id NOT IN (SELECT job_id FROM old_evals WHERE score IS NULL OR score <> 0) GROUP BY job_id""")
_oracle("unknown_sources", "SELECT request_id, array_to_string(unknown, ',') AS unknown FROM offenders")
_oracle("ingest_all_sources", f"""SELECT * FROM (VALUES ('parts', 'loaded'), ('texts', 'loaded'), ('crawl', 'loaded'), ('planned', 'placeholder'), ('broken', 'failed'), ('offline', 'failed'), ('off', 'disabled')) s(source_id, status)
  LEFT JOIN (SELECT 'parts' AS source_id, count(*) AS n_records, count(*) FILTER (coalesce(title, '') <> '') AS n_titled, count(*) FILTER (scraped_at IS NULL) AS n_stamped FROM old_jobs
    UNION ALL SELECT 'texts', count(*), count(*), count(*) FROM documents
    UNION ALL SELECT 'crawl', count(*), 0, count(*) FROM (SELECT DISTINCT source_id, job_id FROM seen)) USING (source_id)""")
_oracle("source_health", """SELECT source_id, count(s.job_id) AS n_records, count(s.job_id) = 0 AS is_silent FROM
  (SELECT source_id FROM full_boards WHERE enabled UNION ALL SELECT n_name FROM nation WHERE n_regionkey > 0) LEFT JOIN seen s USING (source_id) GROUP BY source_id""")
_oracle("parse_responses", "SELECT l_orderkey, l_linenumber, l_partkey, score, summary, error FROM parsed")
_oracle("classify_errors", f"""SELECT *, CAST(CASE error_class WHEN 'daily_quota' THEN 0 WHEN 'quota' THEN 65 WHEN 'other' THEN 2 END AS INTEGER) AS wait_s
  FROM (SELECT *, {KIND.format(m='message')} AS error_class FROM messages)""")
_oracle("score_bands", f"""SELECT user_id, source_id, job_id, score,
  CASE WHEN score IS NULL THEN 'unevaluated' WHEN score >= 9 THEN 'excellent' WHEN score >= 7 THEN 'good' ELSE 'low' END AS report_band,
  CASE WHEN score IS NOT NULL THEN {COLOR.replace('d.', '')} END AS mail_color,
  CASE WHEN score IS NULL THEN 'pending' WHEN score >= 8 THEN 'high' WHEN score >= 5 THEN 'mid' ELSE 'low' END AS dashboard_band,
  CASE WHEN score IS NULL THEN 'Pending' ELSE score || '/10' END AS dashboard_label,
  CASE WHEN score IS NULL THEN NULL WHEN score >= 9 THEN 'Excellent match' WHEN score >= 7 THEN 'Good match' WHEN score >= 5 THEN 'Partial match' WHEN score >= 3 THEN 'Weak match' ELSE 'Poor match' END AS meaning FROM evals""")
_oracle("deadline_status", f"""SELECT job_id, {SHOWN} AS deadline_text, CAST({DAYS} AS INTEGER) AS days_left, coalesce({DAYS} <= 7, false) AS is_soon, coalesce({DAYS} < 0, false) AS is_expired
  FROM (SELECT *, CAST(TRY_STRPTIME(substr(deadline, 1, 10), '%Y-%m-%d') AS DATE) AS deadline_date FROM jobs)""")
_oracle("contract_class", f"SELECT job_id, {CONTRACT} AS contract_class FROM jobs")
_oracle("source_labels", """SELECT source_id, label, short_name, color, 'x' || short_name AS nested_name FROM
  (SELECT source_id, label, color, trim(split_part(display_name, '(', 1)) AS short_name FROM full_boards)""")
_oracle("alert_messages", f"""SELECT job_id, score, {COLOR.replace('d.', '')} AS color, '[{st.PRODUCT}] Score ' || score || '/10 — ' || coalesce(title, 'New Job Match') AS subject,
  '{st.PRODUCT} Job Match — Score ' || score || '/10' || chr(10) || chr(10) || 'Title: ' || coalesce(title, 'New Job Match') || chr(10) || 'Location: ' || location || chr(10)
  || 'Contract: ' || contract_type || chr(10) || 'Deadline: ' || coalesce(deadline, 'N/A') || chr(10) || chr(10) || 'Why it matches:' || chr(10) || summary || chr(10) || chr(10) || 'Apply here: ' || url AS body
  FROM old_evals JOIN old_jobs USING (job_id) WHERE score >= 7 AND email_sent = false""")
_oracle("failure_alerts", f"""SELECT strftime(w, {ISO}) AS window_start, strftime(w + INTERVAL 2 HOUR, {ISO}) AS window_end, count(*) AS n_failures FROM
  (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM events WHERE event_type = 'error') GROUP BY w""")
_oracle("failure_alerts_stream", ORACLES["failure_alerts"])
_oracle("weekly_activity", f"""SELECT strftime(date_trunc('week', ts - INTERVAL 8 HOUR) + INTERVAL 8 HOUR, {ISO}) AS week_start, event_type, count(*) AS n_events FROM events GROUP BY ALL""")
_oracle("stream_ingest", """SELECT 'Brand#' || (l_suppkey % 25 + 1) AS source_id, CAST(l_partkey AS VARCHAR) AS job_id, strftime(min(l_shipdate), '%Y-%m-%d') AS first_seen FROM lineitem GROUP BY ALL""")
_oracle("tag_jobs", f"SELECT source_id, job_id, array_to_string({TAGS}, ',') AS tags FROM fresh")
_oracle("tag_distribution", "SELECT tag, count(*) AS n_postings FROM (SELECT unnest(tags) AS tag FROM job_tags) GROUP BY 1")
_oracle("tag_match", """SELECT user_id, CAST(greatest(1, ceil(10.0 * m / n)) AS INTEGER) AS score, m || '/' || n || ' tags matched' AS label, count(*) AS n_postings
  FROM (SELECT user_id, len(list_intersect(u.tags, j.tags)) AS m, len(u.tags) AS n FROM user_tags u, job_tags j WHERE len(u.tags) > 0) WHERE m > 0 GROUP BY ALL""")
_oracle("score_pairs", """SELECT user_id, source_id, job_id, score, CASE WHEN error IS NULL THEN CASE WHEN n > 0 THEN m || '/' || n || ' tags matched' ELSE 'fallback' END END AS summary, error FROM
  (SELECT user_id, source_id, job_id, n, m, CAST(CASE WHEN n > 0 THEN greatest(1, ceil(10.0 * m / n)) WHEN length(user_id) + length(job_id) <= 10 THEN length(user_id) + length(job_id) END AS INTEGER) AS score,
    CASE WHEN n = 0 AND length(user_id) + length(job_id) > 10 THEN 'score out of bounds' END AS error FROM
   (SELECT e.user_id, e.source_id, e.job_id, len(list_intersect(u.tags, coalesce(j.tags, CAST([] AS VARCHAR[])))) AS m, len(u.tags) AS n FROM evals e JOIN user_tags u USING (user_id) JOIN job_tags j USING (source_id, job_id)))""")
_oracle("attempt_outcome", """WITH tried AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY error IS NOT NULL, l_linenumber, l_partkey, l_shipdate, score) AS good_rank,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY error IS NULL, l_linenumber DESC, l_partkey DESC, l_shipdate DESC) AS bad_rank,
    max(l_linenumber) OVER (PARTITION BY l_orderkey) AS last_attempt, bool_or(error IS NULL) OVER (PARTITION BY l_orderkey) AS ok FROM parsed)
  SELECT l_orderkey, score, summary, error, CASE WHEN ok THEN l_linenumber ELSE last_attempt END AS n_attempts FROM tried WHERE CASE WHEN ok THEN good_rank = 1 ELSE bad_rank = 1 END""")
_oracle("cross_source_dedup", r"""SELECT content_key, k.source_id, k.job_id, n_copies, n_boards FROM
  (SELECT content_key, min({'source_id': source_id, 'job_id': job_id}) AS k, count(*) AS n_copies, count(DISTINCT source_id) AS n_boards
   FROM (SELECT *, md5(trim(regexp_replace(lower(description_raw), '\s+', ' ', 'g'))) AS content_key FROM texts) GROUP BY content_key) WHERE n_boards > 1""")
_oracle("extract_description", r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'g'),
    '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g')) AS title,
  regexp_replace(body, '\s+', ' ', 'g') AS description FROM
  (SELECT page_id, html, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(
     regexp_replace(regexp_replace(replace(replace(regexp_extract(html, '<body[^>]*>(.*)', 1, 's'), chr(10), ' '), chr(13), ' '), '<!--.*?-->|<(script|style)[^>]*>.*?</(script|style)>|</?(a|b|i|em|strong|span)( [^>]*)?>', '', 'gs'), '<[^>]*>', chr(10), 'g'),
     '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&'), '&amp', '&'), '[ \t\r]+', ' ', 'g'), ' *\n[ \n]*', chr(10), 'g'), chr(10) || ' ') AS body FROM pages)""")
_oracle("feed_totals", """SELECT a.user_id, count(j.job_id) AS total, CAST(greatest(ceil(count(j.job_id) / 25.0), 1) AS BIGINT) AS n_pages
  FROM active a LEFT JOIN subs s USING (user_id) LEFT JOIN jobs j ON s.source_id = j.source_id GROUP BY 1""")
_oracle("shortlisted_worklist", """WITH vec AS (SELECT CAST(vec_id AS VARCHAR) AS id, 'Board' || label AS board, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  near AS (SELECT u.id AS user_id, p.board AS source_id, p.id AS job_id FROM
      (SELECT DISTINCT id, unnest([board, 'Board' || (vec_id % 4)]) AS b, v FROM vec) u JOIN vec p ON p.board = u.b
    QUALIFY row_number() OVER (PARTITION BY u.id ORDER BY round(list_cosine_similarity(u.v, p.v), 9) DESC, p.board, p.id) <= 20)
  SELECT user_id, source_id, job_id FROM near WHERE NOT (user_id = job_id AND CAST(job_id AS INTEGER) % 3 = 0 AND CAST(job_id AS INTEGER) % 2 = 0)""")
_oracle("vector_shortlist", """SELECT user_id, CAST(position AS INTEGER) AS position, source_id, job_id, similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, source_id, job_id) AS position FROM (
    SELECT u.user_id, p.source_id, p.job_id, round(list_cosine_similarity(u.v, p.v), 9) AS similarity FROM
      (SELECT DISTINCT CAST(vec_id AS VARCHAR) AS user_id, unnest(['Board' || label, 'Board' || (vec_id % 4)]) AS source_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) u
      JOIN (SELECT 'Board' || label AS source_id, CAST(vec_id AS VARCHAR) AS job_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) p USING (source_id)))
  WHERE position <= 50""")
_oracle("near_copies", r"""WITH RECURSIVE k AS (SELECT source_id, job_id, trim(regexp_replace(lower(coalesce(description_raw, '')), '\s+', ' ', 'g')) AS t FROM texts),
  named AS (SELECT source_id, job_id, md5(t) AS id FROM k),
  w AS (SELECT md5(t) AS id, list_filter(string_split(t, ' '), lambda x: x <> '') AS ws FROM (SELECT DISTINCT t FROM k)),
  s AS (SELECT DISTINCT id, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
  z AS (SELECT id, count(*) AS n FROM s GROUP BY id),
  p AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY ALL),
  e AS (SELECT a, b FROM p JOIN z x ON x.id = a JOIN z y ON y.id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
  r AS (SELECT id, id AS root FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
  m AS (SELECT id, min(root) AS root FROM r GROUP BY id),
  c AS (SELECT root, min({'s': source_id, 'j': job_id}) AS f, count(DISTINCT id) AS n_texts, count(DISTINCT source_id) AS n_boards FROM named JOIN m USING (id) GROUP BY root)
  SELECT source_id, job_id, f.s AS class_source_id, f.j AS class_job_id, n_texts, n_boards, coalesce(n, 0) AS n_links
  FROM named JOIN m USING (id) JOIN c USING (root) LEFT JOIN (SELECT a AS id, count(*) AS n FROM e GROUP BY a) USING (id)""")
_oracle("indexed_shortlist", ORACLES["vector_shortlist"])
_oracle("best_by_tags", """SELECT user_id, CAST(position AS INTEGER) AS position, source_id, job_id, CAST(m AS INTEGER) AS n_matched, CAST(greatest(1, ceil(10.0 * m / n)) AS INTEGER) AS score FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, source_id, job_id) AS position FROM
    (SELECT user_id, source_id, job_id, len(list_intersect(u.tags, j.tags)) AS m, len(u.tags) AS n FROM user_tags u, job_tags j WHERE len(u.tags) > 0) WHERE m > 0) WHERE position <= 10""")
_oracle("alert_transitions", f"""WITH h AS (SELECT CAST(user_id AS VARCHAR) AS key, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL),
  e AS (SELECT key, m, (SELECT coalesce(sum(n), 0) FROM h WHERE h.key = k.key AND hour >= m - INTERVAL 2 HOUR AND hour < m) AS n FROM (SELECT DISTINCT key FROM h) k,
    (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events), (SELECT max(ts) - INTERVAL 2 HOUR FROM events), INTERVAL 1 HOUR)) AS m) t),
  c AS (SELECT *, CASE WHEN n > 0 AND NOT was THEN 'fired' WHEN n = 0 AND was THEN 'resolved' END AS state FROM
    (SELECT *, coalesce(lag(n > 0) OVER (PARTITION BY key ORDER BY m), false) AS was FROM e))
  SELECT key, state, strftime(m, {ISO}) AS "at", strftime(max(CASE WHEN state = 'fired' THEN m END) OVER (PARTITION BY key ORDER BY m), {ISO}) AS since, CAST(n AS BIGINT) AS n_failures
  FROM c WHERE state IS NOT NULL""")
_oracle("alert_transitions_stream", ORACLES["alert_transitions"])
_oracle("report_by_title", """SELECT CAST(row_number() OVER (ORDER BY coalesce(title, '') COLLATE en, job_id) AS INTEGER) AS position, job_id, title FROM
  (SELECT job_id, CASE CAST(job_id AS BIGINT) % 5 WHEN 0 THEN upper(title) WHEN 1 THEN translate(title, 'eao', 'éäô') WHEN 2 THEN translate(title, 'bs', 'BS') ELSE title END AS title FROM detail)""")
ORACLES["upsert_in_buckets"] = ORACLES["upsert_jobs"]
ORACLES["mark_in_buckets"] = ORACLES["mark_sent"]
ORACLES["keyword_match_indexed"] = ORACLES["keyword_match"]
