"""The corpus queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_warc_chunks"] = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

ORACLES["op6_backoff"] = """
WITH t AS (
  SELECT doc_id, row_number() OVER () AS row_no,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
), tok AS (SELECT doc_id, row_no, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM t),
n AS (SELECT CAST(round(1e6 * ln(count(*))) AS BIGINT) AS log_total, CAST(round(1e6 * ln(0.4)) AS BIGINT) AS back FROM tok),
p AS (SELECT *, lag(word) OVER (PARTITION BY row_no ORDER BY i) AS before FROM tok),
own1 AS (SELECT row_no, word, count(*) AS c FROM tok GROUP BY ALL),
all1 AS (SELECT word, sum(c) AS c FROM own1 GROUP BY word),
left1 AS (SELECT row_no, word, all1.c - own1.c AS c FROM own1 JOIN all1 USING (word)),
own2 AS (SELECT row_no, before, word, count(*) AS c FROM p WHERE before IS NOT NULL GROUP BY ALL),
all2 AS (SELECT before, word, sum(c) AS c FROM own2 GROUP BY ALL),
left2 AS (SELECT row_no, before, word, all2.c - own2.c AS c FROM own2 JOIN all2 USING (before, word)),
s AS (
  SELECT p.doc_id, CASE
    WHEN left2.c > 0 THEN CAST(round(1e6 * ln(left2.c)) AS BIGINT) - CAST(round(1e6 * ln(v.c)) AS BIGINT)
    ELSE CASE WHEN p.before IS NULL THEN 0 ELSE back END - log_total
      + CASE WHEN w.c > 0 THEN CAST(round(1e6 * ln(w.c)) AS BIGINT) ELSE back END END AS m
  FROM p CROSS JOIN n JOIN left1 AS w ON w.row_no = p.row_no AND w.word = p.word
  LEFT JOIN left1 AS v ON v.row_no = p.row_no AND v.word = p.before
  LEFT JOIN left2 ON left2.row_no = p.row_no AND left2.before = p.before AND left2.word = p.word
), d AS (SELECT doc_id, count(*) AS n_words, sum(m) AS m FROM s GROUP BY doc_id)
SELECT i.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(m, 0) AS DOUBLE) / 1e6 AS score
FROM (SELECT DISTINCT doc_id FROM documents) AS i LEFT JOIN d ON d.doc_id IS NOT DISTINCT FROM i.doc_id
"""

ORACLES["op11_exact_topk"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row_no,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.row_no AS query_row, c.vec_id, c.row_no,
    CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON c.row_no <> q.row_no WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id ASC NULLS LAST, row_no) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES["op12_collocations"] = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces
  FROM documents
), p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
t AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM t, unnest([1, 2, 3, 4, 5]) AS u(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL
), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT * FROM g WHERE f >= 100),
x AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1 : k - 1], ' '), array_to_string(string_split(phrase, ' ')[2 :], ' ')]) AS phrase
    FROM f WHERE k > 2) GROUP BY ALL
), c AS (SELECT f.* FROM f LEFT JOIN x USING (lang, phrase) WHERE k > 1 AND (longer IS NULL OR longer < f)),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(string_split(phrase, ' ')[1 : j], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[j + 1 :], ' ') AS rest
  FROM c, unnest([1, 2, 3, 4]) AS u(j) WHERE j < k
), s AS (
  SELECT cuts.lang, cuts.phrase, a, j, hl.f AS l, hr.f AS r, n.n,
    CAST((CAST(1000 AS HUGEINT) * a * n.n) // (CAST(hl.f AS HUGEINT) * hr.f) AS BIGINT) AS score
  FROM cuts JOIN f AS hl ON hl.lang = cuts.lang AND hl.phrase = cuts.head JOIN f AS hr ON hr.lang = cuts.lang AND hr.phrase = cuts.rest
  JOIN n ON n.lang = cuts.lang
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000
"""

ORACLES["op13_reversed_search"] = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents WHERE text IS NOT NULL
), t AS (SELECT doc, unnest(ts) AS term FROM d),
tf AS (SELECT doc, term, count(*) AS tf FROM t GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
z AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
m AS (SELECT doc, doc_id, 10 + (90 * len(ts) * n_docs) // n_terms AS m FROM d, z WHERE len(ts) > 0),
i AS (
  SELECT DISTINCT item, item_id, unnest(ts) AS term FROM (
    SELECT item_id, row_number() OVER () AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM benchmark)
), s AS (
  SELECT item, item_id, doc, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc), z GROUP BY ALL
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
