"""SQL for the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CONVERSATION_REPAIR = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(entry ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS entry
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: CAST(ord(c) AS BIGINT)) AS codes
  FROM conversations),
cases AS (
  SELECT k.* EXCLUDE (codes), xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), codes),
    lambda crc, b: xor(t[(xor(crc, b) & 255) + 1], crc >> 8)), 4294967295) % 20 AS harm
  FROM keyed k, crc_table),
after AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM cases WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare, substr(role, 1, 1) AS initial FROM after),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS adjacent FROM placed),
inserts(state, edits, reached, done) AS (VALUES
  ('', '', '', ''), ('', 'I', 'u', chr(10) || 'user:'), ('', 'II', 'a', chr(10) || 'user:' || chr(10) || 'assistant:'),
  ('s', '', 's', ''), ('s', 'I', 'u', chr(10) || 'user:'), ('s', 'II', 'a', chr(10) || 'user:' || chr(10) || 'assistant:'),
  ('u', '', 'u', ''), ('u', 'I', 'a', chr(10) || 'assistant:'), ('u', 'II', 'u', chr(10) || 'assistant:' || chr(10) || 'user:'),
  ('a', '', 'a', ''), ('a', 'I', 'u', chr(10) || 'user:'), ('a', 'II', 'a', chr(10) || 'user:' || chr(10) || 'assistant:')),
follows(before, initial) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
edits AS (
  SELECT reached AS before, 'D' AS edit, CAST(NULL AS VARCHAR) AS initial, reached AS after, CAST(NULL AS VARCHAR) AS role, 2 AS price FROM inserts WHERE edits = ''
  UNION ALL SELECT before, 'K', initial, initial, NULL, 0 FROM follows
  UNION ALL SELECT before, 'R', NULL, initial, CASE initial WHEN 'u' THEN 'user' ELSE 'assistant' END, 1 FROM follows WHERE initial <> 's'),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS state, 0 AS cost, '' AS audit, '' AS done FROM conversations
  UNION ALL
  SELECT conv_id, i, state, cost, audit, done FROM (
    SELECT w.conv_id, f.i, e.after AS state, w.cost + 5 * length(n.edits) + e.price
        + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 5 ELSE 0 END AS cost,
      w.audit || n.edits || e.edit AS audit,
      w.done || n.done || CASE WHEN e.edit = 'D' THEN '' ELSE chr(10) || coalesce(e.role, f.role) || ':' || f.text END AS done,
      row_number() OVER (PARTITION BY w.conv_id, e.after ORDER BY w.cost + 5 * length(n.edits) + e.price
        + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 5 ELSE 0 END, w.audit || n.edits || e.edit) AS pick
    FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN inserts n ON n.state = w.state
    JOIN edits e ON e.before = n.reached AND (e.initial IS NULL OR e.initial = f.initial)
      AND (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate')))
  WHERE pick = 1),
lengths AS (
  SELECT c.conv_id, count(f.i) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (adjacent IS NOT NULL AND adjacent NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
ended AS (
  SELECT l.*, w.cost + 5 * length(n.edits) AS cost, w.audit || n.edits AS audit, w.done || n.done AS done,
    row_number() OVER (PARTITION BY l.conv_id ORDER BY w.cost + 5 * length(n.edits), w.audit || n.edits) AS pick
  FROM lengths l JOIN walk w ON w.conv_id IS NOT DISTINCT FROM l.conv_id AND w.i = l.n
  JOIN inserts n ON n.state = w.state AND n.reached IN ('', 'a'))
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(substr(done, 2)) AS repaired_sha256
FROM ended WHERE pick = 1"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED_SEARCH = f"""
WITH uses AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents)
  GROUP BY doc_id, term),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM uses GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM uses GROUP BY term), totals),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN uses USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""
