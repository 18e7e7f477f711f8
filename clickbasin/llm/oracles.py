"""The registered queries that SQL can express, in DuckDB's SQL."""

from __future__ import annotations

NGRAM_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE CAST(shared.n AS DOUBLE) / (a.n + b.n - shared.n) >= 0.8
),
reached AS (
  SELECT doc_id AS node, doc_id AS origin FROM words
  UNION
  SELECT y, origin FROM reached JOIN links ON x = node
),
classes AS (SELECT node, min(origin) AS class_id FROM reached GROUP BY node),
linked AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT doc_id, class_id, coalesce(linked.n, 0) AS n_links,
  CASE WHEN len(w) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY w) END AS n_copies
FROM words JOIN classes ON node = doc_id LEFT JOIN linked ON x = doc_id
"""

# Windows of 512 tokens with 128 of history, a system turn of at most 256 repeated, turns of 32 windows at a time, 4 tokens besides a turn's own.
CHAT = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
costed AS (
  SELECT *, len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]')) + 4 AS cost,
    15 + len(replace(replace(replace(role, '\', '\\'), '<', '\l'), chr(10), '\n'))
      + len(replace(replace(text, '\', '\\'), '<', '\l')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nr
  FROM given
),
placed AS (
  SELECT *, sum(cost) OVER (PARTITION BY conv_id ORDER BY nr) - cost AS start,
    first_value(CASE WHEN role = 'system' AND cost <= 256 THEN cost END) OVER (PARTITION BY conv_id ORDER BY nr) AS system_cost,
    first_value(CASE WHEN role = 'system' AND cost <= 256 THEN chars END) OVER (PARTITION BY conv_id ORDER BY nr) AS system_chars
  FROM costed
),
parted AS (SELECT *, start // (32 * 512) AS segment FROM placed),
turns AS (
  SELECT *, greatest(1, 512 - 128 - CASE WHEN max(nr) OVER (PARTITION BY conv_id, segment) > 1
    THEN coalesce(system_cost, 0) ELSE 0 END) AS room
  FROM parted
),
spans AS (
  SELECT conv_id, nr, segment, cost AS used, nr AS opening FROM turns WHERE nr = 1
  UNION ALL
  SELECT t.conv_id, t.nr, t.segment,
    CASE WHEN t.segment <> s.segment OR s.used + t.cost > t.room THEN t.cost ELSE s.used + t.cost END,
    CASE WHEN t.segment <> s.segment OR s.used + t.cost > t.room THEN t.nr ELSE s.opening END
  FROM spans s JOIN turns t ON t.conv_id = s.conv_id AND t.nr = s.nr + 1
),
windows AS (
  SELECT DISTINCT s.conv_id, s.opening, t.start, t.system_chars
  FROM spans s JOIN turns t ON t.conv_id = s.conv_id AND t.nr = s.opening
),
repeats AS (
  SELECT w.conv_id, w.opening, sum(h.chars) AS chars
  FROM windows w JOIN turns h ON h.conv_id = w.conv_id AND h.nr < w.opening AND h.start >= w.start - 128
    AND NOT (h.nr = 1 AND w.system_chars IS NOT NULL)
  GROUP BY ALL
),
besides AS (
  SELECT conv_id, count(*) AS n_windows,
    sum(coalesce(repeats.chars, 0) + CASE WHEN opening > 1 THEN coalesce(system_chars, 0) ELSE 0 END) AS chars
  FROM windows LEFT JOIN repeats USING (conv_id, opening) GROUP BY conv_id
),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr) AS said,
    coalesce(string_agg(text, '' ORDER BY nr) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, len(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(whole.chars + besides.chars AS BIGINT) AS formatted_chars, n_windows
FROM whole JOIN besides USING (conv_id)
"""

# Terms as the contract gives them; weights and scores in the same integer steps.
LEXICAL = r"""
WITH found AS (
  SELECT doc_id, row_number() OVER () AS nr, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
),
docs AS (SELECT nr, doc_id, len(terms) AS n FROM found WHERE len(terms) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
held AS (
  SELECT nr, term, count(*) AS tf FROM (SELECT nr, unnest(terms) AS term FROM found) GROUP BY 1, 2
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term
),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l))))) AS BIGINT) AS score
  FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN docs USING (nr), corpus GROUP BY item_id, nr, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

# Two rounds of means, then the last codes; vectors of one length that 16 divides.
VECTOR_CODES = r"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS nr, vec_id, label, len(embedding) // 16 AS width,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (SELECT nr, part, width, v[part * width + 1:(part + 1) * width] AS x FROM kept, range(16) AS t(part)),
c0 AS (SELECT part, nr - 1 AS entry, x AS c FROM parts WHERE nr <= 64),
a0 AS (
  SELECT nr, part, min(d * 64 + entry) % 64 AS entry, min(d * 64 + entry) // 64 AS d FROM (
    SELECT nr, part, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts JOIN c0 USING (part)) GROUP BY nr, part
),
c1 AS (
  SELECT part, entry, coalesce(mean, c) AS c FROM c0 LEFT JOIN (
    SELECT part, entry, list(CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ORDER BY place) AS mean FROM (
      SELECT part, entry, place, sum(x[place]) AS total, count(*) AS n
      FROM a0 JOIN parts USING (nr, part), range(1, 1 + width) AS t(place) GROUP BY part, entry, place
    ) GROUP BY part, entry) USING (part, entry)
),
a1 AS (
  SELECT nr, part, min(d * 64 + entry) % 64 AS entry, min(d * 64 + entry) // 64 AS d FROM (
    SELECT nr, part, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts JOIN c1 USING (part)) GROUP BY nr, part
),
c2 AS (
  SELECT part, entry, coalesce(mean, c) AS c FROM c1 LEFT JOIN (
    SELECT part, entry, list(CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ORDER BY place) AS mean FROM (
      SELECT part, entry, place, sum(x[place]) AS total, count(*) AS n
      FROM a1 JOIN parts USING (nr, part), range(1, 1 + width) AS t(place) GROUP BY part, entry, place
    ) GROUP BY part, entry) USING (part, entry)
),
a2 AS (
  SELECT nr, part, min(d * 64 + entry) % 64 AS entry, min(d * 64 + entry) // 64 AS d FROM (
    SELECT nr, part, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts JOIN c2 USING (part)) GROUP BY nr, part
),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2
),
codes AS (SELECT nr, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY nr)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (nr), digest
"""
