"""DuckDB twins of the queries that SQL can express; each states its query's contract from the whole table."""

from __future__ import annotations

from .merkle import LEAF_DIGITS, SECTION
from .mixing import POOR, WEIGHTS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS}) AS size, coalesce(text, '') AS t FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE)
         / greatest(0.25::DOUBLE, 1 - 2 * CASE WHEN t = '' THEN 1::DOUBLE
             ELSE len(regexp_extract_all(t, '{POOR}'))::DOUBLE / length(t) END) AS e
  FROM d),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
weighed AS (
  SELECT source, source_size, [{', '.join(f'{w}::DOUBLE' for w in WEIGHTS)}][
           CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS INTEGER) + 1] AS w
  FROM sources),
-- a source is at its limit if it would be with every source of less room per weight at its limit
tried AS (
  SELECT a.source, a.source_size, a.w,
         3::DOUBLE * a.source_size <= a.w * (
           (SELECT sum(source_size) FROM weighed)
           - 3 * coalesce((SELECT sum(b.source_size) FROM weighed b WHERE b.source_size / b.w < a.source_size / a.w), 0))
         / ((SELECT sum(w) FROM weighed)
            - coalesce((SELECT sum(b.w) FROM weighed b WHERE b.source_size / b.w < a.source_size / a.w), 0)) AS full_
  FROM weighed a),
targets AS (
  SELECT source, source_size, CASE WHEN full_ THEN 3::DOUBLE * source_size ELSE
           ((SELECT sum(source_size) FROM weighed) - coalesce((SELECT sum(3::DOUBLE * source_size) FROM tried WHERE full_), 0))
           / (SELECT sum(w) FROM tried WHERE NOT full_) * w END AS target
  FROM tried),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets),
run AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs,
         CAST(round(p.target - p.epochs * p.source_size) AS BIGINT) - coalesce(sum(k.size) OVER (
           PARTITION BY k.source ORDER BY k.e, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, room)) AS BIGINT) AS taken
FROM run
"""

MERKLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents),
following AS (
  SELECT doc_id, t, length(t) AS n,
         coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS next_text,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM d),
texts AS (
  SELECT doc_id, next_id, n, false AS edited, t FROM following
  UNION ALL
  SELECT doc_id, next_id, n, true, substr(t, 1, n - n // 4) || substr(next_text, 1, n // 4) FROM following),
-- U+10FFFF, which no text may hold, marks the ends of phrases
paragraphs AS (
  SELECT *, list_transform(string_split(t, chr(10)), lambda p: array_to_string(list_transform(
           string_split(regexp_replace(p, '([.,;:!?ent] )', '\1' || chr(1114111), 'g'), chr(1114111)),
           lambda x: substr(md5(x), 1, {LEAF_DIGITS})), ' ')) AS q
  FROM texts),
sections AS (
  SELECT *, list_transform(range(0, (len(q) - 1) // {SECTION} + 1),
           lambda i: array_to_string(q[i * {SECTION} + 1 : i * {SECTION} + {SECTION}], '|')) AS s
  FROM paragraphs),
prints AS (
  SELECT doc_id, next_id, n, edited, t,
         sha256(array_to_string(list_transform(s, lambda x: substr(sha256(x), 1, 16)), '')) || ';'
         || array_to_string(list_transform(s, lambda x: substr(sha256(x), 1, 16) || ':' || x), ';') AS fingerprint,
         list_distinct(string_split(array_to_string(q, ' '), ' ')) AS leaves
  FROM sections),
compared AS (
  SELECT a.doc_id, a.n, b.t AS edited_text, a.fingerprint, b.fingerprint AS edited_fingerprint,
         len(a.leaves) AS own, len(b.leaves) AS changed, len(c.leaves) AS other,
         len(list_intersect(a.leaves, b.leaves)) AS with_edited, len(list_intersect(a.leaves, c.leaves)) AS with_next
  FROM prints a JOIN prints b ON a.doc_id = b.doc_id AND b.edited
  JOIN prints c ON a.next_id = c.doc_id AND NOT c.edited
  WHERE NOT a.edited)
SELECT doc_id, n AS n_chars, sha256(edited_text) AS edited_sha256, fingerprint, edited_fingerprint,
       with_edited::DOUBLE / (own + changed - with_edited) AS near_edited,
       with_next::DOUBLE / (own + other - with_next) AS near_next
FROM compared
"""

WINDOWS = rf"""
WITH d AS (
  SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 12], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first_id FROM windows) WHERE doc_id > first_id),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM again),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d) w
  ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p
  GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""

MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
cuts AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS p, coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
         coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS s
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

MINHASH = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) <= 3 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS g
  FROM d),
items AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id AS id, doc_id AS other FROM sets
  UNION
  SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r ON s.doc_id = r.id GROUP BY s.doc_id, s.g
"""

ORACLES = {"op3_mixing": MIXING, "op6_merkle": MERKLE, "op9_windows": WINDOWS, "op11_negatives": NEGATIVES, "op12_middle": MIDDLE,
           "op13_minhash": MINHASH}
