"""SQL for the queries of this subpackage that SQL can express, over the plain tables."""

from __future__ import annotations

#: Line templates: leaves by token count and three leading tokens, constants that a quarter of
#: the leaf's distinct lines, two at least, have at a position, templates of at least 0.8 constant tokens in three documents.
LINES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM d),
tokens AS (
    SELECT doc_id, line_no, string_split_regex(
               regexp_replace(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'),
               '[\x20\x09-\x0D]+') AS t
    FROM raw),
parsed AS (SELECT doc_id, line_no, t, len(t) AS n, t[1:3] AS lead FROM tokens WHERE len(t) >= 5),
kinds AS (SELECT DISTINCT n, lead, t FROM parsed),
leaves AS (SELECT n, lead, count(*) AS of_leaf FROM kinds GROUP BY ALL HAVING count(*) > 1),
fields AS (
    SELECT n, lead, t, of_leaf, unnest(t[4:]) AS token, generate_subscripts(t[4:], 1) AS place
    FROM kinds JOIN leaves USING (n, lead)),
constants AS (
    SELECT n, lead, place, token, 1 AS constant FROM fields GROUP BY n, lead, place, token
    HAVING count(*) >= greatest(2, 0.25::DOUBLE * max(of_leaf))),
shaped AS (
    SELECT n, lead, t, count(constant) + 3 AS constants,
           list(CASE WHEN constant = 1 THEN token ELSE chr(1) END ORDER BY place) AS shape
    FROM fields LEFT JOIN constants USING (n, lead, place, token)
    GROUP BY n, lead, t),
general AS (
    SELECT n, lead, t, shape FROM shaped
    WHERE constants >= n * CAST(0.8 AS DOUBLE) AND constants < n),
placed AS (
    SELECT doc_id, line_no, n, lead, coalesce(shape, t) AS template, shape IS NOT NULL AS is_general
    FROM parsed LEFT JOIN general USING (n, lead, t)),
recurring AS (
    SELECT n, lead, template, is_general, min({'d': doc_id, 'l': line_no}) AS first_place
    FROM placed GROUP BY n, lead, template, is_general HAVING count(DISTINCT doc_id) >= 3),
dropped AS (
    SELECT doc_id, line_no FROM placed JOIN recurring USING (n, lead, template, is_general)
    WHERE {'d': doc_id, 'l': line_no} <> first_place),
kept AS (
    SELECT doc_id, count(dropped.line_no) AS dropped_lines,
           coalesce(string_agg(line, chr(10) ORDER BY raw.line_no) FILTER (dropped.line_no IS NULL), '') AS text
    FROM raw LEFT JOIN dropped USING (doc_id, line_no)
    GROUP BY doc_id)
SELECT doc_id, CAST(dropped_lines AS BIGINT) AS dropped_lines,
       CAST(length(text) AS BIGINT) AS kept_chars, sha256(text) AS kept_sha256
FROM kept
"""

VECTORS = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reached AS (
    SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       least(vec_id, coalesce(least.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM embeddings
LEFT JOIN counts ON counts.a = vec_id
LEFT JOIN least ON least.a = vec_id
"""

#: Every order of five filters over counts of whole texts.
FILTERS = r"""
WITH counted AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
firsts AS (SELECT text, min(doc_id) AS least_id FROM counted GROUP BY text),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
           [len(words) < 200,
            100 * len(list_distinct(words)) < 50 * len(words),
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
            regexp_matches(text, '[#$%&*|]'),
            coalesce(counted.doc_id > least_id, false)] AS f
    FROM counted JOIN firsts USING (text) LEFT JOIN marks ON marks.doc_id = counted.doc_id),
sets AS (
    SELECT part, f, count(*) AS n, sum(good) AS n_good, sum(bad) AS n_bad,
           f[1]::int + f[2]::int + f[3]::int + f[4]::int + f[5]::int AS fails
    FROM failed GROUP BY ALL),
letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, generate_subscripts(o, 1) AS step, unnest(o) AS own FROM orders),
placed AS (
    SELECT part, o, step, n, n_good, n_bad, fails, f[own] AS hit,
           len(list_filter(o[1:step - 1], lambda i: f[i])) > 0 AS gone
    FROM sets, steps)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order,
       CAST(step AS INTEGER) AS step,
       CAST(sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN hit AND fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN NOT gone AND hit THEN n_good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN NOT gone AND hit THEN n_bad ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN hit THEN n * 120 // fails ELSE 0 END) AS BIGINT) AS shapley
FROM placed
GROUP BY part, o, step
"""

#: Queries without SQL hash, draw, train or tokenize; tests hold them against brute force.
ORACLES: dict[str, str] = {"op1_lines": LINES, "op8_embeddings": VECTORS, "op13_filters": FILTERS}
