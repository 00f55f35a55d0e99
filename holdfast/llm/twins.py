"""The SQL of the queries of this package that SQL can express, for DuckDB over the driver's tables."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RESAMPLING = rf"""
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS crcs
  FROM range(256) AS t(i)),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
hexed AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM words),
bytes AS (
  SELECT w, list_transform(range(1, length(h), 2), lambda i:
    16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1) AS b FROM hexed),
hashed AS (
  SELECT w, xor(list_reduce(list_concat([4294967295], b), lambda x, y:
    xor(x >> 8, crcs[(xor(x, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc_table),
counted AS (
  SELECT side, id, bucket, count(*) AS n FROM words JOIN hashed USING (w) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM counted GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE
                                 / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS gain FROM sums),
weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
noised AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    list_reduce(list_transform(range(1, 9), lambda i: strpos('0123456789abcdef', sha256('2024:' || doc_id)[i]) - 1),
                lambda x, y: 16 * x + y) AS h
  FROM documents LEFT JOIN weighed ON id = doc_id),
scored AS (
  SELECT doc_id, n_features, weight,
    (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM noised),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM placed
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM split GROUP BY lang),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM split, range(1, 6) AS sizes(k)),
counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
phrases AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT lang, phrase, a, c AS cut, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS c FROM phrases)),
scores AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, n, 1000 * c.a::HUGEINT * n // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = head
  JOIN counts y ON y.lang = c.lang AND y.phrase = tail JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM phrases))),
around AS (SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.longer IS NULL OR 100 * o.longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
