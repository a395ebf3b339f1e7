"""DuckDB SQL for the queries that SQL can express, over whole tables."""

WORDS = r"""
words AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
         generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS i
  FROM documents)"""

NEAR_DEDUP = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
seqs AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM lowered),
words AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM seqs),
windows AS (SELECT doc_id, n, i, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s FROM words),
shingles AS (SELECT DISTINCT doc_id, s FROM windows WHERE i <= greatest(1, n - 2)),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.size + y.size - k)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, b FROM reach JOIN both_ways ON reach.r = a)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT d AS doc_id, min(r) AS component_id FROM reach GROUP BY d) LEFT JOIN sizes USING (doc_id)
"""

TOPK = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.i <> b.i AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5
"""

RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
words AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
windows AS (SELECT doc_id, n, i, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS s FROM words),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows WHERE i <= n - 7),
covers AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS c FROM counted WHERE c > 1),
repeats AS (SELECT doc_id, sum(c)::BIGINT AS n_repeat_words FROM covers GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(regexp_extract_all(t, '\p{Lu}{4,}')) AS n_shouted, len(lines) AS n_lines
  FROM d LEFT JOIN repeats USING (doc_id)),
f AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_dup_lines >= 5 AND 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_shouted > 50 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 30 * n_words THEN 32 ELSE 0 END AS failed_rules
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       failed_rules = 0 AS kept, failed_rules::BIGINT AS failed_rules, n_shouted
FROM f
"""

SUBSTRINGS = "WITH " + WORDS.strip() + r""",
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
windows AS (SELECT doc_id, i, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS s FROM words),
firsts AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) < doc_id AS found FROM windows JOIN sizes USING (doc_id) WHERE i <= n - 49),
marked AS (
  SELECT doc_id, i, w, coalesce(bool_or(coalesce(found, false)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM words LEFT JOIN firsts USING (doc_id, i)),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         sha256(coalesce(string_agg(w, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
  FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

# crc32 byte by byte from a table that follows from its polynomial; the hashed
# text holds digits, a colon, a sign and code points below U+0100 only
VARIANTS = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS k, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS r FROM documents),
lowered AS (SELECT k, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS m FROM runs GROUP BY 1, 2),
bytes AS (
  SELECT r, m, flatten(list_transform(string_split(k || ':' || r, ''),
                       lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)) AS b FROM lowered),
hashed AS (
  SELECT r, m, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc_table),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, m FROM hashed),
words AS (SELECT word, sum(m)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS p, substr(word, i + 1) AS s
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a, b, bn FROM (
    SELECT x.word AS a, y.word AS b, y.n AS bn FROM cuts x JOIN cuts y ON x.p = y.p AND x.s = y.s AND x.word <> y.word
    UNION ALL SELECT x.word, w.word, w.n FROM cuts x JOIN words w ON w.word = x.p || x.s
    UNION ALL SELECT w.word, x.word, x.n FROM cuts x JOIN words w ON w.word = x.p || x.s)),
best AS (SELECT a AS word, count(*) AS n_near, max(bn) AS top FROM near GROUP BY a),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * n THEN (SELECT min(b) FROM near WHERE near.a = words.word AND near.bn = top) END AS form,
         CASE WHEN top >= 10 * n THEN top END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM words
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
last AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)
"""
