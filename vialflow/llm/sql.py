"""DuckDB statements of the queries that SQL can express."""

CONTENT_SORT = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

LEXICAL_SEARCH = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), doc AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc
), weight AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * max(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, total GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), score AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN doc USING (doc_id), total GROUP BY item_id, doc_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""

MERKLE_MANIFEST = r"""
WITH RECURSIVE crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, k + 1, xor(y >> 1, CAST(3988292384 AS BIGINT) * (y & 1))
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(substr(s, k // 8 + 1, 1)) AS BIGINT)) ELSE c END AS y
        FROM crc WHERE k < 8 * length(s))
), hit AS (
  SELECT doc_id FROM crc WHERE k = 8 * length(s) AND xor(c, CAST(4294967295 AS BIGINT)) % 7 = 0
), field AS (
  SELECT doc_id, lang, n_chars, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents
), leaf AS (
  SELECT f.doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN hit.doc_id IS NOT NULL THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS now
  FROM field f LEFT JOIN hit ON f.doc_id = hit.doc_id
), placed AS (
  SELECT *, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaf
), tree AS (
  SELECT g, i, leaf AS h, 0 AS level, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL
  SELECT g, i // 2, sha256(string_agg(h, '' ORDER BY i)), level + 1, (max(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY g, i // 2, level
), sub AS (
  SELECT g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM tree WHERE n = 1
), top AS (
  SELECT i, h, 0 AS level, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT i // 2, sha256(string_agg(h, '' ORDER BY i)), level + 1, (max(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY i // 2, level
), walk AS (
  SELECT p.g, p.i AS first, p.i, 0 AS level, coalesce(p.now, p.leaf) AS x, '' AS proof FROM placed p
  UNION ALL
  SELECT w.g, w.first, w.i // 2, w.level + 1,
         sha256(CASE WHEN s.h IS NULL THEN w.x WHEN s.i < w.i THEN s.h || w.x ELSE w.x || s.h END), w.proof || coalesce(s.h, '')
  FROM walk w JOIN (SELECT DISTINCT g, level, n FROM tree) l ON l.g = w.g AND l.level = w.level AND l.n > 1
  LEFT JOIN tree s ON s.g = w.g AND s.level = w.level AND s.i = xor(w.i, 1)
), climbed AS (
  SELECT g, first, arg_max(x, level) AS x, arg_max(proof, level) AS proof FROM walk GROUP BY g, first
), walk2 AS (
  SELECT c.g, c.first, sub.i, 0 AS level, c.x, c.proof FROM climbed c JOIN sub ON sub.g = c.g
  UNION ALL
  SELECT w.g, w.first, w.i // 2, w.level + 1,
         sha256(CASE WHEN s.h IS NULL THEN w.x WHEN s.i < w.i THEN s.h || w.x ELSE w.x || s.h END), w.proof || coalesce(s.h, '')
  FROM walk2 w JOIN (SELECT DISTINCT level, n FROM top) l ON l.level = w.level AND l.n > 1
  LEFT JOIN top s ON s.level = w.level AND s.i = xor(w.i, 1)
), done AS (
  SELECT g, first, arg_max(x, level) AS folded_root, arg_max(proof, level) AS proof FROM walk2 GROUP BY g, first
)
SELECT p.doc_id, p.leaf, sub.h AS subroot, r.h AS root, sha256(d.proof) AS proof_sha256, d.folded_root, d.folded_root = r.h AS verified
FROM placed p JOIN done d ON d.g = p.g AND d.first = p.i JOIN sub ON sub.g = p.g JOIN (SELECT h FROM top WHERE n = 1) r ON true
"""
