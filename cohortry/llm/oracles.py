"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from cohortry.llm import warc

VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.x = vec_id LEFT JOIN counted ON counted.x = vec_id
"""

DOCUMENTS = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS words FROM documents),
listed AS (
  SELECT doc_id, unnest(list_transform(range(0, len(words) - least(5, len(words)) + 1),
    lambda i: array_to_string(words[i + 1 : i + least(5, len(words))], ' '))) AS shingle
  FROM cut WHERE len(words) > 0),
sets AS (SELECT doc_id, shingle, count(*) AS n FROM listed GROUP BY doc_id, shingle),
sizes AS (SELECT doc_id, sum(n) AS size FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.n, b.n)) AS s
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
alike AS (
  SELECT x, y, s, p.size AS p, q.size AS q FROM shared
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * s >= 80 * (p.size + q.size - s)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, alike.y FROM reach JOIN alike ON reach.y = alike.x),
least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
same AS (SELECT x, min(y) AS other FROM alike WHERE s = p AND s = q GROUP BY x)
SELECT doc_id, least(doc_id, coalesce(other, doc_id)) AS class_id, component_id,
  doc_id = component_id AS kept
FROM documents JOIN least_of ON least_of.x = doc_id LEFT JOIN same ON same.x = doc_id
"""

# crc32 bit by bit; the polynomial is a fixed value.  Levels above a group's root
# repeat it until all groups have ended, and are cut off by the depth.
MANIFEST = r"""
WITH RECURSIVE given AS (
  SELECT doc_id, source, lang, n_chars, text, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))) AS crc
  FROM documents),
forms AS (
  SELECT doc_id, lang, unnest([n_chars, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END]) AS n,
    unnest([0, 1]) AS form, source, text FROM given),
hashed AS (
  SELECT doc_id, lang, form, sha256(concat(
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'),
    coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(n::VARCHAR) || ':' || n::VARCHAR, '-'), coalesce(strlen(text) || ':' || text, '-'))) AS h
  FROM forms),
leaves AS (
  SELECT a.doc_id, a.lang, a.h AS leaf, b.h AS tampered,
    row_number() OVER (PARTITION BY a.lang ORDER BY a.doc_id NULLS FIRST) - 1 AS rank
  FROM hashed a JOIN hashed b ON a.doc_id = b.doc_id AND a.form = 0 AND b.form = 1),
tree AS (
  SELECT lang, 0 AS level, rank, leaf AS h, count(*) OVER (PARTITION BY lang) AS size FROM leaves
  UNION ALL
  SELECT lang, level + 1, rank // 2, sha256(string_agg(h, '' ORDER BY rank)), (any_value(size) + 1) // 2
  FROM tree WHERE size > 1 GROUP BY lang, level, rank // 2),
subroots AS (
  SELECT lang, h AS subroot, level AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM tree WHERE size = 1),
top AS (
  SELECT 0 AS level, place AS rank, subroot AS h, count(*) OVER () AS size FROM subroots
  UNION ALL
  SELECT level + 1, rank // 2, sha256(string_agg(h, '' ORDER BY rank)), (any_value(size) + 1) // 2
  FROM top WHERE size > 1 GROUP BY level, rank // 2),
steps AS (
  SELECT l.doc_id, l.leaf, l.tampered, s.subroot, t.level AS step, t.h, (l.rank >> t.level) & 1 AS side,
    x.h AS other
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.rank = l.rank >> t.level AND t.level < s.depth
  LEFT JOIN tree x ON x.lang IS NOT DISTINCT FROM l.lang AND x.level = t.level AND x.rank = xor(t.rank, 1)
  UNION ALL
  SELECT l.doc_id, l.leaf, l.tampered, s.subroot, s.depth + t.level, t.h, (s.place >> t.level) & 1, x.h
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  JOIN top t ON t.rank = s.place >> t.level AND t.size > 1
  LEFT JOIN top x ON x.level = t.level AND x.rank = xor(t.rank, 1)),
paths AS (
  SELECT doc_id, list({'side': side, 'other': coalesce(other, '')} ORDER BY step) AS path,
    coalesce(string_agg(other, '' ORDER BY step), '') AS proof
  FROM steps GROUP BY doc_id),
folds AS (
  SELECT l.doc_id, l.leaf, s.subroot, sha256(coalesce(proof, '')) AS proof_sha256, coalesce(list_reduce(
    list_prepend({'side': 0::BIGINT, 'other': l.tampered}, path),
    lambda acc, p: {'side': 0::BIGINT, 'other': sha256(CASE WHEN p.side = 1 THEN p.other || acc.other
      ELSE acc.other || p.other END)}).other, l.tampered) AS folded_root
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths USING (doc_id))
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE size = 1) AS root, proof_sha256, folded_root,
  folded_root = (SELECT h FROM top WHERE size = 1) AS verified
FROM folds
"""

RANKED = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
sizes AS (SELECT doc_id, len(words)::BIGINT AS n FROM cut WHERE len(words) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
counts AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, unnest(words) AS term FROM cut) WHERE term IN (SELECT term FROM asked)
  GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, totals GROUP BY term),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))) AS impact
  FROM counts JOIN weights USING (term) JOIN sizes USING (doc_id), totals),
scores AS (
  SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 50
"""

ORACLES = {
    "op1_collision_counting": VECTORS,
    "op3_revisits": warc.ORACLE,
    "op10_bagminhash": DOCUMENTS,
    "op11_dag_descent": MANIFEST,
    "op13_blocked_search": RANKED,
}
