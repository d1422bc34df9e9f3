"""DuckDB SQL of the operators that SQL can express whole."""

from __future__ import annotations

#: Unsigned crc32 of an id's decimal digits, bit by bit (reflected polynomial 0xEDB88320).
CRC32_OF_ID = """xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))))"""

OP13_SQL = f"""
WITH RECURSIVE
hashed AS (
  SELECT doc_id, lang, COALESCE({CRC32_OF_ID} % 7 = 0, false) AS tamper,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
    coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more_chars,
    coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || chars || body) AS leaf,
    sha256(head || CASE WHEN tamper THEN more_chars ELSE chars END || body) AS changed
  FROM hashed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
up AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
subroots AS (
  SELECT lang, lvl AS height, h AS subroot,
    row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS pos, count(*) OVER () AS n
  FROM up WHERE n = 1),
over AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM over WHERE n > 1 GROUP BY lvl, pos // 2, n),
steps AS (
  SELECT p.doc_id, p.leaf, p.pos AS leaf_pos, p.lang, s.lvl, (p.pos >> s.lvl) % 2 AS odd, u.h
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
  JOIN range(64) s(lvl) ON s.lvl < r.height
  LEFT JOIN up u ON u.lang IS NOT DISTINCT FROM p.lang AND u.lvl = s.lvl AND u.pos = xor(p.pos >> s.lvl, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, p.pos, p.lang, 64 + s.lvl, (r.pos >> s.lvl) % 2, u.h
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
  JOIN range(64) s(lvl) ON s.lvl < (SELECT max(lvl) FROM over)
  LEFT JOIN over u ON u.lvl = s.lvl AND u.pos = xor(r.pos >> s.lvl, 1)),
paths AS (
  SELECT lang, leaf_pos, coalesce(string_agg(h, '' ORDER BY lvl), '') AS proof,
    list(CASE WHEN odd = 1 THEN 'L' ELSE 'R' END || coalesce(h, '') ORDER BY lvl) AS path
  FROM steps GROUP BY lang, leaf_pos),
folded AS (
  SELECT p.doc_id, p.leaf, r.subroot, (SELECT h FROM over WHERE n = 1) AS root, sha256(coalesce(s.proof, '')) AS proof_sha256,
    list_reduce(list_prepend(p.changed, coalesce(s.path, [])),
                lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN paths s ON s.lang IS NOT DISTINCT FROM p.lang AND s.leaf_pos = p.pos)
SELECT *, folded_root = root AS verified FROM folded
"""

TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP11_SQL = f"""
WITH
docs AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS terms FROM documents WHERE text IS NOT NULL),
items AS (SELECT row_number() OVER () AS i, item_id, list_distinct({TERMS}) AS terms FROM benchmark WHERE text IS NOT NULL),
stats AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
counts AS (SELECT r, doc_id, term, len AS n, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(terms)::BIGINT AS len, unnest(terms) AS term FROM docs) GROUP BY r, doc_id, term, len),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, stats GROUP BY term, n_docs),
wanted AS (SELECT i, item_id, unnest(terms) AS term FROM items),
scored AS (SELECT i, item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term), stats GROUP BY i, item_id, r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
