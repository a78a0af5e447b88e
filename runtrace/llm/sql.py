"""DuckDB SQL for the queries that it can express."""

from __future__ import annotations


def _escaped(column: str) -> str:
    """A text with one more backslash in each control string."""
    angle = r"regexp_replace(TEXT, '(<)(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>)', '\1\2\\\3', 'g')"
    square = r"regexp_replace(ANGLE, '(\[)(\\*)(INST\]|/INST\])', '\1\2\\\3', 'g')"
    return square.replace("ANGLE", angle).replace("TEXT", column)


_ROLE = _escaped(r"replace(replace(role, '\', '\\'), chr(10), '\n')")

OP3 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length({_ROLE}) + 1 + length({_escaped('text')}) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP5 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY n, h) AS first_id FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i::INT, 5))::INT >> b) & 31), 1)), '')), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 13) AS n, array_to_string(words[i:i + 12], ' ') AS said
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)
),
docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs),
said AS (
  SELECT p.doc_id, p.i, s.n, array_to_string(p.words[p.i:p.i + s.n - 1], ' ') AS said
  FROM places p JOIN (SELECT DISTINCT n FROM windows) s ON p.i + s.n - 1 <= len(p.words)
),
hits AS (SELECT doc_id, i, s.n, item FROM said s JOIN windows w ON s.n = w.n AND s.said = w.said),
words_hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1
),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(words), false) AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""

OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
  ) p JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * shared >= 80 * (m.n + n.n - shared)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY 1) LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY 1) USING (doc_id)
"""

_CRC_TABLE = "(SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)"


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text; `t` is the column of `_CRC_TABLE`."""
    step = "xor(c >> 8, t[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda s: CASE WHEN s = '' THEN 0 ELSE ascii(s) END::BIGINT), lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


def _said(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"


_LEAF = "sha256(" + " || ".join(_said(c) for c in ("doc_id", "source", "lang", "n_chars", "TEXT")) + ")"
_TAMPERED = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


def _levels(name: str, leaves: str) -> str:
    """CTEs: `name`_up, the nodes of each level of each tree, and `name`_path, the siblings of each first node."""
    return f"""
{name}_up AS (
  SELECT 0::BIGINT AS level, tree, i, n, node FROM {leaves}
  UNION ALL
  SELECT level + 1, tree, i // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY i)) FROM {name}_up WHERE n > 1 GROUP BY 1, 2, 3, 4
), {name}_path AS (
  SELECT c.tree, c.i, p.level, coalesce(string_agg(s.node, '' ORDER BY s.i) FILTER (s.i < p.at), '') AS l,
    coalesce(string_agg(s.node, '' ORDER BY s.i) FILTER (s.i > p.at), '') AS r
  FROM {leaves} c, LATERAL (SELECT level, min(i) AS least, c.i // (3 ** level)::BIGINT AS at FROM {name}_up u WHERE u.tree = c.tree AND u.n > 1 GROUP BY level) p
  JOIN {name}_up s ON s.tree = c.tree AND s.level = p.level AND s.i // 3 = p.at // 3
  GROUP BY 1, 2, 3, p.at
), {name}_top AS (SELECT tree, node AS top, level AS height FROM {name}_up WHERE n = 1)"""


OP13 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_LEAF.replace('TEXT', 'text')} AS leaf, {_LEAF.replace('TEXT', _TAMPERED)} AS stored
  FROM documents, {_CRC_TABLE}
), placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d
), own AS (SELECT tree, i, n, leaf AS node FROM placed), {_levels('a', 'own')},
subroots AS (SELECT 0 AS tree, tree AS i, (SELECT count(*) FROM a_top) AS n, top AS node FROM a_top), {_levels('b', 'subroots')},
steps AS MATERIALIZED (
  SELECT tree, i, level, l, r FROM a_path
  UNION ALL SELECT o.tree, o.i, t.height + p.level, p.l, p.r FROM own o JOIN a_top t USING (tree) JOIN b_path p ON p.i = o.tree
), folded AS (
  SELECT tree, i, 0::BIGINT AS level, stored AS node FROM placed
  UNION ALL SELECT f.tree, f.i, f.level + 1, sha256(s.l || f.node || s.r) FROM folded f JOIN steps s USING (tree, i, level)
), last AS (SELECT tree, i, arg_max(node, level) AS folded_root FROM folded GROUP BY 1, 2),
proofs AS (SELECT tree, i, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM steps GROUP BY 1, 2)
SELECT doc_id, leaf, t.top AS subroot, z.top AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = z.top AS verified
FROM placed JOIN a_top t USING (tree) CROSS JOIN b_top z JOIN last USING (tree, i) LEFT JOIN proofs USING (tree, i)
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source
), w AS (SELECT *, [5, 2, 1][1 + i % 3] AS weight, (SELECT sum(size) FROM d) AS total FROM s),
filled AS (  -- sources by the level at which they are full; k of them are full at the end
  SELECT *, row_number() OVER o AS k, coalesce(sum(3 * source_size) OVER (o ROWS UNBOUNDED PRECEDING), 0) AS given,
    sum(weight) OVER () - sum(weight) OVER (o ROWS UNBOUNDED PRECEDING) AS rest
  FROM w WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, i)
), levels AS (
  SELECT 0 AS k, max(total)::DOUBLE / sum(weight)::DOUBLE AS level, (SELECT min(3.0::DOUBLE * source_size / weight) FROM filled) AS next FROM filled
  UNION ALL SELECT k, (total - given)::DOUBLE / rest::DOUBLE, lead(3.0::DOUBLE * source_size / weight) OVER (ORDER BY k) FROM filled WHERE rest > 0
), level AS (SELECT level FROM levels WHERE next IS NULL OR level < next ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * level) AS target FROM w, level),
placed AS (
  SELECT d.doc_id, d.size, source_size, target, floor(target)::BIGINT AS words,
    sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || doc_id), doc_id, size) - size AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
  (words // source_size) * size + greatest(0, least(place + size, words % source_size) - place) END::BIGINT AS taken
FROM placed
"""

SQL = {"op8_jaccard_join": OP8, "op1_decontaminate": OP1, "op3_chat_format": OP3, "op5_warc": OP5, "op12_mixing": OP12, "op13_merkle_manifest": OP13}
