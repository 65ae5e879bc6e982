"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_SPACED = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = rf"""
WITH RECURSIVE words AS (SELECT doc_id, {_SPACED} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r USING (doc_id) GROUP BY s.doc_id, s.s
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS i FROM b)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hits AS (SELECT doc_id, item_id, n, i FROM dw JOIN bw USING (n, x)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids
  FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
# crc32 of a number's digits: each byte is followed by eight shifts, marked -1.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(split(doc_id::VARCHAR, ''),
    lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b < 0 THEN xor(a >> 1, 3988292384 * (a & 1)) ELSE xor(a, b) END), 4294967295)"""


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


def _tree(name: str, leaves: str) -> str:
    """Levels of 8-ary trees over ``leaves`` (g, i, node), and the siblings of each node that has a run above it."""
    return f"""
{name}(g, level, i, node, n) AS (
  SELECT g, 0::BIGINT, i, node, count(*) OVER (PARTITION BY g) FROM ({leaves})
  UNION ALL
  SELECT g, level + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), any_value((n + 7) // 8) FROM {name} WHERE n > 1 GROUP BY g, level, i // 8),
{name}_steps AS (
  SELECT g, level, i, coalesce(string_agg(node, '') OVER before, '') AS l, coalesce(string_agg(node, '') OVER after, '') AS r FROM {name} WHERE n > 1
  WINDOW before AS (PARTITION BY g, level, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (PARTITION BY g, level, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


OP11 = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf(f"translate(text, {_UPPER}, {_LOWER})")} END AS tampered FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed),
{_tree("tree", "SELECT g, i, leaf AS node FROM leaves")},
subroots AS (SELECT g, node AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM tree WHERE n = 1),
{_tree("top", "SELECT '' AS g, i, subroot AS node FROM subroots")},
steps AS (
  SELECT doc_id, v.i, 0 AS part, level, l, r FROM leaves v JOIN tree_steps s ON s.g = v.g AND s.i = v.i // (8 ** level)::BIGINT
  UNION ALL
  SELECT doc_id, v.i, 1, level, l, r FROM leaves v JOIN subroots USING (g) JOIN top_steps s ON s.i = subroots.i // (8 ** level)::BIGINT),
paths AS (SELECT doc_id, string_agg(l || r, '' ORDER BY part, level) AS p, list(l || '|' || r ORDER BY part, level) AS path FROM steps GROUP BY doc_id),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT node FROM top WHERE n = 1) AS root, sha256(coalesce(p, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(path, [])), lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2))) AS folded_root
  FROM leaves JOIN subroots USING (g) LEFT JOIN paths USING (doc_id))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

ORACLE_SQL = {"op1_minhash_near_dedup": OP1, "op9_benchmark_decontamination": OP9, "op11_merkle_manifest": OP11}
