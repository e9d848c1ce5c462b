"""SQL of the manifest, line and spelling queries. CRC-32 is spelled out, since DuckDB has none."""

from __future__ import annotations

#: the remainder table of CRC-32, and the checksum of a list of bytes by it
CRC_TABLE = """
SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc
"""
CRC = "xor(list_reduce(list_prepend(4294967295, {}), lambda c, b: xor(c // 256, crc[xor(c, b) % 256 + 1])), 4294967295)"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


MANIFEST_SQL = rf"""
WITH RECURSIVE t AS ({CRC_TABLE}), d AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {CRC.format("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS claimed
  FROM documents, t
), s AS (SELECT source, row_number() OVER (ORDER BY source ASC NULLS FIRST) - 1 AS tree, count(*) AS n FROM d GROUP BY source
), p AS (SELECT d.*, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), up AS (
  SELECT tree, 0 AS level, n AS width, pos, leaf AS node FROM p
  UNION ALL
  SELECT tree, level + 1, (width + 2) // 3, pos // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM up WHERE width > 1 GROUP BY tree, level, width, pos // 3
), top AS (
  SELECT 0 AS level, (SELECT count(*) FROM s) AS width, tree AS pos, node FROM up WHERE width = 1
  UNION ALL
  SELECT level + 1, (width + 2) // 3, pos // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE width > 1 GROUP BY level, width, pos // 3
), sides AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lhs,
    coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rhs
  FROM up a JOIN up b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.width > 1 GROUP BY ALL
), above AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lhs,
    coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rhs
  FROM top a JOIN top b ON a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.width > 1 GROUP BY ALL
), fold AS (
  SELECT r, tree, 0 AS level, pos, coalesce(claimed, leaf) AS node, '' AS proof FROM p
  UNION ALL
  SELECT f.r, f.tree, f.level + 1, f.pos // 3, sha256(lhs || node || rhs), proof || lhs || rhs FROM fold f JOIN sides USING (tree, level, pos)
), mid AS (SELECT r, tree, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM fold GROUP BY r, tree
), outer_fold AS (
  SELECT r, 0 AS level, tree AS pos, node, proof FROM mid
  UNION ALL
  SELECT f.r, f.level + 1, f.pos // 3, sha256(lhs || node || rhs), proof || lhs || rhs FROM outer_fold f JOIN above USING (level, pos)
), ends AS (SELECT r, arg_max(node, level) AS folded_root, arg_max(proof, level) AS proof FROM outer_fold GROUP BY r)
SELECT doc_id, leaf, u.node AS subroot, o.node AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = o.node AS verified
FROM p JOIN ends USING (r) JOIN up u ON u.tree = p.tree AND u.width = 1 JOIN top o ON o.width = 1
"""

LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'none')) >= 5
), g AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.last AS goes FROM k LEFT JOIN c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM g GROUP BY r
"""

#: UTF-8 of a document's id, a colon and a run, whose letters beyond ASCII take two bytes
RUN_BYTES = """flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))"""

VARIANTS_SQL = rf"""
WITH RECURSIVE t AS ({CRC_TABLE}), o AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), u AS (SELECT doc_id, run, count(*) AS n FROM o WHERE length(run) >= 6 GROUP BY doc_id, run
), h AS (SELECT run, n, {CRC.format(RUN_BYTES)} AS h FROM u, t
), w AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short, substr(word, i, 1) AS c FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.short = b.short AND a.c <> b.c
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.short = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.short = b.word
), best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS step FROM f
  UNION ALL
  SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL
), ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""
