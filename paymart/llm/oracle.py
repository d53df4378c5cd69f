"""DuckDB SQL of the operator queries that SQL can express."""

from __future__ import annotations

#: Distinct 5-word shingles as strings; exact Jaccard over shared shingles; components by repeated minimum.
OP1 = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT r, doc_id,
         CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words),
items AS MATERIALIZED (SELECT r, unnest(s) AS h FROM sets),
pairs AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, count(*) AS both
  FROM items a JOIN items b ON a.h = b.h AND a.r < b.r GROUP BY a.r, b.r),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM pairs p JOIN sets x ON x.r = p.a JOIN sets y ON y.r = p.b
  WHERE 100 * p.both >= 75 * (len(x.s) + len(y.s) - p.both)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (
  SELECT r, r FROM sets
  UNION
  SELECT reach.a, e.b FROM reach JOIN both_ways e ON e.a = reach.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id,
       s.doc_id IS NOT DISTINCT FROM min(t.doc_id) AS kept
FROM sets s JOIN reach ON reach.a = s.r JOIN sets t ON t.r = reach.b
GROUP BY s.r, s.doc_id, s.s
"""

#: Turns joined in order; the template adds 12 + 1 + 11 characters a turn and one for each escaped opening.
OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + len(regexp_extract_all(role, '[\\\n]')) + len(regexp_extract_all(role, '<\\*\|'))
                + length(text) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

#: Every pair of vectors, and the components of the links.
OP6 = """
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS MATERIALIZED (
  SELECT r, e FROM vectors
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (
  SELECT r, r FROM vectors
  UNION
  SELECT reach.a, l.b FROM reach JOIN links l ON l.a = reach.b),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(any_value(c.n), 0) AS n_links, min(t.vec_id) AS component_id,
       v.vec_id IS NOT DISTINCT FROM min(t.vec_id) AS kept
FROM vectors v JOIN reach ON reach.a = v.r JOIN vectors t ON t.r = reach.b LEFT JOIN counts c ON c.a = v.r
GROUP BY v.r, v.vec_id
"""

#: Every 35-word window as a string, counted; the words that a repeated one covers are left out.
OP11 = r"""
WITH words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
places AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM words),
windows AS MATERIALIZED (SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h FROM places),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS MATERIALIZED (SELECT DISTINCT r, i + k AS i FROM (SELECT r, i FROM windows SEMI JOIN twice USING (h)), range(35) AS t(k)),
each AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (r, i) GROUP BY r),
cut AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (r) LEFT JOIN cut USING (r)
"""

#: The table of the unsigned crc32, made by its rule.
_CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32(codes: str) -> str:
    """The unsigned crc32 of a list of byte values, next to ``crc``."""
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}),"
        " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    )


_CODES = "list_transform(string_split({}, ''), lambda x: CAST(unicode(x) AS BIGINT))"

#: Runs with their made faults, all pairs of words by edit distance on one byte a letter, forms followed to their end.
OP12 = r"""
WITH RECURSIVE """ + _CRC_TABLE + r""",
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[a-zÀ-ÿ]+')) AS run FROM documents),
found AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
coded AS (
  SELECT run, n, """ + _crc32("flatten(list_transform(" + _CODES.format("CAST(doc_id AS VARCHAR) || ':' || run")
                              + ", lambda x: CASE WHEN x < 128 THEN [x] ELSE [195, x - 64] END))") + r""" AS h
  FROM found, crc),
made AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
  FROM coded),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n,
         array_to_string(list_transform(string_split(word, ''), lambda x: CASE WHEN unicode(x) < 128 THEN x ELSE chr(unicode(x) - 191) END), '') AS b
  FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
near AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n FROM words x JOIN words y ON length(y.b) BETWEEN length(x.b) - 1 AND length(x.b) + 1
  WHERE x.word <> y.word AND levenshtein(x.b, y.b) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(other)) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
chain(word, upto) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.upto WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.upto AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c USING (word) JOIN formed l ON l.word = c.upto WHERE l.form IS NULL
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({1}) || ':' || {1} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c, f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"

#: All levels of all trees, then the siblings of every node, folded level by level.
OP13 = r"""
WITH RECURSIVE """ + _CRC_TABLE + r""",
made AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, """ + _LEAF.format(_FIELD.format("text", "text")) + r""" AS leaf,
         """ + _LEAF.format(_FIELD.format("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")) + r""" AS lowered,
         """ + _crc32(_CODES.format("CAST(doc_id AS VARCHAR)")) + r""" AS h
  FROM documents, crc),
leaves AS MATERIALIZED (
  SELECT r, doc_id, source, leaf, CASE WHEN h % 5 = 0 THEN lowered ELSE leaf END AS changed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size
  FROM made),
up(source, level, pos, size, node) AS (
  SELECT source, 0, pos, size, leaf FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 16, any_value((size + 15) // 16), sha256(string_agg(node, '' ORDER BY pos)) FROM up WHERE size > 1
  GROUP BY source, level, pos // 16),
ends AS MATERIALIZED (
  SELECT source, level, node, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM up WHERE size = 1),
top(level, pos, size, node) AS (
  SELECT 0, pos, size, node FROM ends
  UNION ALL
  SELECT level + 1, pos // 16, any_value((size + 15) // 16), sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE size > 1
  GROUP BY level, pos // 16),
root AS (SELECT node AS root FROM top WHERE size = 1),
all_nodes AS (
  SELECT 0 AS tree, source, level, pos, size, node FROM up UNION ALL SELECT 1, NULL, level, pos, size, node FROM top),
sides AS MATERIALIZED (
  SELECT tree, source, level, pos,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS g
  FROM all_nodes WHERE size > 1 WINDOW w AS (PARTITION BY tree, source, level, pos // 16 ORDER BY pos)),
steps AS MATERIALIZED (
  SELECT v.r, s.tree, s.level, s.l, s.g FROM leaves v JOIN ends e ON e.source IS NOT DISTINCT FROM v.source
  JOIN sides s ON s.tree = 0 AND s.source IS NOT DISTINCT FROM v.source AND s.pos = v.pos // CAST(pow(16, s.level) AS BIGINT)
  UNION ALL
  SELECT v.r, s.tree, s.level, s.l, s.g FROM leaves v JOIN ends e ON e.source IS NOT DISTINCT FROM v.source
  JOIN sides s ON s.tree = 1 AND s.pos = e.pos // CAST(pow(16, s.level) AS BIGINT)),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY r ORDER BY tree, level) AS k FROM steps),
folded(r, k, node) AS (
  SELECT r, 1, changed FROM leaves
  UNION ALL SELECT f.r, f.k + 1, sha256(s.l || f.node || s.g) FROM folded f JOIN numbered s ON s.r = f.r AND s.k = f.k),
proofs AS (SELECT r, sha256(string_agg(l || g, '' ORDER BY k)) AS proof FROM numbered GROUP BY r),
last AS (SELECT r, max_by(node, k) AS node FROM folded GROUP BY r)
SELECT v.doc_id, v.leaf, e.node AS subroot, root.root, coalesce(p.proof, sha256('')) AS proof_sha256,
       z.node AS folded_root, z.node = root.root AS verified
FROM leaves v JOIN ends e ON e.source IS NOT DISTINCT FROM v.source JOIN last z ON z.r = v.r LEFT JOIN proofs p ON p.r = v.r, root
"""

ORACLE = {
    "op1_minhash_near_dedup": OP1, "op3_chat_formatting": OP3, "op6_cap_near_vectors": OP6,
    "op11_level_doubling": OP11, "op12_spelling_tiles": OP12, "op13_merkle_manifest": OP13,
}
