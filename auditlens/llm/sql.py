"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

NEAR = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents WHERE text IS NOT NULL),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS r(i) WHERE len(ws) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM both_of JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
  WHERE 100 * both_n >= 85 * (na.n_shingles + nb.n_shingles - both_n)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT reach.node, link.b FROM reach JOIN link ON link.a = reach.other),
c AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents AS d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to FROM g
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
reach AS (SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT reach.node, link.b FROM reach JOIN link ON link.a = reach.other),
c AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings AS e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

HARD_NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(range(1, least(len(a.e), len(b.e)) + 1), lambda i: a.e[i] * b.e[i]))::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_FIELDS = "doc_id source lang n_chars".split()


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in _FIELDS]
    return f"sha256({' || '.join(parts)} || coalesce(strlen({text}) || ':' || {text}, '-'))"


# CRC-32 of the decimal identifier, bit by bit
_BYTE = "CASE WHEN i % 8 = 0 THEN xor(c, ascii(id[i // 8 + 1])) ELSE c END"
_CRC = (f"xor(list_reduce(range(8 * strlen(id)), lambda c, i: xor(({_BYTE}) >> 1, "
        f"3988292384 * (({_BYTE}) & 1)), 4294967295::BIGINT), 4294967295::BIGINT)")
_LOWERED = f"translate(text, '{_UPPER}', '{_LOWER}')"


def _levels(name: str, leaves: str) -> str:
    """Tables of a tree: <name> (g, lvl, idx, n, h), <name>_kin (g, lvl, idx, lft, rgt)."""
    return f"""
{name} AS (SELECT g, 0 AS lvl, idx, n, h FROM {leaves}
  UNION ALL SELECT g, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY g, lvl, idx // 8, n),
{name}_kin AS MATERIALIZED (SELECT g, lvl, idx,
  coalesce(string_agg(h, '' ORDER BY idx) OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
  coalesce(string_agg(h, '' ORDER BY idx) OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY g, lvl, idx // 8 ORDER BY idx))"""


MERKLE = f"""
WITH RECURSIVE
leaves AS MATERIALIZED (SELECT doc_id, g, leaf AS h, claimed,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n
  FROM (SELECT doc_id, coalesce(':' || lang, '-') AS g, {_leaf("text")} AS leaf,
    CASE WHEN crc32 % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf("text")} END AS claimed
    FROM (SELECT *, {_CRC} AS crc32 FROM (SELECT *, doc_id::VARCHAR AS id FROM documents)))),
{_levels("docs", "leaves")},
subs AS MATERIALIZED (SELECT '' AS g, g AS own, h, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n
  FROM docs WHERE n = 1),
{_levels("tops", "subs")},
walk AS (SELECT doc_id, g, 0 AS tree, 0 AS lvl, idx, h AS leaf, claimed AS acc, '' AS kin FROM leaves
  UNION ALL SELECT doc_id, w.g, w.tree, w.lvl + 1, w.idx // 8, leaf, sha256(lft || acc || rgt), kin || lft || rgt
    FROM walk AS w JOIN docs_kin AS k ON w.tree = 0 AND k.g = w.g AND k.lvl = w.lvl AND k.idx = w.idx),
upper AS (SELECT w.doc_id, w.g, d.h AS subroot, 0 AS lvl, s.idx, leaf, acc, kin
    FROM walk AS w JOIN docs AS d ON d.n = 1 AND d.g = w.g AND d.lvl = w.lvl JOIN subs AS s ON s.own = w.g
  UNION ALL SELECT doc_id, u.g, subroot, u.lvl + 1, u.idx // 8, leaf, sha256(lft || acc || rgt), kin || lft || rgt
    FROM upper AS u JOIN tops_kin AS k ON k.lvl = u.lvl AND k.idx = u.idx)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(kin) AS proof_sha256, acc AS folded_root, acc = t.h AS verified
FROM upper AS u JOIN tops AS t ON t.n = 1 AND t.lvl = u.lvl
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_minhash_near_dedup": NEAR, "op5_warc_chunks": WARC, "op7_exact_dedup": EXACT,
            "op11_embedding_near_dedup": NEAR_VECTORS, "op12_merkle_manifest": MERKLE,
            "op13_hard_negatives": HARD_NEGATIVES}
