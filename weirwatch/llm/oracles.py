"""Expected results as DuckDB SQL, for the operators whose result SQL can state."""

from __future__ import annotations

_SHINGLES = """
{name}_w AS (
    SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM {table}
),
{name} AS (
    SELECT {key}, unnest(CASE WHEN len(ws) >= 5 THEN list_distinct([array_to_string(ws[i : i + 4], ' ') FOR i IN range(1, len(ws) - 3)])
                              WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
    FROM {name}_w
)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE {_SHINGLES.format(name="sh", key="doc_id", table="documents")},
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, least.component_id, d.doc_id = least.component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

LEAKS = f"""
WITH {_SHINGLES.format(name="sh", key="doc_id", table="documents")},
{_SHINGLES.format(name="item", key="item_id", table="benchmark")},
sizes AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
met AS (SELECT doc_id, item_id, count(*) AS n_shared FROM sh JOIN item USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM met JOIN sizes USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""

# crc32 of a decimal text, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], range(8 * length({0}))), lambda c, i:
    xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii({0}[i // 8 + 1]) ELSE 0 END) >> 1,
        CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN ascii({0}[i // 8 + 1]) ELSE 0 END) % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""


def _row_hash(*values: str) -> str:
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || ({v}::VARCHAR), '-')" for v in values) + "))"


_FOLDED = "sha256(CASE WHEN s.h IS NULL THEN c.folded WHEN c.place % 2 = 1 THEN s.h || c.folded ELSE c.folded || s.h END)"

MERKLE = f"""
WITH RECURSIVE hashed AS (
    SELECT lang, doc_id, {_row_hash("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
           CASE WHEN {_CRC32.format("(doc_id::VARCHAR)")} % 7 = 0 THEN {_row_hash("doc_id", "source", "lang", "(n_chars + 1)", "text")} END AS changed
    FROM documents
),
leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS place
    FROM hashed
),
low AS (
    SELECT tree, 0 AS level, place, leaf AS h, n FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2 FROM low WHERE n > 1 GROUP BY tree, level, place // 2, n
),
subroots AS (SELECT tree, h, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, tree AS place, h, n FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2 FROM high WHERE n > 1 GROUP BY level, place // 2, n
),
climb AS (
    SELECT doc_id, leaf, tree, 0 AS level, place, n, coalesce(changed, leaf) AS folded, '' AS proof FROM leaves
    UNION ALL
    SELECT c.doc_id, c.leaf, c.tree, c.level + 1, c.place // 2, (c.n + 1) // 2, {_FOLDED}, c.proof || coalesce(s.h, '')
    FROM climb c LEFT JOIN low s ON s.tree = c.tree AND s.level = c.level AND s.place = xor(c.place, 1) WHERE c.n > 1
),
ascent AS (
    SELECT c.doc_id, c.leaf, u.h AS subroot, 0 AS level, c.tree AS place, u.n, c.folded, c.proof FROM climb c JOIN subroots u USING (tree) WHERE c.n = 1
    UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.place // 2, (c.n + 1) // 2, {_FOLDED}, c.proof || coalesce(s.h, '')
    FROM ascent c LEFT JOIN high s ON s.level = c.level AND s.place = xor(c.place, 1) WHERE c.n > 1
)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM ascent JOIN (SELECT h FROM high WHERE n = 1) r ON true WHERE n = 1
"""

STATEMENTS = {"op2_near_duplicates": NEAR_DUPLICATES, "op8_benchmark_leaks": LEAKS, "op13_merkle_manifest": MERKLE}
