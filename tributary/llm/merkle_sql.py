"""The Merkle manifest in SQL: one step per tree level, unrolled."""

from __future__ import annotations

#: Levels that are unrolled: groups of up to 3^12 leaves, up to 3^6 groups.
LEAF_LEVELS, GROUP_LEVELS = 12, 6

_FIELD = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"

#: The unsigned crc32 of a decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)],
        flatten([[CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] for c in string_split(CAST({0} AS VARCHAR), '')])),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"""


def _level(nodes: str, paths: str, i: int) -> str:
    """The runs, nodes and paths of level ``i + 1`` from those of level ``i``."""
    left, right = "array_to_string(hs[1:p % 3], '')", "array_to_string(hs[p % 3 + 2:], '')"
    return f"""
{nodes}r{i} AS MATERIALIZED (SELECT g, p // 3 AS q, list(h ORDER BY p) AS hs, any_value(n) AS n FROM {nodes}{i} GROUP BY 1, 2),
{nodes}{i + 1} AS MATERIALIZED (SELECT g, q AS p, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h,
                     (n + 2) // 3 AS n FROM {nodes}r{i}),
{paths}{i + 1} AS MATERIALIZED (SELECT id, k, leaf, x.g, p // 3 AS p,
             CASE WHEN r.n > 1 THEN proof || {left} || {right} ELSE proof END AS proof,
             CASE WHEN r.n > 1 THEN sha256({left} || f || {right}) ELSE f END AS f, subroot
             FROM {paths}{i} x JOIN {nodes}r{i} r ON x.g = r.g AND x.p // 3 = r.q),"""


def manifest_sql() -> str:
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    up = "".join(_level("a", "fa", i) for i in range(LEAF_LEVELS))
    top = "".join(_level("b", "fb", i) for i in range(GROUP_LEVELS))
    return f"""
WITH d AS (SELECT doc_id, source, {leaf('text')} AS leaf,
                  CASE WHEN {_CRC32.format('doc_id')} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")}
                       ELSE {leaf('text')} END AS bad FROM documents),
     s AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS g
           FROM (SELECT DISTINCT source FROM documents)),
     l AS MATERIALIZED (SELECT doc_id AS id, g, leaf, bad,
           row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
           count(*) OVER (PARTITION BY g) AS n
           FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
a0 AS MATERIALIZED (SELECT g, p, leaf AS h, n FROM l),
fa0 AS MATERIALIZED (SELECT id, p AS k, leaf, g, p, '' AS proof, coalesce(bad, leaf) AS f, '' AS subroot FROM l),{up}
b0 AS MATERIALIZED (SELECT 0 AS g, g AS p, h, count(*) OVER () AS n FROM a{LEAF_LEVELS}),
fb0 AS MATERIALIZED (SELECT id, k, leaf, 0 AS g, x.g AS p, proof, f, h AS subroot
                     FROM fa{LEAF_LEVELS} x JOIN a{LEAF_LEVELS} a ON x.g = a.g),{top}
root AS (SELECT h AS root FROM b{GROUP_LEVELS})
SELECT id AS doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM fb{GROUP_LEVELS}, root
"""
