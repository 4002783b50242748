"""SQL counterparts of the registered queries that SQL can express."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: CRC-32 of a column's text of ASCII characters: the register takes in a byte, then eight shifts.
CRC32 = """xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(range(1, strlen({0}) + 1),
        lambda i: list_concat([ascii(substr({0}, i, 1))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295)"""

MERKLE = f"""
    WITH RECURSIVE d AS (
        SELECT lang, doc_id, {_leaf("text")} AS leaf,
               CASE WHEN {CRC32.format("doc_id::VARCHAR")} % 3 = 0
                    THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered
        FROM documents),
    g AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM d)),
    l AS (SELECT g.g, doc_id, leaf, altered, count(*) OVER (PARTITION BY g.g) AS n,
                 row_number() OVER (PARTITION BY g.g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
          FROM d JOIN g ON d.lang IS NOT DISTINCT FROM g.lang),
    t AS (SELECT g, 0 AS lvl, r AS i, leaf AS node, n FROM l
          UNION ALL
          SELECT g, lvl + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8 FROM t WHERE n > 1
          GROUP BY g, lvl, i // 8, n),
    u AS (SELECT 0 AS lvl, g AS i, node, count(*) OVER () AS n FROM t WHERE n = 1
          UNION ALL
          SELECT lvl + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8 FROM u WHERE n > 1
          GROUP BY lvl, i // 8, n),
    f AS (SELECT g, r, 0 AS lvl, r AS i, coalesce(altered, leaf) AS node, '' AS seen, n FROM l
          UNION ALL
          SELECT f.g, f.r, f.lvl + 1, f.i // 8, sha256(string_agg(if(t.i = f.i, f.node, t.node), '' ORDER BY t.i)),
                 f.seen || coalesce(string_agg(t.node, '' ORDER BY t.i) FILTER (WHERE t.i <> f.i), ''), (f.n + 7) // 8
          FROM f JOIN t ON t.g = f.g AND t.lvl = f.lvl AND t.i // 8 = f.i // 8 WHERE f.n > 1
          GROUP BY f.g, f.r, f.lvl, f.i, f.seen, f.n),
    h AS (SELECT g, r, 0 AS lvl, g AS i, node, seen, (SELECT any_value(n) FROM u WHERE lvl = 0) AS n FROM f WHERE n = 1
          UNION ALL
          SELECT h.g, h.r, h.lvl + 1, h.i // 8, sha256(string_agg(if(u.i = h.i, h.node, u.node), '' ORDER BY u.i)),
                 h.seen || coalesce(string_agg(u.node, '' ORDER BY u.i) FILTER (WHERE u.i <> h.i), ''), (h.n + 7) // 8
          FROM h JOIN u ON u.lvl = h.lvl AND u.i // 8 = h.i // 8 WHERE h.n > 1
          GROUP BY h.g, h.r, h.lvl, h.i, h.seen, h.n)
    SELECT l.doc_id, l.leaf, s.node AS subroot, w.node AS root, sha256(h.seen) AS proof_sha256, h.node AS folded_root,
           h.node = w.node AS verified
    FROM l JOIN h ON h.g = l.g AND h.r = l.r AND h.n = 1 JOIN t AS s ON s.g = l.g AND s.n = 1 JOIN u AS w ON w.n = 1"""

ORACLE = {
    "op12_merkle": MERKLE,
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op6_warc": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
             d AS (SELECT page_id, url, octet_length(encode(body)) AS size, sha256(body) AS digest FROM p),
             g AS (SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS least FROM d)
        SELECT page_id, size AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> least THEN least END AS refers_to, url
        FROM g""",
}
