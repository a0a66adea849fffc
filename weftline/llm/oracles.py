"""DuckDB SQL for the results of the queries, where SQL can express them."""

from __future__ import annotations

from weftline.llm import vector_codes

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DEDUP = rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
    e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node WHERE r.root < e.y),
    c AS (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""


def vector_codes_sql() -> str:
    """Every round is a few tables: distances to all entries, the nearest, the new means."""
    parts = [
        "k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "p AS MATERIALIZED (SELECT vec_id, part::INT AS part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x FROM k, range(4) r(part))",
        f"f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k QUALIFY entry < {vector_codes.ENTRIES})",
        "c0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN f USING (vec_id))",
    ]
    for i in range(vector_codes.ROUNDS + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT vec_id, part, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': entry}}) AS best FROM p JOIN c{i} USING (part) GROUP BY ALL)")
        if i < vector_codes.ROUNDS:
            parts.append(f"u{i} AS (SELECT part, best.e AS entry, unnest(x) AS x, generate_subscripts(x, 1) AS pos FROM a{i} JOIN p USING (vec_id, part))")
            parts.append(f"m{i} AS (SELECT part, entry, pos, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM u{i} GROUP BY ALL)")
            parts.append(f"l{i} AS (SELECT part, entry, list(x ORDER BY pos) AS c FROM m{i} GROUP BY ALL)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.part, c{i}.entry, coalesce(l{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN l{i} USING (part, entry))")
    last = vector_codes.ROUNDS
    parts.append(f"s AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(c) AS x, generate_subscripts(c, 1) AS pos FROM c{last}))")
    parts.append(f"o AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{last} GROUP BY 1)")
    return f"WITH {', '.join(parts)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o JOIN k USING (vec_id), s"


#: CRC-32 over the bytes of a key, by a table of 256 remainders that is built on the way.
_CRC = """
    t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab),
    h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) % 20 AS harm
        FROM conversations, t)"""

#: One step of the recursion consumes one row: by state (0 nothing, 1 after s, 2 after u, 3 after a)
#: the least cost and audit. `i` holds the insertions that lead from state to state.
REPAIR = f"""
    WITH RECURSIVE {_CRC},
    d AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE harm <> 0),
    o AS (SELECT conv_id, turn, role, text, left(role, 1) AS ini, row_number() OVER w AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS cut
        FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
    f AS MATERIALIZED (SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(cut, '[.!?]$') THEN 'truncated' ELSE 'sound' END AS fault, lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM o),
    i(s, z, ins) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
    g(s, ini, z) AS (VALUES (0, 'u', 2), (0, 's', 1), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    b AS (
        SELECT conv_id, 0::BIGINT AS pos, z AS s, {{'cost': 2 * ins, 'audit': repeat('I', ins)}} AS best FROM (SELECT DISTINCT conv_id FROM f), i WHERE i.s = 0
        UNION ALL
        SELECT conv_id, pos, z, min({{'cost': cost + 2 * ins, 'audit': audit || repeat('I', ins)}})
        FROM (SELECT b.conv_id, f.pos, e.z AS s, b.best.cost + e.cost + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 1 ELSE 0 END AS cost, b.best.audit || e.edit AS audit
              FROM b JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.pos = b.pos + 1
              JOIN (SELECT s, z, ini, 'K' AS edit, 0 AS cost FROM g UNION ALL SELECT s, z, ini, 'R', 2 FROM g WHERE ini <> 's' UNION ALL SELECT DISTINCT s, s, '', 'D', 3 FROM g) e
              ON e.s = b.s AND (e.edit = 'D' OR f.fault IN ('truncated', 'sound') AND (e.edit = 'R' OR e.ini = f.ini))) y JOIN i USING (s) GROUP BY ALL),
    n AS (SELECT conv_id, count(*) AS n, greatest(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
    z AS (SELECT n.*, min(best) AS best FROM n JOIN b ON b.conv_id IS NOT DISTINCT FROM n.conv_id AND b.pos = n.n AND b.s IN (0, 3) GROUP BY ALL),
    x AS (SELECT conv_id, unnest(string_split(best.audit, '')) AS edit, generate_subscripts(string_split(best.audit, ''), 1) AS j FROM z WHERE best.audit <> ''),
    y AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS pos, count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS m FROM x),
    q AS (SELECT y.conv_id, y.edit, y.m, f.role, f.text, max(CASE WHEN y.edit = 'K' AND y.m = 1 AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY y.conv_id) AS s
        FROM y LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM y.conv_id AND f.pos = y.pos AND y.edit <> 'I' WHERE y.edit <> 'D'),
    t2 AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY m) AS whole FROM q GROUP BY 1),
    c AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
        coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
    FROM c LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t2 ON t2.conv_id IS NOT DISTINCT FROM c.conv_id
"""
