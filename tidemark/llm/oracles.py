"""DuckDB SQL for the queries of the operators that SQL can express."""

from __future__ import annotations

# CRC-32 of the ASCII text s, bit by bit: a byte comes in as 256 + its value, then each 0 is a step of the polynomial
_CRC = """
    xor(4294967295::BIGINT, list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(s) + 1),
            lambda i: [256 + ascii(substr(s, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: CASE WHEN b >= 256 THEN xor(c, b - 256)
                          ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END) END))
"""

ORACLES: dict[str, str] = {
    "op2_warc": """
        WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        told AS (SELECT page_id, octet_length(body) AS size, sha1(body) AS digest FROM bodies),
        firsts AS (SELECT digest, max(page_id) AS origin FROM told WHERE size >= 1000 GROUP BY digest),
        marked AS (SELECT t.*, CASE WHEN f.origin != t.page_id THEN f.origin END AS refers_to
                   FROM told t LEFT JOIN firsts f ON f.digest = t.digest)
        SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
            CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, true AS intact
        FROM marked
    """,
    "op11_prefix_trie": f"""
        WITH ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
        heads AS (SELECT conv_id, ({_CRC}) % 9 AS h FROM ids),
        said AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n,
                coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        kept AS (
            SELECT c.conv_id, s.n, s.role, s.text FROM heads c JOIN said s ON s.conv_id = c.conv_id - c.conv_id % 5 AND s.n <= c.h
            UNION ALL
            SELECT c.conv_id, s.n, s.role, s.text FROM heads c JOIN said s ON s.conv_id = c.conv_id AND s.n > c.h),
        rebuilt AS (
            SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY n) AS turns FROM kept GROUP BY conv_id),
        paths AS (SELECT i.conv_id, coalesce(r.turns, []) AS turns FROM ids i LEFT JOIN rebuilt r USING (conv_id)),
        visits AS (
            SELECT conv_id, d AS depth, turns[1:d] AS path, d = len(turns) AS ends
            FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM paths)),
        nodes AS (
            SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM visits GROUP BY path),
        linked AS (
            SELECT n.*, p.conv_id AS parent_conv_id,
                CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.path[n.depth].text) END AS own
            FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
        below AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        told AS (SELECT l.*, coalesce(b.n_children, 0) AS n_children FROM linked l LEFT JOIN below b USING (path)),
        sums AS (
            SELECT path[1:d] AS path, sum(own) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
            FROM (SELECT path, own, n_children, unnest(range(0, depth + 1)) AS d FROM told) GROUP BY 1)
        SELECT t.conv_id, t.depth::BIGINT AS depth, t.parent_conv_id, t.n_convs, t.n_children, s.n_leaves,
            s.saved_tokens::BIGINT AS saved_tokens, t.ends_sha256
        FROM told t JOIN sums s USING (path)
    """,
    "op13_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                list_inner_product(a.v, b.v)::BIGINT AS score
            FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
                AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 10
    """,
}
