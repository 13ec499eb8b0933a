"""SQL for DuckDB that must give the rows of the operators' queries, where SQL can express them."""

from __future__ import annotations


def _base32(hex_digits: str) -> str:
    """Base 32 of 40 hexadecimal digits: four signs for every five of them."""
    alphabet = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    signs = " || ".join(f"substr({alphabet}, ((v >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0))
    fives = f"list_transform(range(0, 8), lambda i: CAST('0x' || substr({hex_digits}, 5 * i + 1, 5) AS BIGINT))"
    return f"list_aggregate(list_transform({fives}, lambda v: {signs}), 'string_agg', '')"


OP11 = f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (SELECT page_id, strlen(body) AS payload_bytes, {_base32("sha1(body)")} AS payload_digest,
          max(page_id) OVER (PARTITION BY body) AS response FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> response THEN response END AS refers_to
    FROM d
"""

# CRC-32 is linear: the crc of bytes is the exclusive or of what each byte adds at its distance from the end,
# and of the crc of as many zero bytes.
_CRC = """
    bits AS (SELECT n, n AS x, 0 AS step FROM range(256) r(n) UNION ALL
             SELECT n, CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END, step + 1 FROM bits WHERE step < 8),
    crc_table AS MATERIALIZED (SELECT n, x FROM bits WHERE step = 8),
    longest AS (SELECT max(octet_length(encode(feature))) AS l FROM features),
    adds AS (SELECT 0 AS place, n AS byte, x FROM crc_table UNION ALL
             SELECT place + 1, byte, xor(a.x >> 8, t.x) FROM adds a JOIN crc_table t ON t.n = (a.x & 255), longest
             WHERE place + 1 < l),
    zeros AS (SELECT 0 AS len, CAST(4294967295 AS BIGINT) AS x UNION ALL
              SELECT len + 1, xor(z.x >> 8, t.x) FROM zeros z JOIN crc_table t ON t.n = (z.x & 255), longest WHERE len < l),
    bytes AS (SELECT feature, len, len - 1 - i AS place, CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT) AS byte
              FROM (SELECT feature, hex(encode(feature)) AS digits, octet_length(encode(feature)) AS len,
                           unnest(range(octet_length(encode(feature)))) AS i FROM features)),
    crc AS (SELECT feature, xor(xor(bit_xor(a.x), any_value(z.x)), 4294967295) AS crc FROM bytes b
            JOIN adds a ON a.place = b.place AND a.byte = b.byte JOIN zeros z ON z.len = b.len GROUP BY feature)
"""

_RUNS = """
    SELECT {columns}, words, unnest(list_concat(words, list_transform(range(1, len(words)),
           lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM {rows}
"""
_WORDS = r"""
    SELECT {columns}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {rows}
"""

OP12 = f"""
    WITH RECURSIVE docs AS MATERIALIZED ({_WORDS.format(columns="doc_id", rows="documents")}),
    goal AS MATERIALIZED ({_WORDS.format(columns="item_id", rows="benchmark")}),
    doc_runs AS MATERIALIZED (SELECT doc_id, feature, count(*) AS n FROM ({_RUNS.format(columns="doc_id", rows="docs")}) GROUP BY ALL),
    goal_runs AS MATERIALIZED (SELECT feature, count(*) AS n FROM ({_RUNS.format(columns="item_id", rows="goal")}) GROUP BY ALL),
    features AS MATERIALIZED (SELECT feature FROM doc_runs UNION SELECT feature FROM goal_runs),
    {_CRC},
    bucket_of AS MATERIALIZED (SELECT feature, crc % 10000 AS bucket FROM crc),
    s AS (SELECT bucket, sum(n) AS s FROM doc_runs JOIN bucket_of USING (feature) GROUP BY bucket),
    t AS (SELECT bucket, sum(n) AS t FROM goal_runs JOIN bucket_of USING (feature) GROUP BY bucket),
    gain AS (SELECT b AS bucket, floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000))
             / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)))) AS gain
             FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
    weights AS (SELECT doc_id, sum(n) AS n_features, floor(sum(n * gain) / sum(n)) AS weight
                FROM doc_runs JOIN bucket_of USING (feature) JOIN gain USING (bucket) GROUP BY doc_id),
    scores AS (SELECT doc_id, len(words) >= 20 AS fits, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
               CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
               FROM docs LEFT JOIN weights USING (doc_id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place FROM scores)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN fits AND place <= 25 * (SELECT count(*) FROM scores WHERE fits) // 100 THEN place END AS rank
    FROM ranked
"""

_WHOLE = """
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding,
          lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

OP3 = f"""
    WITH e AS MATERIALIZED ({_WHOLE}),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

OP13 = f"""
    WITH e AS MATERIALIZED (SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
                            FROM ({_WHOLE}) WHERE label IS NOT NULL),
    s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
          CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
          FROM e a JOIN e c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(c.v) = len(a.v)),
    p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score,
           score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 10
"""

# Components: the smallest id that links reach, by following links from every node.
_COMPONENTS = """
    edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT r.node, l.b FROM reach r JOIN edges l ON l.a = r.other),
    parts AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
"""

OP5 = f"""
    WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
        AND list_inner_product(x.v, y.v) / sqrt(list_inner_product(x.v, x.v)) / sqrt(list_inner_product(y.v, y.v)) >= 0.95),
    {_COMPONENTS},
    degree AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component, e.vec_id) AS component_id,
           coalesce(component, e.vec_id) = e.vec_id AS kept
    FROM embeddings e LEFT JOIN degree ON degree.a = e.vec_id LEFT JOIN parts ON parts.node = e.vec_id
"""

OP6 = f"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle FROM words WHERE len(w) > 0),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n FROM sets x JOIN sets y
        ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
        WHERE 100 * both_n >= 80 * (s.n + t.n - both_n)),
    {_COMPONENTS}
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
           coalesce(component, d.doc_id) = d.doc_id AS kept
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN parts ON parts.node = d.doc_id
"""

# Two hexadecimal digits stand for each byte.
OP10 = """
    WITH t AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits, strlen(coalesce(text, '')) AS n FROM documents),
    strings AS MATERIALIZED (SELECT doc_id, s, md5_number(substr(digits, 2 * s + 1, 400)) AS string
        FROM (SELECT doc_id, digits, unnest(range(n - 199)) AS s FROM t WHERE n >= 200)),
    twice AS (SELECT doc_id, s FROM strings WHERE string IN (SELECT string FROM strings GROUP BY string HAVING count(*) > 1)),
    marked AS (SELECT doc_id, s, s - 200 > lag(s, 1, -1000) OVER (PARTITION BY doc_id ORDER BY s) AS opens FROM twice),
    numbered AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marked),
    spans AS MATERIALIZED (SELECT doc_id, span, min(s) AS first, max(s) + 200 AS last FROM numbered GROUP BY ALL),
    gaps AS (SELECT doc_id, coalesce(lag(last) OVER w, 0) AS first, first AS last FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY span)
             UNION ALL SELECT doc_id, max(last), CAST(1000000000 AS BIGINT) FROM spans GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(substr(digits, 2 * first + 1, 2 * (last - first)), '' ORDER BY first) AS digits
             FROM gaps JOIN t USING (doc_id) GROUP BY doc_id),
    totals AS (SELECT doc_id, sum(last - first) AS removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept.digits, t.digits))) AS kept_sha256
    FROM t LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
