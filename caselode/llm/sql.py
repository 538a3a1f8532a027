"""The same results as SQL for DuckDB, for the operators that SQL can express."""

from .mixing import COPIES, SEED, SHARE, WEIGHTS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORD = r"[^\x20\x09-\x0D]+"
_LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

JACCARD = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE_WORD}') AS ws FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_aggregate(ws[i : i + 3], 'string_agg', ' ') AS s
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM words WHERE len(ws) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * c >= 85 * (a.n + b.n - c)
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)
"""

DECONTAMINATE = rf"""
WITH items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '{_LETTER_WORD}') AS ws FROM benchmark
), wins AS (
    SELECT DISTINCT item_id, k, list_aggregate(ws[i : i + k - 1], 'string_agg', ' ') AS win
    FROM (SELECT item_id, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i
          FROM items WHERE len(ws) > 0)
), docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTER_WORD}') AS ws FROM documents
), places AS (
    SELECT doc_id, k, i, list_aggregate(ws[i : i + k - 1], 'string_agg', ' ') AS win
    FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
          FROM docs CROSS JOIN (SELECT DISTINCT k FROM wins) WHERE len(ws) >= k)
), hits AS (
    SELECT doc_id, p.k, i, item_id FROM places p JOIN wins ON p.k = wins.k AND p.win = wins.win
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

MIXING = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}')) AS size FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size,
        {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
    FROM docs GROUP BY source
), rates AS (
    SELECT 0 AS step, {SHARE} * sum(source_size) / greatest(sum(weight), 1) AS rate, 0::BIGINT AS n_over FROM sources
    UNION ALL
    SELECT step + 1, (budget - over_size) / rest, over_n FROM (
        SELECT step, rate, n_over,
            (SELECT {SHARE} * sum(source_size) FROM sources) AS budget,
            (SELECT count(*) FROM sources WHERE weight * rate > {COPIES} * source_size) AS over_n,
            (SELECT sum({COPIES} * source_size) FROM sources WHERE weight * rate > {COPIES} * source_size) AS over_size,
            (SELECT sum(weight) FROM sources WHERE NOT weight * rate > {COPIES} * source_size) AS rest
        FROM rates
    ) WHERE over_n > n_over AND rest IS NOT NULL
), goal AS (
    SELECT source, source_size,
        least(weight * (SELECT rate FROM rates ORDER BY step DESC LIMIT 1), CAST({COPIES} * source_size AS DOUBLE)) AS target
    FROM sources
), queue AS (
    SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, CAST(target AS DOUBLE) AS target,
        sum(size) OVER (PARTITION BY d.source ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), doc_id
                        ROWS UNBOUNDED PRECEDING) - size AS before
    FROM docs d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
    CAST(greatest(least(floor(target) - before, size), 0)
       + greatest(least(floor(target) - before - source_size, size), 0) AS BIGINT) AS taken
FROM queue
"""

WARC = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
    SELECT page_id, payload_bytes,
        list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)),
            'string_agg', '') AS payload_digest,
        min(page_id) OVER (PARTITION BY hex) AS first
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM named
"""

LINE_DEDUP = r"""
WITH raw AS (
    SELECT doc_id, i, ls[i] AS line, regexp_matches(ls[i], '[^\x20\x09-\x0D]') AS has
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))
), lines AS (
    SELECT doc_id, i, line, row_number() OVER d AS p, count(*) OVER (PARTITION BY doc_id) AS n FROM raw WHERE has
    WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), windows AS (
    SELECT doc_id, p, least(n, 3) AS size, [line, lead(line, 1) OVER d, lead(line, 2) OVER d] AS win, n FROM lines
    WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), kept AS (
    SELECT doc_id, p, size, win FROM windows WHERE p <= greatest(n - 2, 1)
), later AS (
    SELECT doc_id, p, row_number() OVER (PARTITION BY size, win ORDER BY doc_id, p) AS occurrence FROM kept
), gone AS (
    SELECT DISTINCT l.doc_id, l.i FROM later w JOIN lines l
    ON l.doc_id = w.doc_id AND l.p BETWEEN w.p AND w.p + 2 WHERE occurrence > 1
), texts AS (
    SELECT doc_id, count(*) FILTER (has) AS n_lines, count(g.i) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY r.i) FILTER (g.i IS NULL), '') AS text
    FROM raw r LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(t.text) AS text_sha256
FROM documents LEFT JOIN texts t USING (doc_id)
"""

_LEAF = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")
)
_LOWERED = _LOWER.replace("coalesce(text, '')", "text")
_CRC32 = """list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT),
    lambda crc, b: list_reduce([xor(crc, b)] || list_transform(range(8), lambda i: 0::BIGINT),
        lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))"""
_RUN_HASH = "sha256(string_agg(h, '' ORDER BY i))"

MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, sha256({_LEAF.format(text="text")}) AS leaf,
        CASE WHEN xor({_CRC32}, 4294967295) % 5 = 0 THEN sha256({_LEAF.format(text=_LOWERED)}) END AS tampered
    FROM documents
), grps AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) AS n FROM leaves GROUP BY source
), placed AS (
    SELECT l.doc_id, g, n, leaf, tampered,
        row_number() OVER (PARTITION BY g ORDER BY l.doc_id NULLS FIRST, leaf) - 1 AS i
    FROM leaves l JOIN grps ON l.source IS NOT DISTINCT FROM grps.source
), nodes AS (
    SELECT 0 AS level, g, i, n, leaf AS h FROM placed
    UNION ALL
    SELECT any_value(level) + 1, g, i // 16, any_value(n + 15) // 16, {_RUN_HASH} FROM nodes WHERE n > 1 GROUP BY g, i // 16
), subroots AS (
    SELECT g, h FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, g AS i, (SELECT count(*) FROM subroots) AS n, h FROM subroots
    UNION ALL
    SELECT any_value(level) + 1, i // 16, any_value(n + 15) // 16, {_RUN_HASH} FROM tops WHERE n > 1 GROUP BY i // 16
), inside AS (
    SELECT row_number() OVER () AS r, doc_id, g, 0 AS level, i, n, leaf, coalesce(tampered, leaf) AS cur, '' AS proof FROM placed
    UNION ALL
    SELECT r, any_value(p.doc_id), any_value(p.g), any_value(p.level) + 1, any_value(p.i // 16), any_value(p.n + 15) // 16, any_value(leaf),
        sha256(string_agg(CASE WHEN s.i = p.i THEN cur ELSE h END, '' ORDER BY s.i)),
        any_value(proof) || coalesce(string_agg(h, '' ORDER BY s.i) FILTER (s.i <> p.i), '')
    FROM inside p JOIN nodes s ON s.g = p.g AND s.level = p.level AND s.i // 16 = p.i // 16 WHERE p.n > 1 GROUP BY r
), above AS (
    SELECT r, doc_id, g, 0 AS level, g AS i, (SELECT count(*) FROM subroots) AS n, leaf, cur, proof FROM inside WHERE n = 1
    UNION ALL
    SELECT r, any_value(p.doc_id), any_value(p.g), any_value(p.level) + 1, any_value(p.i // 16), any_value(p.n + 15) // 16, any_value(leaf),
        sha256(string_agg(CASE WHEN s.i = p.i THEN cur ELSE h END, '' ORDER BY s.i)),
        any_value(proof) || coalesce(string_agg(h, '' ORDER BY s.i) FILTER (s.i <> p.i), '')
    FROM above p JOIN tops s ON s.level = p.level AND s.i // 16 = p.i // 16 WHERE p.n > 1 GROUP BY r
)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.h AS verified
FROM above JOIN subroots s USING (g) JOIN tops t ON t.n = 1 WHERE above.n = 1
"""

HARD_NEGATIVES = """
WITH vecs AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM vecs a JOIN vecs b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id,
    positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLE_SQL = {
    "op2_jaccard_join": JACCARD,
    "op3_decontaminate": DECONTAMINATE,
    "op5_mixing": MIXING,
    "op9_warc": WARC,
    "op10_line_dedup": LINE_DEDUP,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_merkle_manifest": MERKLE,
}
