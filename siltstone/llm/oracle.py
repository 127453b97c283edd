"""The queries of this folder as SQL over the given tables, where SQL can express them."""

from __future__ import annotations

from siltstone.llm import quality

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EMPTY = "'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855'"


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
    SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p
), f AS (
    SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, d.payload_digest,
    CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND payload_bytes >= 100
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
    WHERE 100 * common >= 75 * (x.n + y.n - common)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS node, doc_id AS root FROM documents
    UNION
    SELECT edges.b, reach.root FROM reach JOIN edges ON reach.node = edges.a WHERE reach.root < edges.b
), c AS (
    SELECT node, min(root) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN c ON c.node = d.doc_id
"""

LINES = f"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), k AS (
    SELECT doc_id, i, line, {lowered(f"trim(line, {WHITE})")} AS key FROM l
), r AS (
    SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
    SELECT doc_id, i, line, holder IS NOT NULL AND holder <> doc_id AS gone FROM k LEFT JOIN r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

DECONTAMINATE = f"""
WITH w AS (
    SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
    FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[i:i + 9], ' ') AS win
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (
    SELECT DISTINCT size FROM bw
), dw AS (
    SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS win
    FROM (SELECT doc_id, size, ws, unnest(range(1, len(ws) - size + 2)) AS i FROM w, sizes WHERE len(ws) >= size)
), found AS (
    SELECT doc_id, item_id, i, dw.size FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found)
    GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(sha256(list), {EMPTY}) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _coverage(n: int, kinds: str) -> str:
    """Words in windows of n words that occur in the text before (``again``) or at all more than once (``more``)."""
    return f"""
g{n} AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) > 1 AS more,
        row_number() OVER (PARTITION BY doc_id, win ORDER BY i) > 1 AS again
    FROM (SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS win FROM p WHERE i + {n - 1} <= len(ws))
), c{n} AS (
    SELECT p.doc_id, p.i, p.word, max(CASE WHEN {kinds} THEN p.i END) OVER (
        PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS inside
    FROM p LEFT JOIN g{n} g ON p.doc_id = g.doc_id AND p.i = g.i
)"""


def _quality() -> str:
    word = "'[^\\x20\\x09-\\x0D]+'"
    over = " OR ".join(f"100 * rep{n}_chars > {limit} * word_chars" for n, limit in quality.LIMITS.items())
    windows = ",".join([_coverage(3, "more"), *(_coverage(n, "again") for n in quality.LIMITS)])
    sums = "".join(
        f"LEFT JOIN (SELECT doc_id, sum(length(word)) FILTER (inside) AS rep{n}_chars FROM c{n} GROUP BY doc_id) USING (doc_id) "
        for n in quality.LIMITS
    )
    reps = ", ".join(f"coalesce(rep{n}_chars, 0)::BIGINT AS rep{n}_chars" for n in quality.LIMITS)
    return f"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {word}) AS ws FROM documents
), p AS (
    SELECT doc_id, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), l AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again,
        list_sum(list_transform(regexp_extract_all(line, {word}), lambda x: length(x))) AS chars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM w)
), ll AS (
    SELECT doc_id, count(*) FILTER (again AND chars > 0) AS n_dup_lines, sum(chars) FILTER (again) AS dup_line_chars
    FROM l GROUP BY doc_id
), {windows}, m AS (
    SELECT doc_id, len(ws) AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, {reps}
    FROM w JOIN ll USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) FILTER (inside) AS n_repeat_words FROM c3 GROUP BY doc_id) USING (doc_id)
    {sums}
)
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words
        OR 100 * dup_line_chars > {quality.LINE_LIMIT} * word_chars OR {over}) AS kept
FROM m
"""


_CONTROL = r"'([<\[])(\\*)(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])', '\1\2\\\3', 'g'"

CHAT = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
    SELECT *, length(regexp_replace(text, {_CONTROL})) AS chars,
        length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), {_CONTROL})) AS role_chars,
        role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens
    FROM t
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars + CASE WHEN opens THEN role_chars + {len("<|im_start|>") + 1 + len("<|im_end|>") + 1}
        ELSE {len("<|im_sep|>")} END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

NEGATIVES = """
WITH given AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM given AS a JOIN given AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""

SQL = {
    "op2_arc_to_warc": WARC,
    "op5_hyperminhash": NEAR_DUPLICATES,
    "op6_line_dedup": LINES,
    "op7_decontaminate": DECONTAMINATE,
    "op8_repetition": _quality(),
    "op10_chat_format": CHAT,
    "op12_hard_negatives": NEGATIVES,
}
