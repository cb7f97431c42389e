"""Expected results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from tidemark.llm import urls

SUBSTRINGS = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
    SELECT doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)
), firsts AS (SELECT h, min(doc_id) AS owner FROM windows GROUP BY h
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM windows JOIN firsts USING (h) WHERE owner < doc_id
), words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS text, count(*) AS n
    FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p WHERE gone.p IS NULL GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATE = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), i AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
        list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
), places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM d
), found AS (
    SELECT doc_id, s, item_id, sizes.n FROM places CROSS JOIN (SELECT DISTINCT n FROM windows) AS sizes
    JOIN windows ON windows.n = sizes.n AND s + sizes.n - 1 <= len(w) AND gram = array_to_string(w[s : s + sizes.n - 1], ' ')
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

MINHASH = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
        lambda i: array_to_string(w[i : i + 3], ' ')))) END AS s FROM d
), classes AS (SELECT s, len(s) AS n, min(doc_id) AS c FROM sets WHERE len(s) > 0 GROUP BY s
), items AS (SELECT c, n, unnest(s) AS g FROM classes
), edges AS (
    SELECT x.c AS a, y.c AS b FROM items x JOIN items y ON x.g = y.g AND x.c <> y.c
    GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, sets.doc_id) AS component_id,
    sets.doc_id = coalesce(component_id, sets.doc_id) AS kept
FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN least ON classes.c = least.a
"""

# CRC-32 byte by byte with a table that eight shifts give; buckets once per distinct word.
IMPORTANCE = r"""
WITH shifted AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table
), words AS (
    SELECT src, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM (SELECT 'd' AS src, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark)
), seen AS (SELECT src, doc_id, unnest(w) AS word FROM words
), hashed AS (
    SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(word))),
        lambda k: 16 * (instr('0123456789ABCDEF', substr(hex(word), 2 * k + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(hex(word), 2 * k + 2, 1)) - 1)),
        lambda c, x: xor(crc_table[1 + (xor(c, x) & 255)], c >> 8)), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM seen) CROSS JOIN shifted
), counted AS (SELECT src, doc_id, bucket, count(*) AS n FROM seen JOIN hashed USING (word) GROUP BY src, doc_id, bucket
), totals AS (
    SELECT b.bucket, coalesce(sum(n) FILTER (src = 'd'), 0) AS s, coalesce(sum(n) FILTER (src = 'b'), 0) AS t
    FROM range(10000) AS b(bucket) LEFT JOIN counted ON counted.bucket = b.bucket GROUP BY b.bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM totals
), weighed AS (SELECT doc_id, sum(n * gain) AS weight FROM counted JOIN gains USING (bucket) WHERE src = 'd' GROUP BY doc_id
), noise AS (
    SELECT doc_id, len(w) AS n_features, list_reduce(list_concat([0], list_transform(range(1, 9),
        lambda k: instr('0123456789abcdef', substr(sha256('2024:' || doc_id), k, 1)) - 1)), lambda a, x: 16 * a + x) AS h
    FROM words WHERE src = 'd'
), scored AS (
    SELECT doc_id, n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM noise LEFT JOIN weighed USING (doc_id)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_features >= 20) OVER () AS able FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
    CASE WHEN n_features >= 20 AND r <= 10 * able // 100 THEN r END AS rank
FROM ranked
"""

LINES = r"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS all_lines FROM documents
), l AS (
    SELECT doc_id, no, list_filter(regexp_split_to_array(line, '[\x09\x0B-\x0D ]+'), lambda x: x <> '') AS u
    FROM (SELECT doc_id, unnest(range(1, len(all_lines) + 1)) AS no, unnest(all_lines) AS line FROM raw) WHERE doc_id IS NOT NULL
), same AS (SELECT u, min(doc_id) AS keeper FROM l WHERE len(u) >= 1 GROUP BY u HAVING count(DISTINCT doc_id) >= 2
), repeated AS (SELECT doc_id, no FROM l JOIN same USING (u) WHERE doc_id > keeper
), leafed AS (
    SELECT doc_id, no, w, len(w) AS n, w[1:3] AS head
    FROM (SELECT doc_id, no, list_transform(u, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w FROM l WHERE len(u) >= 4)
), crowded AS (SELECT n, head FROM leafed GROUP BY n, head HAVING count(DISTINCT doc_id) >= 3
), c AS (SELECT leafed.* FROM leafed SEMI JOIN crowded USING (n, head)
), once AS (SELECT DISTINCT doc_id, w, n, head FROM c
), sizes AS (SELECT n, head, count(*) AS pairs FROM once GROUP BY n, head
), seen AS (
    SELECT n, head, place, token, count(*) AS times FROM (SELECT n, head, unnest(range(1, n + 1)) AS place, unnest(w) AS token FROM once)
    WHERE token <> '<*>' GROUP BY n, head, place, token
), steady AS (SELECT n, head, place, token FROM seen JOIN sizes USING (n, head) WHERE times >= 3 AND times * 50 >= pairs
), known AS (SELECT n, head, list(token || ' ' || place) AS have FROM steady GROUP BY n, head
), templated AS (
    SELECT w, n, list_transform(range(1, n + 1), lambda i: CASE WHEN list_contains(have, w[i] || ' ' || i) THEN w[i] ELSE '<*>' END) AS t
    FROM (SELECT DISTINCT w, n, head FROM once) JOIN known USING (n, head)
), fit AS (SELECT w, t FROM templated WHERE len(list_filter(t[4:], lambda x: x <> '<*>')) >= 0.6 * (n - 3)
), recurring AS (
    SELECT t, min(doc_id) AS keeper FROM once JOIN fit USING (w) GROUP BY t HAVING count(DISTINCT doc_id) >= 3
), gone AS (
    SELECT doc_id, list(DISTINCT no) AS nos FROM (
        SELECT doc_id, no FROM c JOIN fit USING (w) JOIN recurring USING (t) WHERE doc_id > keeper UNION ALL SELECT doc_id, no FROM repeated
    ) GROUP BY doc_id
)
SELECT raw.doc_id, CAST(coalesce(len(all_lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(nos), 0) AS BIGINT) AS n_dropped,
    CASE WHEN nos IS NULL THEN text ELSE coalesce(array_to_string(list_transform(
        list_filter(range(1, len(all_lines) + 1), lambda i: NOT list_contains(nos, i)), lambda i: all_lines[i]), chr(10)), '') END AS text
FROM raw LEFT JOIN gone USING (doc_id)
"""

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), plain AS (
    SELECT *, replace(replace(replace(text, '\', '\\'), '### ', '\h'), '</turn>', '\t') AS body,
        replace(replace(replace(replace(role, '\', '\\'), '### ', '\h'), '</turn>', '\t'), chr(10), '\n') AS head
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
    CAST(sum(length('### ' || head || chr(10) || body || chr(10) || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM plain GROUP BY conv_id
"""


def _any_of(terms) -> str:
    return " + ".join(f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INT)" for t in terms)


def _rules() -> str:
    longest_first = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    tests = "".join(
        f" WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'" for v, h, p in longest_first
    )
    return f"CASE{tests} END"


URLS = rf"""
WITH cut AS (
    SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), judged AS (
    SELECT *, {_rules()} AS decided, {_any_of(urls.STRICT_TERMS)} AS strict, {_any_of(urls.SOFT_TERMS)} AS soft FROM parts
)
SELECT page_id, host, path, split_part(decided, ' ', 2) AS rule,
    coalesce(split_part(decided, ' ', 1), CASE WHEN strict >= 1 OR soft >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""
