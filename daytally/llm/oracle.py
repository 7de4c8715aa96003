"""DuckDB SQL for the llm queries that SQL can express over whole tables."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH normal AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept,
       text_sha256
FROM normal
WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""

URL_FILTER = r"""
WITH places AS (
    SELECT page_id,
           CASE WHEN contains(url, '://')
                THEN regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1) ELSE '' END AS raw_host,
           CASE WHEN contains(url, '://')
                THEN regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) ELSE '' END AS path
    FROM pages),
hosts AS (
    SELECT page_id, path,
           translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
    FROM places),
rules (rule_host, rule_path, action) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fitting AS (
    SELECT page_id, rule_host || rule_path AS rule, action,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM hosts JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM hosts h LEFT JOIN fitting f ON f.page_id = h.page_id AND f.place = 1
"""

DECONTAMINATION = r"""
WITH doc_words AS MATERIALIZED (
    SELECT doc_id, row_number() OVER () AS line, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS MATERIALIZED (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i + 1:i + least(10, len(w))], ' ') AS win
    FROM item_words, unnest(range(greatest(len(w) - 9, 1))) t(i) WHERE len(w) > 0),
places AS (
    SELECT line, size, i, array_to_string(w[i + 1:i + size], ' ') AS win
    FROM doc_words, (SELECT DISTINCT size FROM windows) sizes, unnest(range(len(w) - size + 1)) t(i) WHERE len(w) >= size),
hits AS MATERIALIZED (
    SELECT p.line, p.size, p.i, x.item_id FROM places p JOIN windows x ON x.size = p.size AND x.win = p.win),
covered AS (
    SELECT line, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(size)) t(k) GROUP BY line),
listed AS (
    SELECT line, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items,
           string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
    FROM hits GROUP BY line)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
       sha256(coalesce(l.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON c.line = d.line LEFT JOIN listed l ON l.line = d.line
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 2], ' ') AS s
    FROM doc_words, unnest(range(greatest(len(w) - 1, 1))) t(i) WHERE len(w) > 0),
sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS MATERIALIZED (
    SELECT doc_id, s, n FROM shingles JOIN sizes USING (doc_id)),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c
    FROM sized x JOIN sized y ON x.s = y.s AND x.doc_id < y.doc_id
                             AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
    GROUP BY ALL),
links AS MATERIALIZED (
    SELECT a, b FROM shared WHERE 100 * c >= 80 * (na + nb - c)),
edges AS MATERIALIZED (
    SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b),
parts AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN parts USING (doc_id) LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

FILL_IN_MIDDLE = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents),
numbers AS (
    SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS c1,
           CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS c2,
           CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS h3,
           CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS h4
    FROM texts),
cuts AS (
    SELECT doc_id, text, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
                WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers),
parts AS (
    SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

SPELLING = r"""
WITH RECURSIVE bytes_of AS MATERIALIZED (
    SELECT range AS b FROM range(256)),
crc_table AS MATERIALIZED (
    SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS steps
    FROM bytes_of),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents),
counted AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (
    SELECT run, n, hex(encode(id || ':' || run)) AS h FROM counted),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT),
                   list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
               lambda c, x: xor(steps[(xor(c, x) & 255) + 1], c >> 8))) AS crc
    FROM hexed, crc_table),
spelt AS (
    SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n
    FROM hashed),
words AS MATERIALIZED (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS MATERIALIZED (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) t(i)),
near AS MATERIALIZED (
    SELECT x.word, y.word AS other, y.n FROM places x JOIN places y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION SELECT p.word, w.word, w.n FROM places p JOIN words w ON w.word = p.rest
    UNION SELECT w.word, p.word, p.n FROM places p JOIN words w ON w.word = p.rest),
ranked AS (
    SELECT word, other, n AS other_n, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place,
           count(*) OVER (PARTITION BY word) AS n_near
    FROM near),
known AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
           CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chain AS (
    SELECT word, word AS root, 0 AS steps FROM known
    UNION ALL
    SELECT c.word, k.form, c.steps + 1 FROM chain c JOIN known k ON k.word = c.root WHERE k.form IS NOT NULL)
SELECT k.word, k.form, c.root, k.n, k.n_near, k.form_n
FROM known k JOIN (SELECT word, max_by(root, steps) AS root FROM chain GROUP BY word) c ON c.word = k.word
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": EXACT_DEDUP, "op4_url_filter": URL_FILTER, "op9_decontamination": DECONTAMINATION,
            "op10_minhash_near_dup": NEAR_DUPLICATES, "op11_fill_in_middle": FILL_IN_MIDDLE,
            "op12_spelling_variants": SPELLING}
