"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from tidemark.llm import licenses

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
last AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS latest FROM payloads)
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM (SELECT *, CASE WHEN strlen(payload) >= 1000 AND page_id <> latest THEN latest END AS refers_to FROM last)
"""


def _words(table: str, key: str) -> str:
    return rf"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"""


DECONTAMINATION = f"""
WITH d AS ({_words('documents', 'doc_id')}),
i AS (SELECT *, least(10, len(w)) AS n FROM ({_words('benchmark', 'item_id')}) WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS win
    FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS s FROM i)),
document_windows AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
          FROM d JOIN (SELECT DISTINCT n FROM i) AS sizes ON len(w) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM document_windows JOIN item_windows USING (n, win)),
spots AS (SELECT doc_id, count(DISTINCT spot) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS spot FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# Two hexadecimal digits a byte. Repeated windows have one length, so a run goes on while the next
# one starts within or right after the last
REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS win
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)),
later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, s) > 1),
cut AS (SELECT *, s > lag(s, 1, -1000) OVER (PARTITION BY doc_id ORDER BY s) + 100 AS fresh FROM later),
runs AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b
    FROM (SELECT *, count_if(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM cut) GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, b, true AS real FROM runs
    UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2, false FROM d),
gaps AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a, b) AS since FROM edges)
SELECT doc_id, any_value(len(h) // 2) AS n_bytes, CAST(sum(b - a) AS BIGINT) AS n_removed,
    count_if(real)::BIGINT AS n_spans,
    sha256(unhex(string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a, b))) AS kept_sha256
FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
"""

# A node is the text of its turns so far; its subtree are the nodes whose smallest conversation passes it
TRIE = r"""
WITH RECURSIVE turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations),
crc(c, i, v) AS (SELECT DISTINCT c, 0, 4294967295::BIGINT FROM turns UNION ALL
    SELECT c, i + 1, list_reduce([xor(v, ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: xor(a >> 1, (a & 1) * 3988292384)) FROM crc WHERE i < length(c::VARCHAR)),
heads AS (SELECT c, xor(v, 4294967295) % 9 AS h FROM crc WHERE i = length(c::VARCHAR)),
rebuilt AS (
    SELECT heads.c, 0 AS own, p, role, text FROM heads JOIN turns ON turns.c = heads.c - heads.c % 5 AND p <= h
    UNION ALL SELECT c, 1, p, role, text FROM turns JOIN heads USING (c) WHERE p > h),
path AS (SELECT c, row_number() OVER w AS depth, strlen(text) AS size,
    sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ) OVER w) AS node
    FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, p)),
steps AS (SELECT c, depth, size, node, lag(node, 1, '') OVER w AS parent, lead(node) OVER w IS NULL AS ending
    FROM path WINDOW w AS (PARTITION BY c ORDER BY depth)
    UNION ALL SELECT c, 0, 0, '', NULL, c NOT IN (SELECT c FROM rebuilt) FROM heads),
nodes AS (SELECT node, any_value(depth) AS depth, any_value(size) AS size, any_value(parent) AS parent,
    min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ending) AS ends
    FROM steps GROUP BY node),
family AS (SELECT n.*, (SELECT count(*) FROM nodes AS o WHERE o.parent = n.node) AS n_children FROM nodes AS n),
totals AS (SELECT s.node, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * f.size) AS saved
    FROM family AS f JOIN steps AS s ON s.c = f.conv_id AND s.depth <= f.depth GROUP BY s.node)
SELECT f.conv_id, f.depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves::BIGINT AS n_leaves,
    saved::BIGINT AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM family AS f JOIN totals USING (node) LEFT JOIN nodes AS o ON f.parent = o.node
"""


def _license_words() -> str:
    """A row for each word of each template."""
    rows = [
        f"({i}, '{t.label}', {t.base}, {t.share}, {place}, '{word}', {place in t.key})"
        for i, t in enumerate(licenses.templates()) for place, word in enumerate(t.words)
    ]
    return ", ".join(rows)


LICENSES = f"""
WITH d AS ({_words('documents', 'doc_id')}),
t(template, label, base, share, place, word, key) AS (VALUES {_license_words()}),
spots AS (SELECT doc_id, p, word FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d)
    WHERE word IN (SELECT word FROM t)),
held AS (SELECT word, count(DISTINCT doc_id) AS df FROM spots GROUP BY word),
index AS (SELECT t.*, CAST(round_even(1000 * (1 + ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(df, 0)))), 0) AS BIGINT) AS weight
    FROM t LEFT JOIN held USING (word)),
whole AS (SELECT template, any_value(label) AS label, any_value(base) AS base, any_value(share) AS share,
    sum(weight) AS total, count_if(key) AS keys FROM index GROUP BY template),
found AS (SELECT doc_id, template, p - place AS start, sum(weight) AS got, count_if(key) AS keys
    FROM spots JOIN index USING (word) GROUP BY 1, 2, 3),
kept AS (SELECT doc_id, label, base, start, CAST(got AS DOUBLE) / CAST(total AS DOUBLE) AS part
    FROM found JOIN whole USING (template) WHERE got * 100 >= share * total AND found.keys = whole.keys)
SELECT d.doc_id, any_value(len(w)) AS n_words, count(base) FILTER (base) AS n_base,
    min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(part), 0.0) AS score
FROM d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id
"""

INFILL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || doc_id) AS x FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
    ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS head, array_to_string(u[a + 1:b], '') AS mid,
    array_to_string(u[b + 1:], '') AS tail FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(head) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars, sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
        ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

ORACLE_SQL = {
    "op1_warc": WARC, "op6_repeats": REPEATS, "op9_decontamination": DECONTAMINATION,
    "op11_prefix_trie": TRIE, "op12_licenses": LICENSES, "op13_fill_in_middle": INFILL,
}
