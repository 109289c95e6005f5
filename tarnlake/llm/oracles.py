"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from tarnlake.llm.conversation_trie import FAMILY, SHARED_TURNS
from tarnlake.llm.jaccard_join import PERCENT, WIDTH
from tarnlake.llm.line_frequency import KEPT_PERCENT, KEPT_WORDS, MAX_DOCUMENTS, MAX_PERCENT
from tarnlake.llm.queries import JUNK, JUNK_PERCENT, RULES

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

SQL = {
    "op4_line_frequency": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT r, source, unnest(string_split(t, chr(10))) AS l FROM d),
lw AS (SELECT r, source, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS lw FROM l),
lines AS (SELECT r, source, l, len(lw) AS n, translate(array_to_string(lw, ' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lw WHERE len(lw) > 0),
hosts AS (SELECT lines.source, count(DISTINCT t) AS texts FROM lines JOIN d USING (r) GROUP BY lines.source),
common AS (SELECT lines.source, key FROM lines JOIN d USING (r) JOIN hosts ON hosts.source IS NOT DISTINCT FROM lines.source
    GROUP BY lines.source, key, texts
    HAVING count(DISTINCT t) > {MAX_DOCUMENTS} AND 100 * count(DISTINCT t) > {MAX_PERCENT} * texts),
removed AS (SELECT r, sum(n) AS n FROM lines JOIN common
    ON lines.key = common.key AND lines.source IS NOT DISTINCT FROM common.source GROUP BY r),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY r),
wins AS (SELECT r, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) AS win,
    unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3),
again AS (SELECT r, win FROM wins GROUP BY ALL HAVING count(*) > 1),
pos AS (SELECT DISTINCT wins.r, unnest([i, i + 1, i + 2]) AS p FROM wins JOIN again USING (r, win)),
rep AS (SELECT r, count(*) AS n FROM pos GROUP BY r),
c AS (SELECT doc_id, len(w) AS n_words, coalesce(len(array_to_string(w, '')), 0) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed_words
    FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN removed USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < {KEPT_WORDS}
    OR 100 * (n_words - n_removed_words) < {KEPT_PERCENT} * n_words)) AS kept FROM f
""",
    "op8_line_windows": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS s FROM documents),
x AS (SELECT r, doc_id, text, list_filter(list_transform(range(1, len(s) + 1),
    lambda i: {'i': i, 'l': trim(s[i], ' ' || chr(9) || chr(13))}), lambda y: y.l <> '') AS x FROM d),
wins AS (SELECT r, doc_id, text, unnest(range(1, len(x) - 1)) AS p,
    unnest(list_transform(range(1, len(x) - 1), lambda i: [x[i].l, x[i+1].l, x[i+2].l])) AS win,
    unnest(list_transform(range(1, len(x) - 1), lambda i: [x[i].i, x[i+1].i, x[i+2].i])) AS own
    FROM x WHERE len(x) >= 3),
later AS (SELECT r, own FROM (SELECT *, dense_rank() OVER
    (PARTITION BY win ORDER BY doc_id NULLS LAST, text, p) AS n FROM wins) WHERE n > 1),
gone AS (SELECT r, list(DISTINCT i) AS g FROM (SELECT r, unnest(own) AS i FROM later) GROUP BY r)
SELECT doc_id, CASE WHEN g IS NULL THEN text ELSE array_to_string(list_transform(
    list_filter(range(1, len(s) + 1), lambda i: NOT list_contains(g, i)), lambda i: s[i]), chr(10)) END AS text,
    coalesce(len(s), 0) AS n_lines, coalesce(len(g), 0) AS n_removed
FROM d LEFT JOIN gone USING (r)
""",
    "op9_url_cascade": rf"""
WITH rules(verdict, host, path) AS (VALUES {_RULES}),
u AS (SELECT row_number() OVER () AS r, page_id, html,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT r, page_id, html, translate(regexp_extract(rest, '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
fit AS (SELECT r, arg_max({{'rule': rules.host || rules.path, 'verdict': verdict}}, len(rules.host || rules.path)) AS b
    FROM p JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host))
    AND starts_with(p.path, rules.path) GROUP BY r),
listed AS (SELECT host FROM p WHERE host <> '' GROUP BY host
    HAVING 100 * count(*) FILTER (WHERE regexp_matches(html, '{JUNK}')) >= {JUNK_PERCENT} * count(*))
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict,
    CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (r)
""",
    "op10_decontaminate": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark),
k AS (SELECT item_id, least(10, len(w)) AS k, w FROM b WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i:i+k-1], ' '))) AS win FROM k),
lens AS (SELECT DISTINCT k FROM items),
wins AS (SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i:i+k-1], ' '))) AS win FROM d, lens WHERE len(w) >= k),
hit AS (SELECT r, i, k, item_id FROM wins JOIN items USING (k, win)),
cover AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(cover.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN ids USING (r)
""",
    "op11_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < {WIDTH} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {WIDTH} + 2), lambda i: array_to_string(w[i:i + {WIDTH} - 1], ' ')) END)) AS s FROM d),
c AS (SELECT s, min(doc_id) AS k, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
p AS (SELECT k, n, unnest(s) AS g FROM c),
shared AS (SELECT a.k AS x, b.k AS y, a.n + b.n AS sizes, count(*) AS i FROM p a JOIN p b ON a.g = b.g AND a.k < b.k GROUP BY ALL),
l AS (SELECT x, y FROM shared WHERE 100 * i >= {PERCENT} * (sizes - i)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
reach AS (SELECT x AS k, x AS t FROM e UNION SELECT reach.k, e.y FROM reach JOIN e ON reach.t = e.x),
m AS (SELECT k, min(t) AS t FROM reach GROUP BY k)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(m.t, c.k, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.s = c.s LEFT JOIN m ON c.k = m.k
""",
    "op12_conversation_trie": rf"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, length(coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL),
-- The checksum of the decimal id, a bit at a time.
c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(conv_id::VARCHAR, ''), lambda b: [ord(b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END),
    4294967295::BIGINT) % {SHARED_TURNS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, p, k, n FROM c JOIN t ON t.conv_id = c.base AND p <= h
    UNION ALL SELECT c.conv_id, p, k, n FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
path AS (SELECT conv_id, coalesce(list(k ORDER BY p) FILTER (WHERE p IS NOT NULL), []) AS k,
    coalesce(list(n ORDER BY p) FILTER (WHERE p IS NOT NULL), []) AS n FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
x AS (SELECT conv_id, unnest(range(0, len(k) + 1)) AS d, k, n FROM path),
nodes AS (SELECT k[1:d] AS k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(CASE WHEN d = 0 THEN 0 ELSE n[d] END) AS n,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(k) = d), '')) AS ends_sha256
    FROM x GROUP BY k[1:d], d),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
up AS (SELECT nodes.k[1:a] AS k, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
    sum((n_convs - 1) * nodes.n)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM nodes) AS nodes LEFT JOIN kids ON nodes.k = kids.k GROUP BY ALL)
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) AS n_children,
    n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN up ON nodes.k = up.k LEFT JOIN kids ON nodes.k = kids.k
LEFT JOIN nodes AS above ON nodes.d > 0 AND above.k = nodes.k[1:nodes.d - 1] AND above.d = nodes.d - 1
""",
}
