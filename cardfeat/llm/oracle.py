"""DuckDB SQL of the queries on texts that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLE["op6_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, row_number() OVER () AS row, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
placed AS (
  SELECT item, row, n, q, array_to_string(w[q:q + n - 1], ' ') AS g
  FROM (SELECT item, row, w, n, unnest(range(1, len(w) - n + 2)) AS q FROM sized)),
wanted AS (SELECT DISTINCT item, n, g FROM placed),
sizes AS (SELECT DISTINCT n FROM wanted),
found AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item, p, n FROM found JOIN wanted USING (n, g)),
chained AS (
  SELECT doc_id, item, row, n, p, q, p - row_number() OVER (PARTITION BY doc_id, row, p - q ORDER BY p) AS run
  FROM found JOIN placed USING (n, g)),
matches AS (
  SELECT doc_id, item, count(*) + n - 1 AS words, min(q) - 1 AS item_word, min(p) - 1 AS doc_word
  FROM chained GROUP BY doc_id, item, row, n, p - q, run),
best AS (
  SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, item, item_word, doc_word) = 1),
hit_words AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(words, 0) AS BIGINT) AS longest_words, best.item AS longest_item, CAST(item_word AS BIGINT) AS longest_item_word,
  CAST(doc_word AS BIGINT) AS longest_doc_word
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id) LEFT JOIN best USING (doc_id)
"""

_DRAW = "('0x' || substr(s, {at}, 8))::BIGINT"
_DRAWS = ", ".join(_DRAW.format(at=1 + 8 * k) + f" AS h{k + 1}" for k in range(4))

ORACLE["op13_fill_in_middle"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
units AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS l, {_DRAWS} FROM d),
cut AS (
  SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:n], '') AS suffix
  FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

_BITS = "list_concat([ascii(c)], list_transform(range(8), lambda k: -1))"
_BYTES = f"flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: {_BITS}))"
_STEP = "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
_CRC32 = f"xor(list_reduce(list_concat([4294967295], {_BYTES}), lambda a, x: {_STEP}), 4294967295)"

ORACLE["op12_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
named AS (
  SELECT conv_id, turn, substr(sha256(strlen(role) || ':' || role || text), 1, 32) AS hash, strlen(text) AS size FROM t),
own AS (
  SELECT conv_id, list(hash ORDER BY turn NULLS FIRST, hash) AS hashes, list(size ORDER BY turn NULLS FIRST, hash) AS sizes
  FROM named GROUP BY conv_id),
headed AS (SELECT *, conv_id - conv_id % 5 AS family, {_CRC32} % 9 AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(f.hashes, [])[1:h], c.hashes[h + 1:]) AS hashes,
    list_concat(coalesce(f.sizes, [])[1:h], c.sizes[h + 1:]) AS sizes
  FROM headed c LEFT JOIN own f ON f.conv_id = c.family),
prefixes AS (
  SELECT conv_id, d, d = len(hashes) AS is_end, sha256(array_to_string(hashes[1:d], '')) AS node,
    CASE WHEN d > 0 THEN sha256(array_to_string(hashes[1:d - 1], '')) END AS parent, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(0, len(hashes) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, any_value(d) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(CASE WHEN is_end THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT p.node, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.d <= n.depth LEFT JOIN children c ON c.node = n.node GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node JOIN below b ON b.node = n.node
"""

_SOUND = "len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0"

ORACLE["op11_cross_polytope"] = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
sound AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND {_SOUND}),
links AS (
  SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
named AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN named USING (r) LEFT JOIN counted USING (r)
"""
