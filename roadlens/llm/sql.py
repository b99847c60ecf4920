"""SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::double[] AS e FROM embeddings
), n AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9::double
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.x, l.y FROM reach JOIN l ON l.x = reach.y
), c AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
), d AS (
  SELECT x, count(*) AS n_links FROM l GROUP BY x
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.x = vec_id LEFT JOIN d ON d.x = vec_id
"""

_QUOTE = r"^[ \t]*((?:>[ \t]?)+)"
_ANNOUNCE = r"^[ \t]*(?:On .+ wrote|Am .+ schrieb.*|Le .+ a écrit|El .+ escribió)[ \t]*:[ \t]*$"
_WS = r"[ \t\n\x0B\f\r]"


def _norm(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '([ \t\n\x0B\f\r]|[[:punct:]])+', ' ', 'g'))"


OP3 = rf"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, text, coalesce(conv_id::varchar, 'null') AS key, md5(concat_ws(chr(1), coalesce('r' || role, 'n'), text)) AS id FROM conversations GROUP BY ALL
), a AS (
  SELECT key, turn, id, regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n') AS ls FROM m
), l AS (
  SELECT key, turn, id, unnest(ls) AS line, generate_subscripts(ls, 1) AS nth FROM a
), v AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '{_QUOTE}', 1), '[^>]', '', 'g')) AS level, regexp_replace(line, '{_QUOTE}', '') AS bare, regexp_matches(line, '{_ANNOUNCE}') AS announce FROM l
), o AS (
  SELECT key, turn, id, coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE level = 0 AND NOT announce), '') AS t FROM v GROUP BY ALL
), c AS (
  SELECT key, turn, id, regexp_replace(regexp_replace(t, '\n{_WS}*\n({_WS}*\n)*', chr(10) || chr(10), 'g'), '^{_WS}+|{_WS}+$', '', 'g') AS content FROM o
), r AS (
  SELECT *, sum(new) OVER (PARTITION BY key, turn, id ORDER BY nth) AS passage FROM (
    SELECT *, (level <> coalesce(lag(level) OVER (PARTITION BY key, turn, id ORDER BY nth), -1))::int AS new FROM v)
  QUALIFY level > 0
), w AS (
  SELECT key, turn, id, passage, level, string_agg(bare, chr(10) ORDER BY nth) AS body FROM r GROUP BY ALL
), u AS (
  SELECT key, turn, id, passage, {_norm("bare")} AS unit FROM r UNION ALL SELECT key, turn, id, passage, {_norm("body")} FROM w
), f AS (
  SELECT key, unit, min(turn) AS original FROM (
    SELECT key, turn, {_norm("x")} AS unit FROM (
      SELECT key, turn, unnest(string_split(content, chr(10))) AS x FROM c UNION ALL SELECT key, turn, unnest(string_split(content, chr(10) || chr(10))) FROM c UNION ALL SELECT key, turn, content FROM c))
  WHERE unit <> '' GROUP BY ALL
), votes AS (
  SELECT u.key, u.turn, id, passage, original, sum(length(u.unit)) AS weight FROM u JOIN f ON u.key = f.key AND u.unit = f.unit WHERE original < u.turn GROUP BY ALL
), best AS (
  SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY key, turn, id, passage ORDER BY weight DESC, original DESC) = 1
), found AS (
  SELECT w.key, w.turn, w.id, w.level, b.original, b.weight FROM w LEFT JOIN best b ON w.key = b.key AND w.turn = b.turn AND w.id = b.id AND w.passage = b.passage
), answered AS (
  SELECT key, turn, original FROM (SELECT key, turn, original, sum(weight) AS weight FROM found WHERE level = 1 AND original IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY key, turn ORDER BY weight DESC, original DESC) = 1
), turns AS (
  SELECT key, turn, lag(turn) OVER (PARTITION BY key ORDER BY turn) AS prev FROM (SELECT DISTINCT key, turn FROM m WHERE turn IS NOT NULL)
), links AS (
  SELECT t.key, t.turn, coalesce(a.original, t.prev) AS parent FROM turns t LEFT JOIN answered a ON a.key = t.key AND a.turn = t.turn
), depths(key, turn, depth) AS (
  SELECT key, turn, 0::bigint FROM links WHERE parent IS NULL
  UNION ALL SELECT x.key, x.turn, d.depth + 1 FROM depths d JOIN links x ON x.key = d.key AND x.parent = d.turn
), quotes AS (
  SELECT key, turn, id, count(*) AS n_quotes, count(original) AS n_linked FROM found GROUP BY ALL
), every AS (
  SELECT m.conv_id, m.key, m.turn, coalesce(m.role, '') AS r, d.depth, coalesce(floor(d.depth / 512), -1)::bigint AS part, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked,
    '<|' || coalesce(m.role, 'unknown') || '|>' || chr(10) || c.content || '<|end|>' || chr(10) AS line
  FROM m JOIN c ON c.key = m.key AND c.turn IS NOT DISTINCT FROM m.turn AND c.id = m.id
  LEFT JOIN depths d ON d.key = m.key AND d.turn = m.turn LEFT JOIN quotes q ON q.key = m.key AND q.turn = m.turn AND q.id = m.id
), cut AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY key, part) > 2048
    THEN (row_number() OVER (PARTITION BY key, part ORDER BY depth NULLS FIRST, turn NULLS FIRST, r, line) - 1) // 512 ELSE 0 END AS piece FROM every
)
SELECT any_value(conv_id) AS conv_id, part, piece, count(*) AS n_messages, sum(n_quotes)::bigint AS n_quotes, sum(n_linked)::bigint AS n_linked,
  string_agg(line, '' ORDER BY depth NULLS FIRST, turn NULLS FIRST, r, line) AS chat
FROM cut GROUP BY key, part, piece
"""

#: Holds for the test pages, which mark their main text by an article element and write only these references in it, some without their semicolon.
OP8 = r"""
WITH a AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') AS body FROM pages
), t AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<[^>]+>', ' ', 'g') AS t FROM a
), d AS (
  SELECT page_id, url, regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(t, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;', chr(39)), '&amp;?', '&', 'g') AS t FROM t
), w AS (
  SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM d
)
SELECT page_id, url, text, length(text)::bigint AS n_chars FROM w
"""

OP2 = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
), k AS (
  SELECT doc_id, sha256(body) AS text_sha256,
    first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""

OP9 = r"""
WITH z AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size, md5(coalesce(doc_id::varchar, '')) AS digest FROM documents
), s AS (
  SELECT source, sum(size)::bigint AS source_size FROM z GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::bigint AS w, (sum(source_size) OVER ())::bigint AS total FROM s
), o AS (
  SELECT *, (source_size * 2)::double / w AS stop FROM w
), l AS (
  SELECT *, (total * 1.5::double
      - coalesce(sum(source_size * 2) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double)
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::double AS level
  FROM o
), f AS (
  SELECT (SELECT level FROM l WHERE level <= stop ORDER BY stop, source NULLS LAST LIMIT 1) AS final
), t AS (
  SELECT source, source_size, least((source_size * 2)::double, coalesce(w * final, (source_size * 2)::double)) AS target,
    ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8))::bigint / 4294967296::double AS u
  FROM l, f
), r AS (
  SELECT z.*, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0::double END AS rate,
    (row_number() OVER (PARTITION BY z.source ORDER BY size, digest, doc_id NULLS LAST) - 1)::double AS rank
  FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (least(2, floor((rank + 1) * rate + u) - floor(rank * rate + u)) * size)::bigint AS taken FROM r
"""

OP11 = r"""
WITH f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), g AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
      len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
      coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM t LEFT JOIN g ON g.doc_id = t.doc_id
), x AS (
  SELECT *, coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda k: fails[ascii(substr(filter_order, k, 1)) - 64])), 6) AS first FROM d, o
), s AS (
  SELECT *, fails[ascii(substr(filter_order, step, 1)) - 64] AS failed FROM x, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), c AS (
  SELECT part, filter_order, step, count(*) FILTER (WHERE first > step) AS kept, count(*) FILTER (WHERE first = step) AS removed, count(*) FILTER (WHERE failed AND first < step) AS redundant,
    count(*) FILTER (WHERE failed AND len(list_filter(fails, lambda y: y)) = 1) AS unique_fails,
    count(*) FILTER (WHERE first = step AND good) AS good_lost, count(*) FILTER (WHERE first = step AND toxic) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::bigint AS shapley FROM c
"""

OP12 = """
WITH q AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::double[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.e, b.e)::bigint AS score
  FROM q a JOIN q b ON len(a.e) = len(b.e) AND (a.vec_id <> b.vec_id OR a.label <> b.label) WHERE a.vec_id % 50 = 0
), p AS (
  SELECT r, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, id) AS nth FROM s WHERE same QUALIFY nth <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY p.r, nth ORDER BY score DESC, id)::int AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (r, anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT row, unnest(ls) AS line, generate_subscripts(ls, 1) AS nth FROM d
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10
), s AS (
  SELECT row, count(f.key) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE f.key IS NULL), '') AS kept FROM k LEFT JOIN f ON f.key = k.key GROUP BY row
)
SELECT doc_id, len(ls)::bigint AS n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN s ON s.row = d.row
"""
