"""DuckDB SQL for the registered queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op1_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size * 2.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget
  FROM s),
l AS (
  SELECT *, row_number() OVER o AS place,
         (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
f AS (SELECT place, level FROM l WHERE level < cap / w ORDER BY place LIMIT 1),
t AS (
  SELECT source, source_size, budget, CASE WHEN place >= (SELECT place FROM f) THEN w * (SELECT level FROM f) ELSE cap END AS target
  FROM l),
q AS (
  SELECT d.doc_id, d.source, size, turn, source_size, budget, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER () AS i
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT i, doc_id, source, size, turn, floor(budget) AS budget, copy,
         CAST(upto + copy * source_size AS DOUBLE) / target AS finish
  FROM q, (VALUES (0), (1)) v(copy) WHERE size > 0),
o AS (
  SELECT i, size, budget, coalesce(sum(size) OVER (ORDER BY finish, turn, CAST(doc_id AS VARCHAR) NULLS LAST, source NULLS LAST, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM c),
k AS (SELECT i, sum(greatest(0, least(size, budget - before))) AS taken FROM o GROUP BY i)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k USING (i)
"""

ORACLE["op5_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
e AS (SELECT i, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
k AS (
  SELECT i, doc_id, p, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM e),
c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT i, k.doc_id, p, line, coalesce(k.doc_id < c.last, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY i, doc_id
"""

ORACLE["op6_decontamination"] = r"""
WITH it AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM it)),
n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
g AS (SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
o AS (SELECT r, doc_id, item_id, count(*) AS n_shared FROM g JOIN s USING (s) GROUP BY ALL),
m AS (SELECT doc_id, item_id, max(n_shared) AS n_shared FROM o GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 80
"""

ORACLE["op4_chat_format"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL
  SELECT -7, n, r, '</s>[INST] ok [/INST]', r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, r0 NULLS FIRST, t0 NULLS FIRST) AS i,
         length(regexp_replace(role, '(\\|</?s>|\[/?INST\])', '\\\1', 'g')) + length(regexp_replace(text, '(\\|</?s>|\[/?INST\])', '\\\1', 'g')) + 23 AS chars
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS turns,
         coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS loss, CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""

ORACLE["op2_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
m AS (SELECT h, min(doc_id) AS first FROM x GROUP BY h),
b AS (SELECT r, i FROM x JOIN m USING (h) WHERE doc_id > first),
e AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
c AS (SELECT e.r, e.i, word, coalesce(max(b.i) OVER (PARTITION BY e.r ORDER BY e.i), -100) >= e.i - 49 AS gone FROM e LEFT JOIN b ON e.r = b.r AND e.i = b.i),
k AS (
  SELECT r, count(*) AS n_words, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM c GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""

ORACLE["op13_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
e AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM e GROUP BY ALL HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM e JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS kept, sum(total) AS size FROM k GROUP BY lang),
s AS (SELECT lang, source, coalesce(sum(n), 0) AS size FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
f AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (s.size + v.kept) AS HUGEINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.total + 1)) // (v.size + v.kept) AS HUGEINT) AS q
  FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM f a JOIN f b USING (lang, term) WHERE a.source != b.source GROUP BY ALL),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source LEFT JOIN p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM f WHERE n > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 200
"""
