"""DuckDB SQL for the queries that SQL can express, on the same tables."""

from __future__ import annotations

_SPLIT = r"'[\x20\x09-\x0D]+'"
_WORDS = "list_filter(string_split_regex({}, " + _SPLIT + "), lambda x: x <> '')"

OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g)
      WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * k >= 80 * (nx.c + ny.c - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(doc_id, c) AS (SELECT x, x FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
SELECT w.doc_id, coalesce(any_value(n.c), 0) AS n_shingles, coalesce(min(r.c), w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id GROUP BY w.doc_id"""

OP3 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
k AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i,
        unnest(list_transform(range(1, len(ws) - 48), lambda i: md5(array_to_string(ws[i:i + 49], ' ')))) AS h
      FROM w WHERE len(ws) >= 50),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS later FROM k),
g AS (SELECT p.doc_id, p.i, p.word, max(CASE WHEN m.later THEN p.i END) OVER (
        PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
      FROM p LEFT JOIN m ON m.doc_id = p.doc_id AND m.i = p.i)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(count(*) FILTER (g.gone) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(g.word, ' ' ORDER BY g.i) FILTER (NOT g.gone), '')) AS kept_sha256
FROM w LEFT JOIN g ON g.doc_id = w.doc_id GROUP BY w.doc_id, w.ws"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS size, CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR) AS b,
        min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(substr(b, i + 1, 1) AS INT) + 8 * CAST(substr(b, i + 2, 1) AS INT)
    + 4 * CAST(substr(b, i + 3, 1) AS INT) + 2 * CAST(substr(b, i + 4, 1) AS INT)
    + CAST(substr(b, i + 5, 1) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM d"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
c AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a,
    CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS pre,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid, array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""

OP13 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT vec_id, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.vec_id < b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(vec_id, c) AS (SELECT x, x FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.vec_id),
n AS (SELECT x AS vec_id, count(*) AS c FROM e GROUP BY x),
m AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id)
SELECT v.vec_id, coalesce(n.c, 0) AS n_links, coalesce(m.c, v.vec_id) AS component_id,
  coalesce(m.c, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)"""

ORACLE = {"op1_ngram_jaccard_join": OP1, "op3_substring_dedup": OP3, "op7_warc": OP7,
          "op12_fill_in_middle": OP12, "op13_embedding_near_dedup": OP13}
