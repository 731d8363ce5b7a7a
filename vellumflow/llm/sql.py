"""SQL for DuckDB of the operators that SQL can express, by plain means."""

from __future__ import annotations

import string

from . import neardup, packing, substring

WORD = r"[^\x20\x09-\x0D]+"


def near_duplicates() -> str:
    k, t = neardup.WORDS, neardup.PERCENT
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= {t} * (nx.n + ny.n - o)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT w.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id FROM w JOIN r ON r.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id"""


def substrings() -> str:
    k = substring.WINDOW
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i:i + {k - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM w WHERE len(w) >= {k})),
f AS (SELECT s, min(doc_id) AS first FROM v GROUP BY s),
g AS (SELECT DISTINCT doc_id, i + d AS k FROM v JOIN f USING (s), range({k}) t(d) WHERE first < doc_id),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM w),
r AS (SELECT p.doc_id, count(*) AS n, count(g.k) AS gone, string_agg(word, ' ' ORDER BY p.k) FILTER (g.k IS NULL) AS kept FROM p LEFT JOIN g ON g.doc_id = p.doc_id AND g.k = p.k GROUP BY p.doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN r USING (doc_id)"""


def packs() -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n FROM documents),
h AS (SELECT n AS len, count(*) AS c, row_number() OVER (ORDER BY n) AS j FROM d GROUP BY n),
q AS (SELECT j, len, sum(c) OVER w AS cs, sum(c * len) OVER w AS ms FROM h WINDOW w AS (ORDER BY j)),
z AS (SELECT j, len, cs, ms FROM q UNION ALL SELECT 0, 0, 0, 0),
cost AS (SELECT a.j AS i, b.j AS j, ((b.cs - a.cs) * b.len - (b.ms - a.ms))::BIGINT AS cost FROM z a JOIN q b ON a.j < b.j),
dp AS (SELECT 1 AS k, j, cost, 0::BIGINT AS split FROM cost WHERE i = 0
  UNION ALL SELECT * FROM (SELECT k, j, least(best.m, old) AS cost, CASE WHEN best.m < old THEN best.i ELSE 0 END AS split FROM (
    SELECT p.k + 1 AS k, c.j, min({{'m': p.cost + c.cost, 'i': c.i}}) AS best, any_value(o.cost) AS old FROM dp p JOIN cost c ON c.i = p.j JOIN dp o ON o.j = c.j AND o.k = p.k WHERE p.k < {packing.BUCKETS} GROUP BY p.k, c.j)
    UNION ALL SELECT k + 1, j, cost, 0 FROM dp WHERE k < {packing.BUCKETS} AND j = 1)),
back AS (SELECT {packing.BUCKETS} AS k, max(j) AS j, NULL::BIGINT AS taken FROM q
  UNION ALL SELECT b.k - 1, CASE WHEN s.split > 0 THEN s.split ELSE b.j END, CASE WHEN s.split > 0 OR b.k = 1 THEN b.j END FROM back b JOIN dp s ON s.k = b.k AND s.j = b.j WHERE b.k > 0),
ends AS (SELECT len AS bucket_length, row_number() OVER (ORDER BY len) - 1 AS bucket FROM back JOIN q ON q.j = back.taken),
b AS (SELECT d.doc_id, d.n, min({{'b': e.bucket, 'l': e.bucket_length}}) AS e FROM d JOIN ends e ON d.n <= e.bucket_length GROUP BY d.doc_id, d.n),
r AS (SELECT doc_id, n, e.b AS bucket, e.l AS bucket_length, row_number() OVER (PARTITION BY e.b ORDER BY doc_id, n) - 1 AS pos, greatest(1, {packing.BUDGET} // greatest(e.l, 1)) AS room FROM b)
SELECT doc_id, n AS n_words, bucket::INTEGER AS bucket, bucket_length, pos // room AS batch, pos % room AS slot FROM r"""
