"""DuckDB statements for the queries that SQL can express over whole tables in
reasonable time.  The others (models, tokenizers, approximate search, byte
windows) are compared with brute force in the tests."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
s AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM s),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
h AS (SELECT ds.doc_id, ds.i, ds.n, bw.item_id FROM ds JOIN bw ON bw.n = ds.n AND bw.win = array_to_string(ds.w[ds.i:ds.i + ds.n - 1], ' ')),
hit AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
met AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN met ON met.doc_id = d.doc_id"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, least(4, len(w)) AS n, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS g FROM p),
c AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x.a, x.b FROM x JOIN c ca ON ca.doc_id = x.a JOIN c cb ON cb.doc_id = x.b WHERE 100 * x.n >= 80 * (ca.n + cb.n - x.n)),
r AS (SELECT doc_id AS doc, doc_id AS seen FROM d UNION SELECT r.doc, e.b FROM r JOIN e ON e.a = r.seen)
SELECT d.doc_id, COALESCE(c.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN c ON c.doc_id = d.doc_id JOIN (SELECT doc, MIN(seen) AS component_id FROM r GROUP BY doc) m ON m.doc = d.doc_id"""

OP6 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS win FROM p),
f AS (SELECT win, MIN(doc_id) AS first FROM g GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g JOIN f ON f.win = g.win WHERE f.first < g.doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.j) AS body FROM words a
         LEFT JOIN gone z ON z.doc_id = a.doc_id AND z.j = a.j WHERE z.j IS NULL GROUP BY a.doc_id),
n AS (SELECT doc_id, COUNT(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, COALESCE(n.n, 0) AS n_removed, sha256(COALESCE(kept.body, '')) AS kept_sha256
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

ORACLE_SQL: dict[str, str] = {"op1_decontamination": OP1, "op4_minhash": OP4, "op6_de_bruijn": OP6}
