"""DuckDB statements that must return the same rows as :mod:`quayside.queries`.

Only the oracle: the implementation never runs this SQL.
"""

from __future__ import annotations

_MANIFEST = ("SELECT event_type || '_' || CAST(event_id AS VARCHAR) || CASE WHEN event_id % 4 = 0 "
             "THEN '.tmp' ELSE '.csv' END AS name, ts FROM events")

_CLAIMS = """
c AS (SELECT CAST(l_orderkey AS VARCHAR) AS talon, l_returnflag AS source, CAST(l_linenumber AS VARCHAR) AS line,
             CAST(l_partkey AS VARCHAR) AS part, strftime(l_shipdate, '%Y-%m-%d') AS ship_date, l_shipdate FROM lineitem),
b1 AS (SELECT *, COUNT(*) OVER (PARTITION BY talon, source) AS n FROM c WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'),
b2 AS (SELECT *, COUNT(*) OVER (PARTITION BY talon, source) AS n FROM c WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00')"""

ORACLE_SQL: dict[str, str] = {
    "map_strict": "SELECT CAST(o_orderkey AS VARCHAR) AS talon, o_orderstatus AS source, "
                  "o_orderpriority AS status FROM orders",
    "map_lenient": "SELECT n_nationkey AS nation_id, n_name AS name, n_regionkey FROM nation",
    "missing_columns": "SELECT 'n_comment' AS missing_column UNION ALL SELECT 'n_population' AS missing_column",
    "required_columns": "SELECT 'c_name' AS column_name UNION ALL SELECT 'c_mktsegment' AS column_name",
    "fill_missing_required": "SELECT c_custkey, c_name, '-' AS policy, '-' AS uet FROM customer",
    "null_tokens_fill": """
WITH s AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'none' WHEN 3 THEN NULL
                  WHEN 4 THEN '#N/A' ELSE event_type END AS v FROM events)
SELECT event_id, CASE WHEN v IS NULL OR v IN ('','#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN','-nan',
       '1.#IND','1.#QNAN','<NA>','N/A','NA','NULL','NaN','None','n/a','nan','null') THEN '-' ELSE v END AS v FROM s""",
    "flag_complex": """
WITH s AS (SELECT l_orderkey, NULLIF(l_returnflag, 'N') AS source, l_linenumber, l_partkey FROM lineitem)
SELECT l_orderkey, source, l_linenumber, l_partkey,
       (source IS NOT NULL AND COUNT(*) OVER (PARTITION BY l_orderkey, source) > 1) AS is_complex FROM s""",
    "split_counts": """
WITH s AS (SELECT l_orderkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_returnflag)
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, CAST(SUM(CASE WHEN n = 1 THEN n ELSE 0 END) AS BIGINT) AS n_normal,
       CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS n_complex FROM s""",
    "split_normal": """
SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_returnflag) AS n FROM lineitem) s WHERE n = 1""",
    "split_repeated": """
SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_returnflag) AS n FROM lineitem) s WHERE n > 1""",
    "dedupe_last": """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) t
WHERE rn = 1""",
    "upsert": """
WITH t AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, '2000' AS created_at, '2000' AS updated_at
           FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'),
b AS (SELECT o_orderkey, 'Z' AS o_orderstatus, o_totalprice + 1 AS o_totalprice
      FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00')
SELECT COALESCE(t.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NULL THEN t.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       t.o_orderpriority AS o_orderpriority,
       CASE WHEN b.o_orderkey IS NULL THEN t.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
       COALESCE(t.created_at, '2001') AS created_at, COALESCE(t.updated_at, '2001') AS updated_at
FROM t FULL OUTER JOIN b ON t.o_orderkey = b.o_orderkey""",
    "replace_by_key": """
WITH t AS (SELECT l_orderkey, l_returnflag, l_linenumber, l_quantity FROM lineitem
           WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'),
b AS (SELECT l_orderkey, l_returnflag, l_linenumber, l_quantity + 100 AS l_quantity FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = t.l_orderkey AND b.l_returnflag = t.l_returnflag)
UNION ALL SELECT * FROM b""",
    "table_health": """
SELECT 'orders' AS table_name, TRUE AS ok, (SELECT COUNT(*) FROM orders) AS n_rows
UNION ALL SELECT 'labels', TRUE, (SELECT COUNT(*) FROM labels)
UNION ALL SELECT 'no_such_table', FALSE, CAST(NULL AS BIGINT)""",
    "classify_files": f"""
WITH m AS ({_MANIFEST})
SELECT name, CASE WHEN NOT (name LIKE 'view!_%.csv' ESCAPE '!') THEN 'invalid'
                  WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 'valid' ELSE 'young' END AS state FROM m""",
    "latest_by_name": """
WITH m AS (SELECT event_type, event_type || '_' || CAST(event_id AS VARCHAR) || '.csv' AS name FROM events)
SELECT event_type, MAX(name) AS name FROM m GROUP BY event_type""",
    "latest_by_time": """
SELECT event_type, event_id FROM (
  SELECT event_type, event_id, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) x WHERE rn = 1""",
    "route_files": """
WITH m AS (SELECT event_type || '_' || CAST(event_id AS VARCHAR) || '.csv' AS name FROM events),
r AS (SELECT 0 AS pos, 'errors' AS table_name, 'error!_%.csv' AS pat, FALSE AS registered
      UNION ALL SELECT 1, 'views', 'view!_%.csv', TRUE UNION ALL SELECT 2, 'clicks', 'click!_%.csv', TRUE),
h AS (SELECT r.pos, r.table_name, MAX(m.name) AS name FROM r JOIN m ON m.name LIKE r.pat ESCAPE '!'
      WHERE r.registered GROUP BY r.pos, r.table_name)
SELECT table_name, name FROM h ORDER BY pos LIMIT 1""",
    "plan_file_actions": """
WITH f AS (SELECT event_type || '_' || CAST(event_id AS VARCHAR) || '.csv' AS name, ts AS mtime,
                  CAST(event_id * 7 + 100 AS BIGINT) AS length FROM events),
l AS (SELECT event_type || '_' || CAST(event_id AS VARCHAR) || '.csv' AS name, ts AS mtime,
             CAST(CASE WHEN event_id % 5 = 0 THEN event_id * 7 + 101 ELSE event_id * 7 + 100 END AS BIGINT) AS length,
             CASE event_id % 4 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'FAILURE' WHEN 2 THEN 'RUNNING' ELSE NULL END
               AS run_status
      FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')
SELECT f.name, CASE WHEN l.name IS NULL THEN 'launch' WHEN run_status = 'SUCCESS' THEN 'retire'
                    WHEN run_status = 'FAILURE' THEN 'relaunch' ELSE 'wait' END AS action
FROM f LEFT JOIN l ON f.name = l.name AND f.mtime = l.mtime AND f.length = l.length""",
    "incremental_window": """
SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
  AND o_orderdate >= TIMESTAMP '1997-03-14 00:00:00'""",
    "stream_ingest": """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) t
WHERE rn = 1""",
    "load_report": """
WITH u AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
           UNION SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00')
SELECT 'orders' AS table_name, 'success' AS status, COUNT(*) AS final_count FROM u""",
    "read_delimited": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer""",
    "decode_charset": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, translate(c_name, 'Customer#', 'КлиентЁр№') AS patient,
       '№ ' || CAST(c_custkey AS VARCHAR) AS history_number, '«' || c_mktsegment || '»' AS segment FROM customer""",
    "fill_sentinel": "SELECT event_id, COALESCE(NULLIF(event_type, 'view'), '-') AS event_type FROM events",
    "retire_files": f"""
WITH m AS ({_MANIFEST})
SELECT name, CASE WHEN NOT (name LIKE 'view!_%.csv' ESCAPE '!') THEN 'QUARANTINED' ELSE 'RETIRED' END AS run_status
FROM m WHERE NOT (name LIKE 'view!_%.csv' ESCAPE '!') OR ts <= TIMESTAMP '2024-01-20 00:00:00'""",
    "publish_snapshot": "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0",
    "journal_flow": """
SELECT CAST(s_suppkey AS VARCHAR) AS number, CASE WHEN s_acctbal >= 5000 THEN upper(s_name) ELSE s_name END AS name,
       '-' AS comment FROM supplier""",
    "claims_flagship": f"""
WITH {_CLAIMS},
n AS (SELECT talon, source FROM b1 WHERE n = 1 UNION SELECT talon, source FROM b2 WHERE n = 1),
r1 AS (SELECT talon, source FROM b1 WHERE n > 1),
r2 AS (SELECT talon, source FROM b2 WHERE n > 1)
SELECT 'claims_normal' AS table_name, 'success' AS status, CAST((SELECT COUNT(*) FROM n) AS BIGINT) AS final_count
UNION ALL
SELECT 'claims_repeated', 'success', CAST((SELECT COUNT(*) FROM r1 WHERE NOT EXISTS (
    SELECT 1 FROM r2 WHERE r2.talon = r1.talon AND r2.source = r1.source)) + (SELECT COUNT(*) FROM r2) AS BIGINT)""",
    "claims_normal_rows": f"""
WITH {_CLAIMS},
n1 AS (SELECT * FROM b1 WHERE n = 1),
n2 AS (SELECT * FROM b2 WHERE n = 1)
SELECT COALESCE(n2.talon, n1.talon) AS talon, COALESCE(n2.source, n1.source) AS source,
       CASE WHEN n2.talon IS NULL THEN n1.line ELSE n2.line END AS line,
       CASE WHEN n2.talon IS NULL THEN n1.part ELSE n2.part END AS part,
       CASE WHEN n2.talon IS NULL THEN n1.ship_date ELSE n2.ship_date END AS ship_date,
       FALSE AS is_complex,
       CASE WHEN n1.talon IS NULL THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at,
       CASE WHEN n1.talon IS NULL THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
FROM n1 FULL OUTER JOIN n2 ON n1.talon = n2.talon AND n1.source = n2.source""",
}

ORACLE_SQL["stream_journal"] = ORACLE_SQL["journal_flow"]

ORACLE_SQL["route_files_all"] = """
WITH m AS (SELECT event_type || '_' || CAST(event_id AS VARCHAR) || '.csv' AS name FROM events),
r AS (SELECT 'views' AS table_name, 'view!_%.csv' AS pat UNION ALL SELECT 'clicks', 'click!_%.csv'
      UNION ALL SELECT 'all_csv', '%!_%.csv')
SELECT r.table_name, MAX(m.name) AS name FROM r JOIN m ON m.name LIKE r.pat ESCAPE '!' GROUP BY r.table_name"""

ORACLE_SQL["dedupe_file_order"] = """
WITH a AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders
           WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'),
b AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, lower(o_orderstatus) AS o_orderstatus FROM orders
      WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00')
SELECT o_orderkey, o_orderstatus FROM b
UNION ALL SELECT o_orderkey, o_orderstatus FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)"""

ORACLE_SQL["journal_two_part_key"] = """
WITH a AS (SELECT CAST(l_orderkey AS VARCHAR) AS series,
                  CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
                    || '-' || strftime(l_shipdate, '%Y%m%d') AS number,
                  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity, strftime(l_shipdate, '%d.%m.%Y') AS ship_date
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'),
b AS (SELECT CAST(l_orderkey AS VARCHAR) AS series,
             CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
               || '-' || strftime(l_shipdate, '%Y%m%d') AS number,
             CAST(CAST(l_quantity AS INTEGER) + 1000 AS VARCHAR) AS quantity, strftime(l_shipdate, '%d.%m.%Y') AS ship_date
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00')
SELECT series, number, quantity, ship_date FROM b
UNION ALL SELECT series, number, quantity, ship_date FROM a
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.series = a.series AND b.number = a.number)"""

ORACLE_SQL["landing_scan"] = """
SELECT event_type, COUNT(*) AS n_rows FROM events WHERE event_type <> 'view' GROUP BY event_type"""

_CLAIM_FILES = """
l AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS talon, CASE l_returnflag WHEN 'A' THEN '-' WHEN 'R' THEN 'R' END AS src,
             strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM lineitem),
d AS (SELECT 1 AS day, * FROM l WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'
      UNION ALL SELECT 2, * FROM l WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'),
n AS (SELECT *, COUNT(*) OVER (PARTITION BY day, talon, src) AS n FROM d)"""
_CLAIM_COLUMNS = """CAST(l_linenumber AS VARCHAR) AS line, CAST(l_partkey AS VARCHAR) AS part, ship_date,
       TIMESTAMP '2024-01-03 00:00:00' AS created_at, TIMESTAMP '2024-01-03 00:00:00' AS updated_at"""

ORACLE_SQL["claims_files_rows"] = f"""
WITH {_CLAIM_FILES},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY talon, COALESCE(src, '-') ORDER BY day DESC, l_returnflag DESC,
             l_linenumber DESC, l_partkey DESC, l_shipdate DESC) AS rn FROM n WHERE src IS NULL OR n = 1)
SELECT talon, COALESCE(src, '-') AS source, FALSE AS is_complex, {_CLAIM_COLUMNS} FROM r WHERE rn = 1"""

ORACLE_SQL["claims_repeated_rows"] = f"""
WITH {_CLAIM_FILES},
r AS (SELECT *, MAX(day) OVER (PARTITION BY talon, src) AS last FROM n WHERE src IS NOT NULL AND n > 1)
SELECT talon, src AS source, TRUE AS is_complex, {_CLAIM_COLUMNS} FROM r WHERE day = last"""

ORACLE_SQL["routed_claims_rows"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS talon, l_returnflag AS source, MAX(CAST(l_linenumber AS VARCHAR)) AS line, '-' AS uet,
       FALSE AS is_complex FROM lineitem GROUP BY l_orderkey, l_returnflag"""

ORACLE_SQL["read_delimited_stray_quotes"] = """
SELECT CAST(c_custkey AS VARCHAR) AS k, CASE c_custkey % 3 WHEN 0 THEN '5" pipe' WHEN 1 THEN '7" x' ELSE '' END AS v,
       CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'a;b' ELSE c_name || '"s' || chr(10) END AS w FROM customer"""

ORACLE_SQL["quarantine_rows"] = """
SELECT CASE WHEN s_acctbal < 1000 THEN 'bad' ELSE 'good' END AS state, CAST(s_suppkey AS VARCHAR) || ';' || s_name
       || CASE WHEN s_acctbal < 0 THEN ';;LOST' WHEN s_acctbal < 1000 THEN ';' ELSE '' END AS record FROM supplier"""

ORACLE_SQL["read_split_multiline"] = """
SELECT CAST(c_custkey AS VARCHAR) AS k,
       CASE WHEN c_acctbal > 0 THEN 'said "' || c_name || '";' || chr(10) || chr(10) || c_mktsegment || chr(10) ELSE c_name END AS note,
       CASE WHEN c_nationkey < 12 THEN c_name || ';' || c_mktsegment || chr(10) ELSE c_mktsegment END AS segment FROM customer"""

ORACLE_SQL["file_layout_report"] = """
SELECT DISTINCT o_orderstatus AS export, m.missing_column FROM orders
JOIN (VALUES ('O', 'o_orderpriority'), ('P', 'o_orderpriority'), ('P', 'o_totalprice')) AS m(status, missing_column) ON m.status = o_orderstatus"""

ORACLE_SQL["stream_settled_files"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS number, s_name AS name, 'final' AS balance, 1 AS versions FROM supplier"""

ORACLE_SQL["stream_reuploads"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS number, s_name AS name, CASE WHEN s_acctbal >= 0 THEN 'again' ELSE 'first' END AS balance, 2 AS versions FROM supplier"""

ORACLE_SQL["stream_replace_rows"] = """
WITH late AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00')
SELECT CAST(l_orderkey AS VARCHAR) AS "order", CAST(l_linenumber AS VARCHAR) AS line, '-1' AS qty, 2 AS versions FROM late
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2 FROM lineitem
WHERE l_orderkey NOT IN (SELECT l_orderkey FROM late)"""

ORACLE_SQL["claims_atomic_rows"] = """
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS talon, l_returnflag AS source, l_quantity > 45 AS bad FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01 00:00:00'),
g AS (SELECT *, COUNT(*) OVER (PARTITION BY talon, source, bad) AS n FROM l)
SELECT CASE WHEN bad THEN 'bad' WHEN n > 1 THEN 'repeated' ELSE 'normal' END AS table_name, source, 'day1' AS ship_date, COUNT(*) AS n_rows,
       MIN(talon) AS least, MAX(talon) AS most FROM g GROUP BY 1, 2
UNION ALL SELECT 'handled', 'SUCCESS', NULL, 1, 'claims_day1', 'claims_day1'"""

ORACLE_SQL["tick_rows"] = """
SELECT 'supplier ' || CAST(s_suppkey AS VARCHAR) AS what, CASE WHEN s_acctbal < 0 THEN 'again' ELSE 'first' END AS value FROM supplier
UNION ALL SELECT 'files FAILURE', '2024-01-01' UNION ALL SELECT 'files SUCCESS', '2024-01-02' UNION ALL SELECT 'files SUCCESS', '2024-01-04'"""

ORACLE_SQL["upsert_bitmap_rows"] = """
WITH l AS (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS k FROM lineitem),
s AS (SELECT k, CAST(MAX(l_quantity) AS INTEGER) AS qty FROM l WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00' GROUP BY k),
b AS (SELECT k, CAST(-MAX(l_quantity) AS INTEGER) AS qty FROM l WHERE l_shipdate >= TIMESTAMP '1997-10-01 00:00:00' GROUP BY k)
SELECT COALESCE(b.k, s.k) AS k, COALESCE(b.qty, s.qty) AS qty, CASE WHEN s.k IS NULL THEN 2001 ELSE 2000 END AS created FROM s FULL JOIN b ON s.k = b.k"""

ORACLE_SQL["snapshot_at_rows"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus || ' 1997' AS status, 'orders_19970101_080000' AS snapshot, 3 AS snapshots
FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01 00:00:00'"""

ORACLE_SQL["tick_actions"] = """
SELECT event_type || '_' || CAST(event_id AS VARCHAR) || '.csv' AS name,
       CASE WHEN event_id % 4 = 0 THEN 'retire' WHEN event_id % 8 = 2 THEN 'wait' WHEN event_id % 2 = 0 THEN 'relaunch'
            ELSE 'launch' END AS action FROM events"""

ORACLE_SQL["bucket_change_rows"] = """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' THEN 'Z' ELSE o_orderstatus END AS o_orderstatus
FROM orders"""

ORACLE_SQL["replace_by_key_hot"] = """
WITH t AS (SELECT CASE WHEN l_linenumber % 3 = 0 THEN -1 ELSE l_orderkey END AS k, l_partkey, l_linenumber FROM lineitem),
b AS (SELECT l_orderkey AS k, l_partkey, -l_linenumber AS l_linenumber FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00')
SELECT * FROM t WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT * FROM b"""

ORACLE_SQL["skip_empty_report"] = """
SELECT 'orders' AS table_name, 'skipped' AS status, (SELECT COUNT(*) FROM orders) AS final_count, 1 AS versions"""

ORACLE_SQL["incremental_window_two"] = """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND l_shipdate >= TIMESTAMP '1997-03-14 00:00:00'"""

ORACLE_SQL["fill_missing_counts"] = """
SELECT COUNT(*) AS n_population, COUNT(*) AS n_c_mktsegment, COUNT(*) AS n_c_name, COUNT(*) AS n_rows FROM customer"""

ORACLE_SQL["drop_audit_upsert"] = """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 2000 ELSE 2001 END AS created FROM orders"""

ORACLE_SQL["partitioned_upsert_rows"] = ORACLE_SQL["drop_audit_upsert"]
