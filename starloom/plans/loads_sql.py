"""Independent ANSI-SQL statements (DuckDB dialect) for ``starloom.plans.loads``."""

from starloom.plans.retail_sql import SQL as RETAIL
from starloom.plans.retail_sql import _DIMS, _customer_dim, _fact_select

_FACT = ("o_orderkey, cust_key, nation_key, region_key, date_key, o_orderstatus, order_total, line_count, "
         "total_qty, total_price, avg_qty")

FACT_RELOAD_BY_PARTITION = "WITH " + _DIMS + "," + _customer_dim() + f"""
, old AS ({_fact_select(with_lines=False)}),
new AS ({_fact_select()}),
chosen AS (SELECT dn.nation_key, dn.n_name FROM dim_nation dn JOIN dim_region dr USING (region_key)
           WHERE dr.r_name = 'ASIA')
SELECT {_FACT}, FALSE AS rewritten FROM old
WHERE NOT EXISTS (SELECT 1 FROM chosen WHERE chosen.nation_key = old.nation_key)
UNION ALL
SELECT {_FACT}, TRUE AS rewritten FROM new
WHERE o_orderstatus <> 'P'
  AND EXISTS (SELECT 1 FROM chosen WHERE chosen.nation_key = new.nation_key AND n_name <> 'CHINA')
"""

_BAD_CUSTOMER = "(c_acctbal < 0 OR c_mktsegment = 'MACHINERY')"

INGEST_ACCEPTED = f"""
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment
FROM customer WHERE NOT {_BAD_CUSTOMER}
"""

INGEST_REJECTED = f"""
SELECT 'bronze_customer' AS target_table, 'customer.csv' AS entry,
       c_custkey || '|' || c_nationkey || '|'
       || CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END
       || '|' || c_mktsegment || CASE WHEN c_mktsegment = 'MACHINERY' THEN '|x' ELSE '' END AS line
FROM customer WHERE {_BAD_CUSTOMER}
UNION ALL
SELECT 'bronze_supplier', 'supplier.csv', 'S' || s_suppkey FROM supplier
"""

INGEST_REJECT_AUDIT = f"""
SELECT 'customer.csv' AS file_name, 'bronze_customer' AS target_table, 'loaded' AS status,
       CAST(count(*) FILTER ({_BAD_CUSTOMER}) AS VARCHAR) || ' lines rejected' AS detail,
       count(*) FILTER (NOT {_BAD_CUSTOMER}) AS rows_loaded, CAST(4 AS INTEGER) AS columns
FROM customer
UNION ALL
SELECT 'supplier.csv', 'bronze_supplier', 'failed',
       'ValueError: ' || count(*) || ' of ' || count(*) || ' lines rejected, more than the limit allows', NULL, NULL
FROM supplier
"""

INGEST_DRIFT = """
SELECT CAST(1 AS INTEGER) AS delivery, 'supplier.csv' AS file_name, 'bronze_supplier' AS target_table,
       'loaded' AS status, NULL AS detail, count(*) AS rows_loaded, CAST(3 AS INTEGER) AS columns FROM supplier
UNION ALL
SELECT 2, 'supplier.csv', 'bronze_supplier', 'loaded',
       's_suppkey widened (int to bigint); s_acctbal widened (decimal(9,2) to decimal(12,2)); '
       || 's_nationkey added (- to int)', count(*), 4 FROM supplier
UNION ALL
SELECT 3, 'supplier.csv', 'bronze_supplier', 'failed',
       'SchemaDrift: schema drift: s_suppkey incompatible (bigint to string)', NULL, NULL
"""

INGEST_DRIFT_TABLE = """
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal,
       CAST(s_nationkey AS INTEGER) AS s_nationkey
FROM supplier
"""

STREAM_UPSERT = """
WITH c AS (SELECT *, coalesce(c_mktsegment = 'MACHINERY', FALSE) AS late FROM customer)
SELECT row_number() OVER (ORDER BY late, c_custkey) AS cust_key, CAST(c_custkey AS BIGINT) AS c_custkey, c_name,
       CAST(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
       TIMESTAMP '2024-01-01 00:00:00' AS dw_inserted_at,
       CASE WHEN c_acctbal < 0 AND NOT late THEN TIMESTAMP '2024-01-01 00:00:00' END AS dw_updated_at
FROM c
"""

ROLLUP_INCREMENTAL = """
WITH lines AS (
  SELECT l_orderkey, l_quantity, l_returnflag <> 'A' AS counted FROM lineitem
  WHERE l_returnflag IS DISTINCT FROM 'R')
SELECT l_orderkey, COUNT(*) AS line_count,
       CAST(SUM(CASE WHEN counted THEN CAST(floor(l_quantity) AS INTEGER) END) AS BIGINT) AS total_qty,
       CAST(CAST(AVG(CASE WHEN counted THEN CAST(floor(l_quantity) AS DECIMAL(10,0)) END) AS DECIMAL(14,4))
            AS DECIMAL(8,1)) AS avg_qty
FROM lines GROUP BY l_orderkey
"""

BUCKETED_ENRICHMENT = """
WITH kept AS (
  SELECT l_orderkey, l_suppkey, COUNT(*) AS n, CAST(SUM(CAST(floor(l_quantity) AS INTEGER)) AS BIGINT) AS q
  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2),
cut AS (
  SELECT l_orderkey, l_suppkey, COUNT(*) AS n, CAST(SUM(CAST(floor(l_quantity) AS INTEGER)) AS BIGINT) AS q
  FROM lineitem WHERE l_discount >= 0.05 GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, COALESCE(kept.n, 0) AS kept_lines, kept.q AS kept_qty,
       COALESCE(cut.n, 0) AS cut_lines, cut.q AS cut_qty
FROM lineitem l LEFT JOIN kept USING (l_orderkey, l_suppkey) LEFT JOIN cut USING (l_orderkey, l_suppkey)
"""

HOT_KEY_LOOKUP = """
SELECT l_orderkey, l_linenumber, l_suppkey, s_name, s_nationkey
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
"""

STATUS_LOOKUP = """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus IN (SELECT l_linestatus FROM lineitem) THEN 'Status ' || o_orderstatus END AS finish_status
FROM orders
"""

_PROFILED = {"c_custkey": "c_custkey", "c_name": "c_name", "c_nationkey": "c_nationkey", "c_acctbal": "c_acctbal",
             "c_mktsegment": "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END"}

LOAD_PROFILE = " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", CAST(2 AS BIGINT) AS loads, COUNT(*) AS "rows",
               COUNT(*) FILTER ({value} IS NULL) AS nulls, TRUE AS near_exact FROM customer"""
    for name, value in _PROFILED.items())

TABLE_LIFECYCLE = """
SELECT CAST(n_nationkey AS BIGINT) AS place_key, n_name AS place_name, CAST(n_regionkey AS SMALLINT) AS place_code,
       CAST(NULL AS VARCHAR) AS remark
FROM nation
"""

RUN_RESTART = """
WITH r AS (SELECT COUNT(*) AS n FROM region), a AS (SELECT COUNT(*) AS n FROM nation),
b AS (SELECT COUNT(*) AS n FROM nation WHERE n_regionkey IS NOT NULL)
SELECT CAST(1 AS INTEGER) AS run, 'regions' AS step, 'ran' AS outcome, n AS "rows" FROM r
UNION ALL SELECT 1, 'nations', 'ran', n FROM a
UNION ALL SELECT 1, 'places', 'failed', NULL
UNION ALL SELECT 2, 'regions', 'skipped', n FROM r
UNION ALL SELECT 2, 'nations', 'skipped', n FROM a
UNION ALL SELECT 2, 'places', 'ran', n FROM a
UNION ALL SELECT 3, 'regions', 'skipped', n FROM r
UNION ALL SELECT 3, 'nations', 'ran', n FROM b
UNION ALL SELECT 3, 'places', 'ran', n FROM b
"""

VERSION_RETENTION = """
SELECT CAST(1 AS INTEGER) AS version, FALSE AS stored, CAST(NULL AS BIGINT) AS "rows"
UNION ALL SELECT 2, TRUE, COUNT(*) FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT 3, FALSE, NULL
UNION ALL SELECT 4, TRUE, COUNT(*) FROM customer
"""

SQL = {
    "fact_reload_by_partition": FACT_RELOAD_BY_PARTITION,
    "calendar_append_job": RETAIL["calendar_append"],
    "ingest_accepted": INGEST_ACCEPTED,
    "ingest_rejected": INGEST_REJECTED,
    "ingest_reject_audit": INGEST_REJECT_AUDIT,
    "ingest_drift": INGEST_DRIFT,
    "ingest_drift_table": INGEST_DRIFT_TABLE,
    "stream_upsert": STREAM_UPSERT,
    "rollup_incremental": ROLLUP_INCREMENTAL,
    "bucketed_enrichment": BUCKETED_ENRICHMENT,
    "hot_key_lookup": HOT_KEY_LOOKUP,
    "status_lookup": STATUS_LOOKUP,
    "load_profile": LOAD_PROFILE,
    "table_lifecycle": TABLE_LIFECYCLE,
    "run_restart": RUN_RESTART,
    "version_retention": VERSION_RETENTION,
}
