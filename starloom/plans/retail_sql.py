"""Independent ANSI-SQL statements (DuckDB dialect) computing what each
function of ``starloom.plans.retail`` computes, over the same tables.
Used as the correctness oracle."""

_DIMS = """
dim_region AS (
  SELECT r_regionkey, r_name, ROW_NUMBER() OVER (ORDER BY r_regionkey) AS region_key FROM region),
dim_nation AS (
  SELECT n.n_nationkey, n.n_name, dr.region_key,
         ROW_NUMBER() OVER (ORDER BY n.n_nationkey) AS nation_key
  FROM nation n LEFT JOIN dim_region dr ON dr.r_regionkey = n.n_regionkey),
dim_order_date AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders WHERE o_orderdate IS NOT NULL),
dim_date AS (
  SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
         full_date FROM dim_order_date),
li AS (
  SELECT l_orderkey, COUNT(*) AS line_count,
         CAST(SUM(CAST(floor(l_quantity) AS INTEGER)) AS BIGINT) AS total_qty,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS total_price,
         CAST(CAST(AVG(CAST(l_quantity AS DECIMAL(10,0))) AS DECIMAL(14,4)) AS DECIMAL(8,1)) AS avg_qty
  FROM lineitem GROUP BY l_orderkey)
"""


def _customer_dim(where: str = "") -> str:
    return f"""
dim_customer AS (
  SELECT c.c_custkey, dn.nation_key, ROW_NUMBER() OVER (ORDER BY c.c_custkey) AS cust_key
  FROM customer c LEFT JOIN dim_nation dn ON dn.n_nationkey = c.c_nationkey {where})
"""


def _fact_select(with_lines: bool = True, extra: str = "") -> str:
    if with_lines:
        lines = ("COALESCE(li.line_count, 0) AS line_count, li.total_qty, li.total_price, li.avg_qty")
        join = "LEFT JOIN li ON li.l_orderkey = o.o_orderkey"
    else:
        lines = ("CAST(0 AS BIGINT) AS line_count, CAST(NULL AS BIGINT) AS total_qty, "
                 "CAST(NULL AS DECIMAL(38,2)) AS total_price, CAST(NULL AS DECIMAL(8,1)) AS avg_qty")
        join = ""
    return f"""
SELECT o.o_orderkey, dc.cust_key, dn.nation_key, dr.region_key, dd.date_key, o.o_orderstatus,
       CAST(o.o_totalprice AS DECIMAL(15,2)) AS order_total, {lines} {extra}
FROM orders o
{join}
LEFT JOIN dim_customer dc ON dc.c_custkey = o.o_custkey
LEFT JOIN dim_nation dn ON dn.nation_key = dc.nation_key
LEFT JOIN dim_region dr ON dr.region_key = dn.region_key
LEFT JOIN dim_date dd ON dd.full_date = CAST(o.o_orderdate AS DATE)
"""


STAR_FACT = "WITH " + _DIMS + "," + _customer_dim() + _fact_select()

STAR_FACT_REQUIRED = ("WITH " + _DIMS + "," + _customer_dim()
                      + "SELECT * FROM (" + _fact_select() + ") f WHERE total_qty IS NOT NULL")


STAR_FACT_RELOAD = ("WITH " + _DIMS + "," + _customer_dim() + f"""
, old AS ({_fact_select(with_lines=False, extra=", o.o_custkey")}),
new AS ({_fact_select(extra=", o.o_custkey")}),
chosen AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT o_orderkey, cust_key, nation_key, region_key, date_key, o_orderstatus, order_total,
       line_count, total_qty, total_price, avg_qty
FROM old WHERE NOT EXISTS (SELECT 1 FROM chosen WHERE chosen.c_custkey = old.o_custkey)
UNION ALL
SELECT o_orderkey, cust_key, nation_key, region_key, date_key, o_orderstatus, order_total,
       line_count, total_qty, total_price, avg_qty
FROM new WHERE o_orderstatus <> 'P' AND EXISTS (SELECT 1 FROM chosen WHERE chosen.c_custkey = new.o_custkey)
""")

FACT_QUARANTINE = ("WITH " + _DIMS + "," + _customer_dim("WHERE c.c_acctbal >= 0") + f"""
, f AS ({_fact_select(extra=", o.o_custkey")})
SELECT o_orderkey, o_custkey,
       concat_ws(',', CASE WHEN cust_key IS NULL THEN 'cust_key' END,
                      CASE WHEN nation_key IS NULL THEN 'nation_key' END,
                      CASE WHEN region_key IS NULL THEN 'region_key' END,
                      CASE WHEN date_key IS NULL THEN 'date_key' END) AS unresolved
FROM f
WHERE cust_key IS NULL OR nation_key IS NULL OR region_key IS NULL OR date_key IS NULL
""")

CHILD_ROLLUP = """
SELECT l_orderkey, l_suppkey, COUNT(*) AS line_count,
       CAST(SUM(CAST(floor(l_quantity) AS INTEGER)) AS BIGINT) AS total_qty,
       CAST(CAST(AVG(CAST(CAST(floor(l_quantity) AS INTEGER) AS DECIMAL(10,0))) AS DECIMAL(14,4)) AS DECIMAL(8,1)) AS avg_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS total_price
FROM lineitem GROUP BY l_orderkey, l_suppkey
"""


def _calendar_of(dates_sql: str) -> str:
    return f"""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
       d AS full_date,
       CAST(year(d) AS SMALLINT) AS year,
       CAST(quarter(d) AS TINYINT) AS quarter,
       CAST(month(d) AS TINYINT) AS month_num,
       strftime(d, '%B') AS month_name,
       CAST(day(d) AS TINYINT) AS day_of_month,
       CAST(dayofweek(d) + 1 AS TINYINT) AS day_of_week_num,
       strftime(d, '%A') AS day_of_week_name,
       dayofweek(d) IN (0, 6) AS is_weekend,
       CAST(year(d) AS SMALLINT) AS season
FROM ({dates_sql}) days
"""


_ORDER_DATES = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL"

CALENDAR = _calendar_of(_ORDER_DATES)

CALENDAR_NEW_ONLY = _calendar_of(
    _ORDER_DATES + " AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE CAST(l.l_shipdate AS DATE) = CAST(orders.o_orderdate AS DATE))")

_RENDERED = """
SELECT o_orderkey, o_custkey, o_orderpriority,
       CASE o_orderpriority
         WHEN '1-URGENT' THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
         WHEN '2-HIGH' THEN strftime(CAST(o_orderdate AS DATE), '%d-%m-%Y')
         WHEN '3-MEDIUM' THEN strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y')
         WHEN '4-NOT SPECIFIED' THEN strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y')
         WHEN '5-LOW' THEN strftime(CAST(o_orderdate AS DATE), '%Y.%m.%d')
       END AS date_text
FROM orders
"""

_PARSE = """COALESCE(CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE),
                CAST(try_strptime(date_text, '%d-%m-%Y') AS DATE),
                CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE),
                CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE))"""

DATE_NORMALISE = f"""
SELECT o_orderkey, o_orderpriority, date_text, {_PARSE} AS parsed_date
FROM ({_RENDERED}) r
"""

RACE_STYLE_LOOKUP = ("WITH " + _DIMS + "," + _customer_dim() + f"""
, r AS (SELECT o_orderkey, o_custkey, {_PARSE} AS order_date FROM ({_RENDERED}) x)
SELECT r.o_orderkey, dc.cust_key, r.order_date, dd.date_key
FROM r
LEFT JOIN dim_customer dc ON dc.c_custkey = r.o_custkey
LEFT JOIN dim_date dd ON dd.full_date = r.order_date
""")

_MERGE_INPUTS = """
tgt AS (
  SELECT c_custkey + 1 AS cust_key, c_custkey, c_name, c_nationkey,
         CAST(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(c_acctbal AS DECIMAL(12,2)) - 100
                   ELSE CAST(c_acctbal AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS c_acctbal,
         c_mktsegment,
         TIMESTAMP '2023-01-01 00:00:00' AS dw_inserted_at,
         CAST(NULL AS TIMESTAMP) AS dw_updated_at
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
src AS (
  SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND c_custkey IS NOT NULL)
"""


def _merge_sql(matched_touch: str = "TIMESTAMP '2024-01-01 00:00:00'",
               inserted_touch: str = "CAST(NULL AS TIMESTAMP)",
               action: bool = False, only_changed: bool = False) -> str:
    changed = ("(t.c_name IS DISTINCT FROM s.c_name OR t.c_nationkey IS DISTINCT FROM s.c_nationkey "
               "OR t.c_acctbal IS DISTINCT FROM s.c_acctbal OR t.c_mktsegment IS DISTINCT FROM s.c_mktsegment)")
    touch = f"CASE WHEN {changed} THEN {matched_touch} ELSE t.dw_updated_at END" if only_changed else matched_touch
    act_m = (f", CASE WHEN {changed} THEN 'updated' ELSE 'unchanged' END AS merge_action" if only_changed
             else ", 'updated' AS merge_action") if action else ""
    act_k = ", 'kept' AS merge_action" if action else ""
    act_i = ", 'inserted' AS merge_action" if action else ""
    return f"""WITH {_MERGE_INPUTS}
SELECT t.cust_key, t.c_custkey, s.c_name, s.c_nationkey, s.c_acctbal, s.c_mktsegment,
       t.dw_inserted_at, {touch} AS dw_updated_at {act_m}
FROM tgt t JOIN src s ON s.c_custkey = t.c_custkey
UNION ALL
SELECT t.cust_key, t.c_custkey, t.c_name, t.c_nationkey, t.c_acctbal, t.c_mktsegment,
       t.dw_inserted_at, t.dw_updated_at {act_k}
FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.c_custkey = t.c_custkey)
UNION ALL
SELECT (SELECT max(cust_key) FROM tgt) + ROW_NUMBER() OVER (ORDER BY s.c_custkey) AS cust_key,
       s.c_custkey, s.c_name, s.c_nationkey, s.c_acctbal, s.c_mktsegment,
       TIMESTAMP '2024-01-01 00:00:00' AS dw_inserted_at, {inserted_touch} AS dw_updated_at {act_i}
FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.c_custkey = s.c_custkey)
"""


SCD1_CUSTOMER = _merge_sql()
SCD1_CHANGED_ONLY = _merge_sql(action=True, only_changed=True)
SCD1_IDEMPOTENT = _merge_sql(inserted_touch="TIMESTAMP '2024-01-01 00:00:00'")

SURROGATE_KEYS = """
WITH ex AS (
  SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS part_key
  FROM (SELECT DISTINCT l_partkey AS p_partkey FROM lineitem
        WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00') x),
nw AS (SELECT p_partkey FROM part p WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.p_partkey = p.p_partkey))
SELECT p_partkey, part_key FROM ex
UNION ALL
SELECT p_partkey, (SELECT COALESCE(max(part_key), 0) FROM ex) + ROW_NUMBER() OVER (ORDER BY p_partkey) AS part_key
FROM nw
"""

_LAP_TEXTS = r"""
SELECT l_orderkey, l_linenumber,
  CASE
    WHEN l_returnflag <> 'R' AND l_linenumber = 1 THEN canon
    WHEN l_returnflag <> 'R' AND l_linenumber = 2 THEN '  ' || canon || ' '
    WHEN l_returnflag <> 'R' AND l_linenumber = 3 THEN m || ':' || ss || '.' || substr(fff, 1, 1)
    WHEN l_returnflag <> 'R' AND l_linenumber = 4 THEN m || ':' || ss
    WHEN l_returnflag <> 'R' AND l_linenumber = 5 THEN CAST(ms // 1000 AS VARCHAR)
    WHEN l_returnflag <> 'R' AND l_linenumber = 6 THEN '\N'
    WHEN l_returnflag <> 'R' AND l_linenumber = 7 THEN ''
    WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN CAST(NULL AS VARCHAR)
    WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN ss || '.' || fff
    WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN m || ':'
    WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN '1:' || lpad(m, 2, '0') || ':' || ss || '.' || substr(fff, 1, 1)
    WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN canon || '0'
    WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN m || ':' || CAST(s_num + 60 AS VARCHAR) || '.' || fff
    WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN chr(9) || canon
    ELSE canon
  END AS lap_text
FROM (
  SELECT *, m || ':' || ss || '.' || fff AS canon FROM (
    SELECT l_orderkey, l_linenumber, l_returnflag, ms, s_num,
           CAST(ms // 60000 AS VARCHAR) AS m,
           lpad(CAST(s_num AS VARCHAR), 2, '0') AS ss,
           lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') AS fff
    FROM (SELECT l_orderkey, l_linenumber, l_returnflag,
                 CAST(floor(l_extendedprice) AS BIGINT) AS ms,
                 (CAST(floor(l_extendedprice) AS BIGINT) // 1000) % 60 AS s_num
          FROM lineitem) a) b) c
"""


def _lap_ms(t: str) -> str:
    return (rf"""CASE WHEN regexp_full_match(trim({t}), '(\d{{1,6}}):([0-5]\d)(\.\d{{1,3}})?') THEN """
            rf"""TRY_CAST(CAST(split_part(trim({t}), ':', 1) AS BIGINT) * 60000 """
            rf"""+ CAST(split_part(split_part(trim({t}), ':', 2), '.', 1) AS BIGINT) * 1000 """
            rf"""+ CAST(rpad(split_part(trim({t}), '.', 2), 3, '0') AS BIGINT) AS INTEGER) END""")


LAP_TIME_MS = f"""
SELECT l_orderkey, l_linenumber, lap_text,
       COALESCE({_lap_ms('lap_text')}, 0) AS qual_ms,
       {_lap_ms('lap_text')} AS fastest_ms
FROM ({_LAP_TEXTS}) t
"""

BEST_OF_THREE = f"""
SELECT l_orderkey, q1_ms, q2_ms, q3_ms,
       least(CASE WHEN q1_ms > 0 THEN q1_ms END, CASE WHEN q2_ms > 0 THEN q2_ms END,
             CASE WHEN q3_ms > 0 THEN q3_ms END) AS best_ms
FROM (
  SELECT l_orderkey,
         MIN(CASE WHEN l_linenumber = 1 THEN q END) AS q1_ms,
         MIN(CASE WHEN l_linenumber = 2 THEN q END) AS q2_ms,
         MIN(CASE WHEN l_linenumber = 3 THEN q END) AS q3_ms
  FROM (SELECT l_orderkey, l_linenumber, COALESCE({_lap_ms('lap_text')}, 0) AS q FROM ({_LAP_TEXTS}) t) x
  GROUP BY l_orderkey) y
"""

POSITIONS_GAINED = r"""
SELECT l_orderkey, l_linenumber, grid, finish_text,
       TRY_CAST(finish_text AS TINYINT) AS finish_position,
       CASE WHEN grid > 0 AND TRY_CAST(finish_text AS TINYINT) > 0
            THEN CAST(CAST(grid AS SMALLINT) - CAST(TRY_CAST(finish_text AS TINYINT) AS SMALLINT) AS SMALLINT)
       END AS positions_gained
FROM (
  SELECT l.l_orderkey, l.l_linenumber,
         CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 0 ELSE p.p_size END AS grid,
         CASE l.l_linenumber
           WHEN 4 THEN CAST(CAST(floor(l.l_quantity) AS INTEGER) * 10 AS VARCHAR)
           WHEN 5 THEN '0'
           WHEN 6 THEN '\N'
           WHEN 7 THEN 'R'
           ELSE CAST(CAST(floor(l.l_quantity) AS INTEGER) AS VARCHAR)
         END AS finish_text
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey) x
"""

TRY_CAST_SUITE = """
SELECT c_custkey,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS acct_text,
       TRY_CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(7,3)) AS bal_dec73,
       TRY_CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 10 AS VARCHAR) AS DECIMAL(7,3)) AS bal10_dec73,
       TRY_CAST(CAST(c_custkey AS VARCHAR) AS TINYINT) AS key_tiny,
       CAST(c_nationkey AS TINYINT) AS nation_tiny,
       TRY_CAST(c_mktsegment AS TINYINT) AS segment_tiny
FROM customer
"""

CLEAN_NAMES = """
SELECT c_custkey, trim(f) AS forename, trim(l) AS surname, NULLIF(code, '') AS code,
       trim(f) || ' ' || trim(l) AS full_name
FROM (
  SELECT c_custkey,
         '  ' || split_part(c_name, '#', 1) || ' ' AS f,
         CASE WHEN c_nationkey <> 0 THEN ' ' || split_part(c_name, '#', 2) || '  ' END AS l,
         CASE WHEN c_acctbal < 0 THEN '' ELSE substr(c_mktsegment, 1, 3) END AS code
  FROM customer) x
"""

LEADER_BY_DECADE = """
WITH rev AS (
  SELECT c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS yr,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS revenue
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY 1, 2),
ranked AS (SELECT *, RANK() OVER (PARTITION BY yr ORDER BY revenue DESC) AS rk FROM rev)
SELECT CAST(floor(yr / 10) * 10 AS INTEGER) AS decade, r.c_nationkey, n.n_name, COUNT(*) AS years_led
FROM ranked r LEFT JOIN nation n ON n.n_nationkey = r.c_nationkey
WHERE rk = 1
GROUP BY 1, 2, 3
"""

ENTITY_RECORDS = """
SELECT user_id,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
       CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
       CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
       CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       CAST(SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS signups,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS total_value
FROM events GROUP BY user_id
ORDER BY purchases DESC, user_id ASC
LIMIT 20
"""

_ORDER_VALUES = """
ov AS (
  SELECT o.o_orderkey, o.o_custkey, COALESCE(li.line_count, 0) AS line_count,
         CAST(COALESCE(li.order_value, 0) AS DECIMAL(38,4)) AS order_value
  FROM orders o LEFT JOIN (SELECT l_orderkey, COUNT(*) AS line_count,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
                    AS DECIMAL(18,4)) AS order_value
        FROM lineitem GROUP BY l_orderkey) li
  ON o.o_orderkey = li.l_orderkey)
"""

DEEP_DIVE = f"""
WITH {_ORDER_VALUES},
cm AS (SELECT o_custkey, CAST(CAST(SUM(order_value) AS DECIMAL(18,4)) AS DOUBLE) / COUNT(*) AS cust_mean_value
       FROM ov GROUP BY o_custkey)
SELECT ov.o_orderkey, ov.o_custkey, ov.line_count, ov.order_value, cm.cust_mean_value,
       CAST(ov.order_value AS DOUBLE) - cm.cust_mean_value AS vs_cust_mean
FROM ov LEFT JOIN cm ON cm.o_custkey IS NOT DISTINCT FROM ov.o_custkey
"""

DEEP_DIVE_BY_LINES = f"""
WITH {_ORDER_VALUES}
SELECT line_count, COUNT(*) AS orders,
       CAST(CAST(SUM(order_value) AS DECIMAL(18,4)) AS DOUBLE) / COUNT(*) AS mean_order_value
FROM ov GROUP BY line_count
"""

SHARE_OF_GROUP = """
WITH v AS (
  SELECT o.o_custkey, c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS "year",
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS cust_value
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY 1, 2, 3),
t AS (SELECT c_nationkey, "year", CAST(SUM(cust_value) AS DECIMAL(38,2)) AS nation_value FROM v GROUP BY 1, 2),
r AS (SELECT *, CAST(RANK() OVER (PARTITION BY "year" ORDER BY nation_value DESC) AS INTEGER) AS nation_rank FROM t)
SELECT v.o_custkey, v.c_nationkey, v."year", v.cust_value, r.nation_value,
       CAST(v.cust_value AS DOUBLE) / CAST(r.nation_value AS DOUBLE) AS share, r.nation_rank
FROM v LEFT JOIN r ON r.c_nationkey IS NOT DISTINCT FROM v.c_nationkey AND r."year" IS NOT DISTINCT FROM v."year"
"""

INGEST_CSV = """
SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
"""

INGEST_AUDIT = """
SELECT 1 AS run, 'region.csv' AS file_name, 'bronze_region' AS target_table, 'loaded' AS status,
       CAST(NULL AS VARCHAR) AS detail, (SELECT COUNT(*) FROM region) AS rows_loaded, 2 AS columns
UNION ALL
SELECT 1, 'nation.csv', 'bronze_nation', 'loaded', NULL, (SELECT COUNT(*) FROM nation), 3
UNION ALL
SELECT 1, 'supplier.csv', 'bronze_supplier', 'skipped', 'no file', NULL, NULL
UNION ALL
SELECT 2, 'region.csv', 'bronze_region', 'skipped', 'already loaded', NULL, NULL
UNION ALL
SELECT 2, 'nation.csv', 'bronze_nation', 'skipped', 'already loaded', NULL, NULL
UNION ALL
SELECT 2, 'supplier.csv', 'bronze_supplier', 'skipped', 'no file', NULL, NULL
"""

EXPORT_ROUNDTRIP = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"

INGEST_STREAM = "SELECT n_nationkey, n_name, n_regionkey FROM nation"

COMPOSITE_ENRICHMENT = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, COALESCE(p.kept_lines, 0) AS kept_lines, p.kept_qty
FROM lineitem l
LEFT JOIN (SELECT l_orderkey, l_suppkey, COUNT(*) AS kept_lines,
                  CAST(SUM(CAST(floor(l_quantity) AS INTEGER)) AS BIGINT) AS kept_qty
           FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2) p
ON p.l_orderkey = l.l_orderkey AND p.l_suppkey = l.l_suppkey
"""

SCD1_NO_TOUCH = ("SELECT * EXCLUDE (dw_updated_at) FROM ("
                 + _merge_sql().replace("AND c_custkey IS NOT NULL", "AND c_acctbal >= 0") + ") m")

CALENDAR_SEASON = f"""
SELECT c.* EXCLUDE (season), CAST(s.season AS SMALLINT) AS season
FROM ({CALENDAR}) c
JOIN (SELECT CAST(o_orderdate AS DATE) AS d, MIN(year(o_orderdate) - COALESCE(c_nationkey, 0) % 5) AS season
      FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1) s ON s.d = c.full_date
"""

CALENDAR_APPEND = _calendar_of(
    "SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_shipdate IS NOT NULL "
    "UNION SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL")

FULL_REFRESH = "SELECT * FROM supplier"

INGEST_DECLARED = """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal
FROM customer
"""

INGEST_FAILING = """
SELECT 'customer.csv' AS file_name, 'bronze_customer' AS target_table, 'loaded' AS status,
       CAST(NULL AS VARCHAR) AS detail, (SELECT COUNT(*) FROM customer) AS rows_loaded, 3 AS columns
UNION ALL
SELECT 'nation.csv', 'bronze_nation', 'failed', 'ValueError: columns not in the header: n_anthem', NULL, NULL
"""

SQL: dict[str, str] = {
    "composite_enrichment": COMPOSITE_ENRICHMENT,
    "scd1_no_touch": SCD1_NO_TOUCH,
    "calendar_season": CALENDAR_SEASON,
    "calendar_append": CALENDAR_APPEND,
    "full_refresh": FULL_REFRESH,
    "ingest_declared": INGEST_DECLARED,
    "ingest_failing": INGEST_FAILING,
    "ingest_stream": INGEST_STREAM,
    "ingest_csv": INGEST_CSV,
    "ingest_audit": INGEST_AUDIT,
    "export_roundtrip": EXPORT_ROUNDTRIP,
    "star_fact": STAR_FACT,
    "star_fact_required": STAR_FACT_REQUIRED,
    "star_fact_reload": STAR_FACT_RELOAD,
    "fact_quarantine": FACT_QUARANTINE,
    "child_rollup": CHILD_ROLLUP,
    "calendar": CALENDAR,
    "calendar_new_only": CALENDAR_NEW_ONLY,
    "date_normalise": DATE_NORMALISE,
    "race_style_lookup": RACE_STYLE_LOOKUP,
    "scd1_customer": SCD1_CUSTOMER,
    "scd1_changed_only": SCD1_CHANGED_ONLY,
    "scd1_idempotent": SCD1_IDEMPOTENT,
    "surrogate_keys": SURROGATE_KEYS,
    "lap_time_ms": LAP_TIME_MS,
    "best_of_three": BEST_OF_THREE,
    "positions_gained": POSITIONS_GAINED,
    "try_cast_suite": TRY_CAST_SUITE,
    "clean_names": CLEAN_NAMES,
    "leader_by_decade": LEADER_BY_DECADE,
    "entity_records": ENTITY_RECORDS,
    "deep_dive": DEEP_DIVE,
    "deep_dive_by_lines": DEEP_DIVE_BY_LINES,
    "share_of_group": SHARE_OF_GROUP,
}
