"""DuckDB oracle SQL for the registered non-query operators."""

from __future__ import annotations

from dssforge.plans.oracle import QUERY_SQL, with_tables

# The oracle states its own lists, so that a wrong one in the engine shows.
# --- fixed values: declared primary keys ---
PRIMARY_KEYS = {
    "nation": ["n_nationkey"],
    "region": ["r_regionkey"],
    "customer": ["c_custkey"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
    "partsupp": ["ps_partkey", "ps_suppkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
}

# --- fixed values: declared foreign keys (name, child, child cols, parent, parent cols) ---
FOREIGN_KEYS = [
    ("supplier_nation_fk", "supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("partsupp_part_fk", "partsupp", ["ps_partkey"], "part", ["p_partkey"]),
    ("partsupp_supplier_fk", "partsupp", ["ps_suppkey"], "supplier", ["s_suppkey"]),
    ("customer_nation_fk", "customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("orders_customer_fk", "orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("lineitem_order_fk", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem_part_fk", "lineitem", ["l_partkey"], "part", ["p_partkey"]),
    ("lineitem_partsupp_fk", "lineitem", ["l_partkey", "l_suppkey"], "partsupp", ["ps_partkey", "ps_suppkey"]),
    ("nation_region_fk", "nation", ["n_regionkey"], "region", ["r_regionkey"]),
]

# --- fixed values: nations in key order with their region adjustments ---
NATION_ADJUSTMENTS = [
    ("ALGERIA", 0), ("ARGENTINA", 1), ("BRAZIL", 0), ("CANADA", 0), ("EGYPT", 3),
    ("ETHIOPIA", -4), ("FRANCE", 3), ("GERMANY", 0), ("INDIA", -1), ("INDONESIA", 0),
    ("IRAN", 2), ("IRAQ", 0), ("JAPAN", -2), ("JORDAN", 2), ("KENYA", -4),
    ("MOROCCO", 0), ("MOZAMBIQUE", 0), ("PERU", 1), ("CHINA", 1), ("ROMANIA", 1),
    ("SAUDI ARABIA", 1), ("VIETNAM", -2), ("RUSSIA", 1), ("UNITED KINGDOM", 0), ("UNITED STATES", -2),
]

# Columns of each typed, completed table (as the catalog exposes them).
CATALOG_COLUMNS = {
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_address", "c_phone",
                 "c_comment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "p_mfgr", "p_container"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal", "s_address", "s_phone", "s_comment"],
    "partsupp": ["ps_partkey", "ps_suppkey", "ps_availqty", "ps_supplycost", "ps_comment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
               "o_shippriority", "o_comment"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_commitdate",
                 "l_receiptdate", "l_shipmode", "l_shipinstruct"],
}

ORDERS_RESULT = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
  o_orderdate, o_orderpriority, o_shippriority, o_comment FROM orders"""
LINES_RESULT = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
  CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, CAST(l_discount AS DOUBLE) AS l_discount,
  CAST(l_tax AS DOUBLE) AS l_tax, l_returnflag, l_linestatus, l_shipdate, l_commitdate, l_receiptdate,
  l_shipinstruct, l_shipmode FROM lineitem"""


def _counts(rule: str, source: str, ok: str) -> str:
    return f"""SELECT '{rule}' AS rule, COUNT(*) AS checked, COUNT(CASE WHEN {ok} THEN 1 END) AS agree,
  COUNT(*) - COUNT(CASE WHEN {ok} THEN 1 END) AS disagree FROM {source}"""


def _pk_sql() -> str:
    parts = []
    for table, keys in PRIMARY_KEYS.items():
        has_null = " OR ".join(f"{k} IS NULL" for k in keys)
        parts.append(f"""SELECT '{table}' AS table_name,
  CAST(COALESCE(SUM(CASE WHEN has_null THEN n END), 0) AS BIGINT) AS null_key_rows,
  COUNT(CASE WHEN NOT has_null AND n > 1 THEN 1 END) AS duplicate_keys,
  CAST(COALESCE(SUM(CASE WHEN NOT has_null AND n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT ({has_null}) AS has_null, COUNT(*) AS n FROM {table} GROUP BY {', '.join(keys)}) g""")
    return "\nUNION ALL\n".join(parts)


def _fk_sql() -> str:
    parts = []
    for name, child, ccols, parent, pcols in FOREIGN_KEYS:
        notnull = " AND ".join(f"x.{k} IS NOT NULL" for k in ccols)
        match = " AND ".join(f"p.{p} = x.{k}" for k, p in zip(ccols, pcols))
        parts.append(f"""SELECT '{name}' AS constraint_name, '{child}' AS child_table, '{parent}' AS parent_table,
  COUNT(*) AS orphan_rows
FROM {child} x WHERE {notnull} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match})""")
    return "\nUNION ALL\n".join(parts)


def _not_null_sql() -> str:
    parts = []
    for table in PRIMARY_KEYS:
        for col in CATALOG_COLUMNS[table]:
            parts.append(f"SELECT '{table}' AS table_name, '{col}' AS column_name, "
                         f"CAST(COUNT(*) - COUNT({col}) AS BIGINT) AS null_rows FROM {table}")
    return "\nUNION ALL\n".join(parts)


_NATION_VALUES = ", ".join(f"({i}, '{n}', {a})" for i, (n, a) in enumerate(NATION_ADJUSTMENTS))

RULE_SQL = {
    "rule_retail_price": _counts(
        "retail_price", "part",
        "CAST(p_retailprice * 100 AS BIGINT) = 90000 + (p_partkey // 10) % 20001 + (p_partkey % 1000) * 100"),
    "rule_supplier_bridge": """
WITH built AS (
  SELECT DISTINCT p_partkey AS b_partkey,
         (p_partkey + t.i * (s.n // 4 + (p_partkey - 1) // s.n)) % s.n + 1 AS b_suppkey
  FROM part, (SELECT COUNT(*) AS n FROM supplier) s, range(0, 4) t(i))
SELECT 'supplier_bridge' AS rule, COUNT(*) AS checked, COUNT(b_partkey) AS agree, COUNT(*) - COUNT(b_partkey) AS disagree
FROM partsupp LEFT JOIN built ON ps_partkey = b_partkey AND ps_suppkey = b_suppkey
UNION ALL
SELECT 'supplier_bridge_complete', COUNT(*), COUNT(k), COUNT(*) - COUNT(k)
FROM built LEFT JOIN (SELECT DISTINCT ps_partkey AS k, ps_suppkey AS s FROM partsupp) p ON b_partkey = k AND b_suppkey = s""",
    "rule_extended_price": _counts(
        "extended_price", "lineitem LEFT JOIN part ON l_partkey = p_partkey",
        "l_extendedprice = p_retailprice * l_quantity"),
    "rule_order_total": _counts(
        "order_total",
        """orders LEFT JOIN (SELECT l_orderkey, SUM(((e * (100 - d)) // 100 * (100 + t)) // 100) AS total_cents
          FROM (SELECT l_orderkey, CAST(l_extendedprice * 100 AS BIGINT) AS e, CAST(l_discount * 100 AS BIGINT) AS d,
                       CAST(l_tax * 100 AS BIGINT) AS t FROM lineitem) x GROUP BY l_orderkey) lt
          ON o_orderkey = lt.l_orderkey""",
        "CAST(o_totalprice * 100 AS BIGINT) = total_cents"),
    "rule_order_status": _counts(
        "order_status",
        """orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n, COUNT(CASE WHEN l_linestatus = 'F' THEN 1 END) AS nf
          FROM lineitem GROUP BY l_orderkey) lt ON o_orderkey = lt.l_orderkey""",
        "o_orderstatus = CASE WHEN nf = n THEN 'F' WHEN nf = 0 THEN 'O' ELSE 'P' END"),
    "rule_line_flags": _counts(
        "line_status", "lineitem",
        "l_linestatus = CASE WHEN l_shipdate <= DATE '1995-06-17' THEN 'F' ELSE 'O' END")
    + "\nUNION ALL\n" + _counts(
        "return_flag", "lineitem",
        "(CASE WHEN l_receiptdate <= DATE '1995-06-17' THEN l_returnflag IN ('R', 'A') ELSE l_returnflag = 'N' END)"),
    "rule_customer_gap": _counts("customer_gap", "orders", "o_custkey % 3 <> 0"),
    "rule_sparse_order_key": _counts("sparse_order_key", "orders", "((o_orderkey >> 3) & 3) = 0"),
    "rule_phone_country": _counts(
        "customer_phone_country", "customer",
        "substring(c_phone, 1, 2) = lpad(CAST(c_nationkey + 10 AS VARCHAR), 2, '0')")
    + "\nUNION ALL\n" + _counts(
        "supplier_phone_country", "supplier",
        "substring(s_phone, 1, 2) = lpad(CAST(s_nationkey + 10 AS VARCHAR), 2, '0')"),
    "rule_supplier_flag": _counts("complaint", "supplier", "regexp_matches(s_comment, 'Customer.*Complaints')")
    + "\nUNION ALL\n" + _counts("commendation", "supplier", "regexp_matches(s_comment, 'Customer.*Recommends')"),
    "nation_region_map": f"""
SELECT n_nationkey, n_name, n_regionkey, m_name AS listed_name, m_regionkey AS listed_regionkey,
       (n_regionkey = m_regionkey) AS region_agrees
FROM nation LEFT JOIN (
  SELECT m_nationkey, m_name,
         CAST(SUM(adjustment) OVER (ORDER BY m_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS INTEGER) AS m_regionkey
  FROM (VALUES {_NATION_VALUES}) v(m_nationkey, m_name, adjustment)) m
ON n_nationkey = m_nationkey""",
    "calendar_dim": """
SELECT CAST(d - DATE '1970-01-01' + 1 AS BIGINT) AS date_key, strftime(d, '%Y-%m-%d') AS date_text,
       CAST(year(d) AS BIGINT) AS year, CAST((year(d) - 1970) * 12 + month(d) AS BIGINT) AS month,
       CAST((dayofyear(d) + 3 - 1) // 7 + 1 AS BIGINT) AS week, CAST(day(d) AS BIGINT) AS day
FROM (SELECT CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT MIN(o_orderdate) AS d0 FROM orders), (SELECT MAX(l_receiptdate) AS d1 FROM lineitem))""",
}

EVENTS_LOG = """log AS (SELECT CAST(event_id AS BIGINT) AS id,
    CAST(user_id % 10 + 1 AS VARCHAR) || '.' || event_type AS description,
    CAST(user_id % 3 AS BIGINT) AS tuples,
    CAST(round(value * 1000) AS BIGINT) AS duration_ms
  FROM events)"""


def _log(body: str) -> str:
    return with_tables(body, EVENTS_LOG)


_SESSIONS = ",\n  ".join(
    f"CAST(COALESCE(SUM(CASE WHEN split_part(description, '.', 1) = '{k}' THEN duration_ms END), 0) AS DOUBLE)"
    f" / 1000.0 AS session_{k}" for k in range(1, 11)) + """,
  CAST(COALESCE(SUM(CASE WHEN CAST(split_part(description, '.', 1) AS INTEGER) NOT BETWEEN 1 AND 10 THEN duration_ms END), 0) AS DOUBLE)
    / 1000.0 AS session_other"""

REPORT_SQL = {
    "runlog_load": _log("SELECT id, description, tuples, duration_ms FROM log"),
    "report_queries": _log("""SELECT split_part(description, '.', 2) AS id, MAX(tuples) AS tuples,
  CAST(MIN(duration_ms) AS DOUBLE) / 1000.0 AS duration FROM log GROUP BY 1 ORDER BY 1"""),
    "report_loads": _log("""SELECT split_part(description, '.', 2) AS table_name, CAST(SUM(tuples) AS BIGINT) AS tuples,
  CAST(SUM(duration_ms) AS DOUBLE) / 1000.0 AS duration FROM log WHERE tuples > 0 GROUP BY 1 ORDER BY 1"""),
    "report_analyze": _log("""SELECT description, CAST(duration_ms AS DOUBLE) / 1000.0 AS seconds
  FROM log WHERE tuples = 0 ORDER BY 1, 2"""),
    "report_gen_data": _log("""SELECT 'Seconds' AS time, s AS value FROM (SELECT CAST(SUM(duration_ms) AS DOUBLE) / 1000.0 AS s FROM log)
UNION ALL SELECT 'Minutes', s / 60 FROM (SELECT CAST(SUM(duration_ms) AS DOUBLE) / 1000.0 AS s FROM log)
UNION ALL SELECT 'Hours', s / 3600 FROM (SELECT CAST(SUM(duration_ms) AS DOUBLE) / 1000.0 AS s FROM log)"""),
    "report_sessions": _log(f"""SELECT split_part(description, '.', 2) AS query_id,
  {_SESSIONS}
FROM log GROUP BY 1 ORDER BY 1"""),
}

_Q01 = QUERY_SQL["q01_pricing_summary"].replace("ORDER BY l_returnflag, l_linestatus", "")
_Q01_COLS = [("l_returnflag", "str"), ("l_linestatus", "str"), ("sum_qty", "sum"), ("sum_base_price", "sum"),
             ("sum_disc_price", "sum"), ("sum_charge", "sum"), ("avg_qty", "avg"), ("avg_price", "avg"),
             ("avg_disc", "avg"), ("count_order", "cnt")]


def _mismatch_sql(col: str, cls: str) -> str:
    a, b = f"a.{col}", f"b.{col}"
    if cls == "str":
        return f"rtrim(CAST({a} AS VARCHAR)) IS DISTINCT FROM rtrim(CAST({b} AS VARCHAR))"
    if cls in ("cnt", "int"):
        return f"{a} IS DISTINCT FROM {b}"
    ra, rb = f"round(CAST({a} AS DOUBLE), 2)", f"round(CAST({b} AS DOUBLE), 2)"
    diff = f"abs({ra} - {rb})"
    if cls == "num":
        return f"{ra} IS DISTINCT FROM {rb}"
    if cls == "sum":
        return f"COALESCE({diff} > 100, TRUE)"
    if cls == "avg":
        return f"COALESCE(CASE WHEN {ra} = 0 THEN {diff} > 1 ELSE {diff} / abs({ra}) * 100 > 1 END, TRUE)"
    return f"COALESCE({diff} > 1, TRUE)"


def _result_diff_sql() -> str:
    q90 = _Q01.replace("INTERVAL 90 DAY", "INTERVAL 90 DAY")
    q120 = _Q01.replace("INTERVAL 90 DAY", "INTERVAL 120 DAY")
    ctes = (f"qa AS ({q90}),\nqb AS ({q120}),\n"
            "a AS (SELECT *, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS rn FROM qa),\n"
            "b AS (SELECT *, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS rn FROM qb)")
    parts = [f"""SELECT '{col}' AS column_name, '{cls}' AS column_class, COUNT(*) AS rows_compared,
  COUNT(CASE WHEN a.rn IS NULL OR b.rn IS NULL OR {_mismatch_sql(col, cls)} THEN 1 END) AS mismatches
FROM a FULL OUTER JOIN b ON a.rn = b.rn""" for col, cls in _Q01_COLS]
    return with_tables("\nUNION ALL\n".join(parts), ctes)


def _orders_minus_deleted(extra: str = "") -> str:
    return f"""{ORDERS_RESULT} o WHERE {extra}NOT EXISTS (
  SELECT 1 FROM orders d WHERE d.o_orderdate < DATE '1996-01-01' AND d.o_orderkey = o.o_orderkey)"""


def _stats_sql() -> str:
    """Statistics of three lineitem columns as one scan gives them; a bound is the cell in which a quarter is reached."""
    columns = [("l_quantity", "CAST(l_quantity AS DOUBLE)", 1), ("l_extendedprice", "CAST(l_extendedprice AS DOUBLE)", 1000),
               ("l_shipdate", "CAST(l_shipdate - DATE '1970-01-01' AS DOUBLE)", 1)]
    parts = []
    for name, value, width in columns:
        cells = f"""(SELECT cell, SUM(n) OVER (ORDER BY cell) AS upto, SUM(n) OVER () AS total
   FROM (SELECT floor({value} / {width}) AS cell, COUNT(*) AS n FROM lineitem WHERE {value} IS NOT NULL GROUP BY 1) g)"""
        bounds = ", ".join(f"(SELECT MIN(cell) * {width} FROM {cells} r WHERE upto * 4 >= total * {k}) AS bound_{k}" for k in (1, 2, 3))
        parts.append(f"""SELECT '{name}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT(v) AS null_count,
  MIN(v) AS min_value, MAX(v) AS max_value, {bounds} FROM (SELECT {value} AS v FROM lineitem) x""")
    return "\nUNION ALL\n".join(parts)


IO_SQL = {
    "load_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS tuples FROM {t}"
        for t in ["region", "nation", "supplier", "customer", "part", "partsupp", "orders", "lineitem"]),
    "load_tables": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS tuples FROM {t}"
        for t in ["region", "nation", "supplier", "customer", "part", "partsupp", "orders", "lineitem"]),
    "load_delimited": LINES_RESULT,
    "load_csv_nodummy": ORDERS_RESULT,
    "load_copy": """SELECT c_custkey, c_name, c_address, c_nationkey, c_phone, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
  c_mktsegment, c_comment FROM customer""",
    "write_delimited": """SELECT 'nation' AS table_name,
  concat_ws('|', n_nationkey, n_name, n_regionkey, '') || '|' AS line FROM nation
UNION ALL SELECT 'part', concat_ws('|', p_partkey, p_name, p_mfgr, p_brand, p_type, p_size, p_container, p_retailprice, '') || '|'
FROM part""",
    "table_from_query": f"({QUERY_SQL['q10_returned_items']})\nUNION ALL\n({QUERY_SQL['q10_returned_items']})",
    "write_table": f"({QUERY_SQL['q05_local_supplier_volume'].replace('ORDER BY revenue DESC', '')})\nUNION ALL\n"
                   f"({QUERY_SQL['q05_local_supplier_volume'].replace('ORDER BY revenue DESC', '')})",
    "layout_year_partition": f"{LINES_RESULT} WHERE year(l_shipdate) = 1997",
    "layout_hash": """SELECT o_orderpriority, COUNT(*) AS line_count, CAST(SUM(l_quantity) AS DOUBLE) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
    "layout_minmax": f"{LINES_RESULT} WHERE l_shipdate >= DATE '1997-03-01' AND l_shipdate < DATE '1997-04-01'",
    "compact": ORDERS_RESULT,
    "stats": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST(MIN({k[0]}) AS BIGINT) AS key_min, "
        f"CAST(MAX({k[0]}) AS BIGINT) AS key_max, COUNT(*) - COUNT({k[0]}) AS key_nulls FROM {t}"
        for t, k in PRIMARY_KEYS.items()),
    "layout_random": ORDERS_RESULT,
    "layout_compress": ORDERS_RESULT,
    "recreate_schema": ORDERS_RESULT,
    "layout_interleaved": f"""{LINES_RESULT} WHERE l_quantity <= 10 AND l_shipdate >= DATE '1996-01-01'
  AND l_receiptdate < DATE '1996-03-01' AND l_shipmode <> 'RAIL'""",
    "layout_sorted": """SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS unsorted_rows, CAST(0 AS BIGINT) AS overlapping_files,
  MIN(l_shipdate) AS first_key, MAX(l_shipdate) AS last_key FROM lineitem""",
    "load_counts_by_file": "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS table_name, CASE WHEN year({d}) BETWEEN 1992 AND 1998 THEN CAST(year({d}) AS VARCHAR) ELSE 'others' END AS year,
  COUNT(*) AS tuples FROM {t} GROUP BY 1, 2""" for t, d in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))),
    "plan_statistics": f"""
SELECT 'q09' AS query, t AS part, n AS rows_out FROM (
  SELECT 'lineitem' AS t, COUNT(*) AS n FROM lineitem UNION ALL SELECT 'orders', COUNT(*) FROM orders
  UNION ALL SELECT 'part', COUNT(*) FROM part UNION ALL SELECT 'partsupp', COUNT(*) FROM partsupp
  UNION ALL SELECT 'supplier', COUNT(*) FROM supplier UNION ALL SELECT 'nation', COUNT(*) FROM nation) x
UNION ALL
SELECT 'q09', 'last join', COUNT(*) FROM lineitem JOIN part ON p_partkey = l_partkey AND contains(p_name, 'blue')
  JOIN partsupp ON ps_partkey = l_partkey AND ps_suppkey = l_suppkey
  JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
UNION ALL
SELECT 'q18', t, n FROM (
  SELECT 'lineitem' AS t, COUNT(*) AS n FROM lineitem UNION ALL SELECT 'orders', COUNT(*) FROM orders
  UNION ALL SELECT 'customer', COUNT(*) FROM customer) x
UNION ALL
SELECT 'q18', 'last join', COUNT(*) FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING SUM(l_quantity) > 250)""",
    "stats_by_partition": _stats_sql(),
    "order_key_islands": """
WITH keys AS (SELECT CAST((o_orderkey >> 3) & 3 AS BIGINT) AS seq, ((o_orderkey >> 5) << 3) + (o_orderkey & 7) AS i FROM orders),
counted AS (SELECT seq, i, COUNT(*) AS n FROM keys GROUP BY seq, i),
present AS (SELECT seq, MIN(i) AS first_index, MAX(i) AS last_index, SUM(n) AS n_rows
  FROM (SELECT *, i - row_number() OVER (PARTITION BY seq ORDER BY i) AS run FROM counted) x GROUP BY seq, run),
doubled AS (SELECT seq, MIN(i) AS first_index, MAX(i) AS last_index, SUM(n) AS n_rows
  FROM (SELECT *, i - row_number() OVER (PARTITION BY seq ORDER BY i) AS run FROM counted WHERE n > 1) x GROUP BY seq, run)
SELECT seq, 'present' AS kind, CAST(first_index AS BIGINT) AS first_index, CAST(last_index AS BIGINT) AS last_index, CAST(n_rows AS BIGINT) AS n_rows FROM present
UNION ALL SELECT seq, 'doubled', CAST(first_index AS BIGINT), CAST(last_index AS BIGINT), CAST(n_rows AS BIGINT) FROM doubled
UNION ALL SELECT seq, 'missing', CAST(last_index + 1 AS BIGINT), CAST(following - 1 AS BIGINT), CAST(0 AS BIGINT)
FROM (SELECT *, lead(first_index) OVER (PARTITION BY seq ORDER BY first_index) AS following FROM present) x WHERE following IS NOT NULL""",
    "refresh_insert": ORDERS_RESULT,
    "refresh_insert_lines": LINES_RESULT,
    "refresh_delete_orders": _orders_minus_deleted(),
    "refresh_apply_lines": f"""{LINES_RESULT} l WHERE NOT EXISTS (
  SELECT 1 FROM orders d WHERE d.o_orderdate < DATE '1996-01-01' AND d.o_orderkey = l.l_orderkey)""",
    "refresh_delete": f"""{LINES_RESULT} l WHERE NOT EXISTS (
  SELECT 1 FROM orders d WHERE d.o_orderdate < DATE '1996-01-01' AND d.o_orderkey = l.l_orderkey)""",
    "refresh_apply": _orders_minus_deleted("(NOT (o_orderdate >= DATE '1999-01-01') OR o_orderdate IS NULL) AND ")
    + f"\nUNION ALL\n{ORDERS_RESULT} WHERE o_orderdate >= DATE '1999-01-01'",
    "refresh_key_sets": """
WITH sets AS (
  SELECT 1 AS no, 'base' AS name, o_orderkey AS k FROM orders WHERE NOT (o_orderdate >= DATE '1999-01-01') OR o_orderdate IS NULL
  UNION ALL SELECT 2, 'insert', o_orderkey FROM orders WHERE o_orderdate >= DATE '1999-01-01'
  UNION ALL SELECT 3, 'delete', o_orderkey FROM orders WHERE o_orderdate < DATE '1996-01-01'),
names(no, name) AS (VALUES (1, 'base'), (2, 'insert'), (3, 'delete')),
common AS (SELECT a.no AS x, b.no AS y, COUNT(DISTINCT a.k) AS n FROM sets a JOIN sets b ON a.k = b.k AND a.no <= b.no GROUP BY 1, 2)
SELECT l.name AS left_set, r.name AS right_set, COALESCE(n, 0) AS common_keys
FROM names l JOIN names r ON l.no <= r.no LEFT JOIN common ON x = l.no AND y = r.no""",
    "w_row_number": """SELECT c_custkey, c_name, c_nationkey,
  CAST(row_number() OVER (ORDER BY c_name, c_custkey, c_nationkey) AS BIGINT) AS row_number FROM customer""",
    "w_rank": """SELECT s_suppkey, s_name, s_nationkey,
  CAST(rank() OVER (PARTITION BY s_nationkey ORDER BY s_name) AS BIGINT) AS name_rank FROM supplier""",
}

# Other ways to the same state.
IO_SQL.update({"refresh_stream": IO_SQL["refresh_apply"], "refresh_stream_lines": IO_SQL["refresh_apply_lines"],
               "refresh_partitioned": IO_SQL["refresh_apply"], "refresh_partitioned_lines": IO_SQL["refresh_apply_lines"]})


def operator_oracles() -> dict[str, str]:
    out = {
        "layout_bucketed": with_tables(QUERY_SQL["q18_large_orders"]),
        "pk_violations": with_tables(_pk_sql()),
        "fk_orphans": with_tables(_fk_sql()),
        "not_null": with_tables(_not_null_sql()),
        "result_diff": _result_diff_sql(),
    }
    out.update({k: with_tables(v) for k, v in RULE_SQL.items()})
    out.update({k: with_tables(v) for k, v in IO_SQL.items()})
    out.update(REPORT_SQL)
    return out
