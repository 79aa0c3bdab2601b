"""Independent SQL text (DuckDB dialect) for every registered query.

The oracle rebuilds the typed, completed tables from the raw tables with
CTEs that shadow them (same formulas as :mod:`dssforge.sources.tables`,
written separately), then runs the benchmark text with the same parameters.
Result columns are aliased exactly as in the DataFrame code; money results
are cast to DOUBLE at the end and averages are double(sum)/count, as there.
"""

from __future__ import annotations

# The oracle states its own lists, so that a wrong one in the engine shows.
# --- fixed values: ship modes ---
SHIP_MODES = ["REG AIR", "AIR", "RAIL", "TRUCK", "MAIL", "FOB", "SHIP"]

# --- fixed values: shipping instructions ---
SHIP_INSTRUCTIONS = ["DELIVER IN PERSON", "COLLECT COD", "TAKE BACK RETURN", "NONE"]

# --- fixed values: part containers ---
CONTAINERS = [
    "SM CASE", "SM BOX", "SM BAG", "SM JAR", "SM PACK", "SM PKG", "SM CAN", "SM DRUM",
    "LG CASE", "LG BOX", "LG BAG", "LG JAR", "LG PACK", "LG PKG", "LG CAN", "LG DRUM",
    "MED CASE", "MED BOX", "MED BAG", "MED JAR", "MED PACK", "MED PKG", "MED CAN", "MED DRUM",
    "JUMBO CASE", "JUMBO BOX", "JUMBO BAG", "JUMBO JAR", "JUMBO PACK", "JUMBO PKG", "JUMBO CAN", "JUMBO DRUM",
    "WRAP CASE", "WRAP BOX", "WRAP BAG", "WRAP JAR", "WRAP PACK", "WRAP PKG", "WRAP CAN", "WRAP DRUM",
]


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


TABLE_CTES = {
    "region": "region AS (SELECT r_regionkey, r_name FROM region)",
    "nation": "nation AS (SELECT n_nationkey, n_name, n_regionkey FROM nation)",
    "supplier": """supplier AS (SELECT s_suppkey, s_name, s_nationkey,
        CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal,
        'address of supplier ' || CAST(s_suppkey AS VARCHAR) AS s_address,
        CAST(s_nationkey + 10 AS VARCHAR) || '-' || CAST(s_suppkey % 900 + 100 AS VARCHAR) AS s_phone,
        CASE WHEN s_suppkey % 20 = 0 THEN 'Customer Complaints' ELSE 'ok' END AS s_comment
      FROM supplier)""",
    "customer": """customer AS (SELECT c_custkey, c_name, c_nationkey,
        CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
        'address of customer ' || CAST(c_custkey AS VARCHAR) AS c_address,
        CAST(c_nationkey + 10 AS VARCHAR) || '-' || CAST(c_custkey % 900 + 100 AS VARCHAR) AS c_phone,
        'none' AS c_comment
      FROM customer)""",
    "part": f"""part AS (SELECT p_partkey, p_name, p_brand, p_type, p_size,
        CAST(p_retailprice AS DECIMAL(12,2)) AS p_retailprice,
        'Manufacturer#' || CAST(p_partkey % 5 + 1 AS VARCHAR) AS p_mfgr,
        ({_list(CONTAINERS)})[p_partkey % 40 + 1] AS p_container
      FROM part)""",
    "partsupp": """partsupp AS (SELECT ps_partkey, ps_suppkey,
        CAST((ps_partkey * 37 + ps_suppkey * 101) % 50 + 1 AS INTEGER) AS ps_availqty,
        CAST(((ps_partkey * 7 + ps_suppkey * 13) % 99901 + 100) / 100 AS DECIMAL(12,2)) AS ps_supplycost,
        'none' AS ps_comment
      FROM (SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey FROM lineitem))""",
    "orders": """orders AS (SELECT o_orderkey, o_custkey, o_orderstatus,
        CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
        CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
        0 AS o_shippriority,
        CASE WHEN o_orderkey % 50 = 0 THEN 'special packages requests' ELSE 'regular' END AS o_comment
      FROM orders)""",
    "lineitem": f"""lineitem AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
        CAST(l_discount AS DECIMAL(4,2)) AS l_discount,
        CAST(l_tax AS DECIMAL(4,2)) AS l_tax,
        l_returnflag, l_linestatus,
        CAST(l_shipdate AS DATE) AS l_shipdate,
        CAST(l_shipdate AS DATE) + CAST((l_orderkey * 5 + l_partkey) % 91 - 45 AS INTEGER) AS l_commitdate,
        CAST(l_shipdate AS DATE) + CAST((l_suppkey * 11 + l_linenumber) % 30 + 1 AS INTEGER) AS l_receiptdate,
        ({_list(SHIP_MODES)})[(l_orderkey * 3 + l_linenumber) % 7 + 1] AS l_shipmode,
        ({_list(SHIP_INSTRUCTIONS)})[l_partkey % 4 + 1] AS l_shipinstruct
      FROM lineitem)""",
}

# partsupp reads the raw lineitem, so it must come before the lineitem CTE.
_CTE_ORDER = ["region", "nation", "supplier", "customer", "part", "partsupp", "orders", "lineitem"]


def with_tables(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the typed/completed table CTEs and the helpers."""
    parts = [TABLE_CTES[t] for t in _CTE_ORDER] + [HELPER_CTES] + [extra_ctes] * bool(extra_ctes)
    return f"WITH {', '.join(parts)}\nSELECT * FROM (\n{body}\n) result"


# Helpers of the statements below: sale is a line with its discounted price, place a nation with its region's name.
HELPER_CTES = """sale AS (
  SELECT *, l_extendedprice * (1 - l_discount) AS earned, CAST(year(l_shipdate) AS BIGINT) AS shipped FROM lineitem),
place AS (SELECT n.n_nationkey AS place_key, n.n_name AS place_name, r.r_name AS place_region
  FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey),
vendor AS (SELECT s.*, p.place_name AS vendor_nation, p.place_region AS vendor_region
  FROM supplier s JOIN place p ON p.place_key = s.s_nationkey),
buyer AS (SELECT c.*, p.place_name AS buyer_nation, p.place_region AS buyer_region
  FROM customer c JOIN place p ON p.place_key = c.c_nationkey)"""

QUERY_SQL = {
    "q01_pricing_summary": """
SELECT l_returnflag, l_linestatus, CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty,
  CAST(SUM(l_extendedprice) AS DOUBLE) AS sum_base_price, CAST(SUM(earned) AS DOUBLE) AS sum_disc_price,
  CAST(SUM(earned * (1 + l_tax)) AS DOUBLE) AS sum_charge,
  CAST(SUM(l_quantity) AS DOUBLE) / COUNT(l_quantity) AS avg_qty,
  CAST(SUM(l_extendedprice) AS DOUBLE) / COUNT(l_extendedprice) AS avg_price,
  CAST(SUM(l_discount) AS DOUBLE) / COUNT(l_discount) AS avg_disc, COUNT(*) AS count_order
FROM sale WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY
GROUP BY ALL ORDER BY l_returnflag, l_linestatus""",

    "q02_min_cost_supplier": """
SELECT s_acctbal, s_name, n_name, p_partkey, p_mfgr, s_address, s_phone, s_comment FROM (
  SELECT CAST(v.s_acctbal AS DOUBLE) AS s_acctbal, v.s_name, v.vendor_nation AS n_name, p.p_partkey, p.p_mfgr,
         v.s_address, v.s_phone, v.s_comment,
         dense_rank() OVER (PARTITION BY p.p_partkey ORDER BY o.ps_supplycost) AS place_in_cost
  FROM partsupp o
  JOIN part p ON p.p_partkey = o.ps_partkey AND p.p_size = 11 AND ends_with(p.p_type, 'ECONOMY')
  JOIN vendor v ON v.s_suppkey = o.ps_suppkey AND v.vendor_region = 'ASIA') ranked
WHERE place_in_cost = 1 ORDER BY s_acctbal DESC, n_name, s_name, p_partkey LIMIT 100""",

    "q03_shipping_priority": """
WITH waiting AS (
  SELECT o.o_orderkey, o.o_orderdate, o.o_shippriority FROM orders o
  JOIN buyer b ON b.c_custkey = o.o_custkey AND b.c_mktsegment = 'BUILDING'
  WHERE o.o_orderdate < DATE '1998-03-15')
SELECT w.o_orderkey AS l_orderkey, CAST(SUM(s.earned) AS DOUBLE) AS revenue, w.o_orderdate, w.o_shippriority
FROM waiting w JOIN sale s ON s.l_orderkey = w.o_orderkey AND s.l_shipdate > DATE '1998-03-15'
GROUP BY ALL ORDER BY revenue DESC, w.o_orderdate, w.o_orderkey LIMIT 10""",

    "q04_order_priority": """
WITH late AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_receiptdate > l_commitdate)
SELECT o.o_orderpriority, COUNT(*) AS order_count FROM orders o JOIN late ON late.l_orderkey = o.o_orderkey
WHERE quarter(o.o_orderdate) = 3 AND year(o.o_orderdate) = 1997 GROUP BY 1 ORDER BY 1""",

    "q05_local_supplier_volume": """
SELECT v.vendor_nation AS n_name, CAST(SUM(s.earned) AS DOUBLE) AS revenue
FROM sale s
JOIN orders o ON o.o_orderkey = s.l_orderkey AND year(o.o_orderdate) = 1996
JOIN buyer b ON b.c_custkey = o.o_custkey
JOIN vendor v ON v.s_suppkey = s.l_suppkey AND v.s_nationkey = b.c_nationkey AND v.vendor_region = 'ASIA'
GROUP BY 1 ORDER BY revenue DESC""",

    "q06_forecast_revenue": """
SELECT CAST(SUM(l_extendedprice * l_discount) AS DOUBLE) AS revenue FROM sale
WHERE shipped = 1996 AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""",

    "q07_volume_shipping": """
SELECT v.vendor_nation AS supp_nation, b.buyer_nation AS cust_nation, s.shipped AS l_year, CAST(SUM(s.earned) AS DOUBLE) AS revenue
FROM sale s JOIN vendor v ON v.s_suppkey = s.l_suppkey
JOIN orders o ON o.o_orderkey = s.l_orderkey JOIN buyer b ON b.c_custkey = o.o_custkey
WHERE s.shipped IN (1995, 1996)
  AND ((v.vendor_nation = 'NATION_3' AND b.buyer_nation = 'NATION_7')
    OR (v.vendor_nation = 'NATION_7' AND b.buyer_nation = 'NATION_3'))
GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",

    "q08_market_share": """
SELECT CAST(year(o.o_orderdate) AS BIGINT) AS o_year,
  coalesce(CAST(SUM(s.earned) FILTER (v.vendor_nation = 'NATION_1') AS DOUBLE), 0) / CAST(SUM(s.earned) AS DOUBLE) AS mkt_share
FROM sale s JOIN part p ON p.p_partkey = s.l_partkey AND p.p_type = 'ECONOMY'
JOIN orders o ON o.o_orderkey = s.l_orderkey AND year(o.o_orderdate) IN (1995, 1996)
JOIN buyer b ON b.c_custkey = o.o_custkey AND b.buyer_region = 'AMERICA'
JOIN vendor v ON v.s_suppkey = s.l_suppkey
GROUP BY 1 ORDER BY 1""",

    "q09_product_profit": """
SELECT v.vendor_nation AS nation, CAST(year(o.o_orderdate) AS BIGINT) AS o_year,
  CAST(SUM(s.earned - c.ps_supplycost * s.l_quantity) AS DOUBLE) AS sum_profit
FROM sale s JOIN part p ON p.p_partkey = s.l_partkey AND contains(p.p_name, 'blue')
JOIN partsupp c ON c.ps_partkey = s.l_partkey AND c.ps_suppkey = s.l_suppkey
JOIN vendor v ON v.s_suppkey = s.l_suppkey JOIN orders o ON o.o_orderkey = s.l_orderkey
GROUP BY 1, 2 ORDER BY 1, 2 DESC""",

    "q10_returned_items": """
WITH lost AS (
  SELECT o.o_custkey, SUM(s.earned) AS amount FROM sale s JOIN orders o ON o.o_orderkey = s.l_orderkey
  WHERE s.l_returnflag = 'R' AND year(o.o_orderdate) = 1997 AND quarter(o.o_orderdate) = 4 GROUP BY 1)
SELECT b.c_custkey, b.c_name, CAST(lost.amount AS DOUBLE) AS revenue, CAST(b.c_acctbal AS DOUBLE) AS c_acctbal,
  b.buyer_nation AS n_name, b.c_address, b.c_phone, b.c_comment
FROM lost JOIN buyer b ON b.c_custkey = lost.o_custkey ORDER BY revenue DESC, b.c_custkey LIMIT 20""",

    "q11_important_stock": """
WITH held AS (
  SELECT o.ps_partkey, SUM(o.ps_supplycost * o.ps_availqty) AS worth FROM partsupp o
  JOIN vendor v ON v.s_suppkey = o.ps_suppkey AND v.vendor_nation = 'NATION_7' GROUP BY 1)
SELECT ps_partkey, CAST(worth AS DOUBLE) AS value FROM held
WHERE worth * (SELECT COUNT(*) FROM supplier) > (SELECT SUM(worth) FROM held) * 0.1
ORDER BY value DESC, ps_partkey""",

    "q12_shipping_modes": """
SELECT s.l_shipmode, COUNT(*) FILTER (o.o_orderpriority IN ('1-URGENT', '2-HIGH')) AS high_line_count,
  COUNT(*) FILTER (o.o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS low_line_count
FROM sale s JOIN orders o ON o.o_orderkey = s.l_orderkey
WHERE s.l_shipmode IN ('MAIL', 'SHIP') AND year(s.l_receiptdate) = 1996
  AND s.l_receiptdate > s.l_commitdate AND s.l_commitdate > s.l_shipdate
GROUP BY 1 ORDER BY 1""",

    "q13_customer_distribution": """
WITH wanted AS (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE NOT regexp_matches(o_comment, 'special.*requests') GROUP BY 1)
SELECT CAST(coalesce(w.n, 0) AS BIGINT) AS c_count, COUNT(*) AS custdist
FROM customer c LEFT JOIN wanted w ON w.o_custkey = c.c_custkey
GROUP BY 1 ORDER BY 2 DESC, 1 DESC""",

    "q14_promotion_effect": """
SELECT 100.0 * coalesce(CAST(SUM(s.earned) FILTER (starts_with(p.p_type, 'PROMO')) AS DOUBLE), 0) / CAST(SUM(s.earned) AS DOUBLE) AS promo_revenue
FROM sale s JOIN part p ON p.p_partkey = s.l_partkey WHERE strftime(s.l_shipdate, '%Y-%m') = '1996-09'""",

    "q15_top_supplier": """
WITH earnings AS (
  SELECT l_suppkey, SUM(earned) AS total, rank() OVER (ORDER BY SUM(earned) DESC) AS standing
  FROM sale WHERE shipped = 1996 AND quarter(l_shipdate) = 1 GROUP BY 1)
SELECT v.s_suppkey, v.s_name, v.s_address, v.s_phone, CAST(e.total AS DOUBLE) AS total_revenue
FROM earnings e JOIN supplier v ON v.s_suppkey = e.l_suppkey WHERE e.standing = 1 ORDER BY 1""",

    "q16_parts_supplier_rel": """
WITH blamed AS (SELECT s_suppkey FROM supplier WHERE regexp_matches(s_comment, 'Customer.*Complaints'))
SELECT p.p_brand, p.p_type, p.p_size, COUNT(DISTINCT o.ps_suppkey) AS supplier_cnt
FROM part p JOIN partsupp o ON o.ps_partkey = p.p_partkey LEFT JOIN blamed x ON x.s_suppkey = o.ps_suppkey
WHERE x.s_suppkey IS NULL AND p.p_brand <> 'Brand#4' AND NOT starts_with(p.p_type, 'MEDIUM')
  AND p.p_size IN (49, 14, 23, 45, 19, 3, 36, 9)
GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3""",

    "q17_small_quantity": """
WITH usual AS (SELECT l_partkey, 0.2 * (CAST(SUM(l_quantity) AS DOUBLE) / COUNT(l_quantity)) AS fifth FROM lineitem GROUP BY 1)
SELECT CAST(SUM(s.l_extendedprice) AS DOUBLE) / 7.0 AS avg_yearly
FROM sale s JOIN usual u ON u.l_partkey = s.l_partkey AND s.l_quantity < u.fifth
JOIN part p ON p.p_partkey = s.l_partkey AND p.p_brand = 'Brand#24' AND p.p_container = 'WRAP CASE'""",

    "q18_large_orders": """
WITH filled AS (SELECT l_orderkey, SUM(l_quantity) AS pieces FROM lineitem GROUP BY 1 HAVING SUM(l_quantity) > 250)
SELECT c.c_name, c.c_custkey, o.o_orderkey, o.o_orderdate, CAST(o.o_totalprice AS DOUBLE) AS o_totalprice,
  CAST(f.pieces AS DOUBLE) AS sum_qty
FROM filled f JOIN orders o ON o.o_orderkey = f.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
ORDER BY o.o_totalprice DESC, o.o_orderdate, o.o_orderkey LIMIT 100""",

    "q19_discounted_revenue": """
WITH band (brand, boxes, low, biggest) AS (VALUES
  ('Brand#2', ['SM CASE', 'SM BOX', 'SM PACK', 'SM PKG'], 1, 5),
  ('Brand#4', ['MED BAG', 'MED BOX', 'MED PKG', 'MED PACK'], 10, 10),
  ('Brand#24', ['LG CASE', 'LG BOX', 'LG PACK', 'LG PKG'], 20, 15))
SELECT CAST(SUM(s.earned) AS DOUBLE) AS revenue
FROM sale s JOIN part p ON p.p_partkey = s.l_partkey
JOIN band b ON b.brand = p.p_brand AND list_contains(b.boxes, p.p_container)
  AND p.p_size BETWEEN 1 AND b.biggest AND s.l_quantity BETWEEN b.low AND b.low + 10
WHERE s.l_shipinstruct = 'DELIVER IN PERSON' AND s.l_shipmode IN ('AIR', 'AIR REG')""",

    "q20_part_promotion": """
WITH moved AS (SELECT l_partkey, l_suppkey, SUM(l_quantity) AS pieces FROM sale WHERE shipped = 1996 GROUP BY 1, 2),
plenty AS (
  SELECT DISTINCT o.ps_suppkey FROM partsupp o
  JOIN part p ON p.p_partkey = o.ps_partkey AND starts_with(p.p_name, 'blue')
  JOIN moved m ON m.l_partkey = o.ps_partkey AND m.l_suppkey = o.ps_suppkey AND 2 * o.ps_availqty > m.pieces)
SELECT v.s_name, v.s_address FROM vendor v JOIN plenty y ON y.ps_suppkey = v.s_suppkey
WHERE v.vendor_nation = 'NATION_9' ORDER BY 1, 2""",

    "q21_waiting_orders": """
WITH shared AS (
  SELECT l_orderkey, COUNT(DISTINCT l_suppkey) AS vendors,
         COUNT(DISTINCT CASE WHEN l_receiptdate > l_commitdate THEN l_suppkey END) AS late_vendors
  FROM lineitem GROUP BY 1)
SELECT v.s_name, COUNT(*) AS numwait
FROM sale s JOIN shared h ON h.l_orderkey = s.l_orderkey AND h.vendors > 1 AND h.late_vendors = 1
JOIN orders o ON o.o_orderkey = s.l_orderkey AND o.o_orderstatus = 'F'
JOIN vendor v ON v.s_suppkey = s.l_suppkey AND v.vendor_nation = 'NATION_6'
WHERE s.l_receiptdate > s.l_commitdate GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""",

    "q22_sales_opportunity": """
WITH called AS (
  SELECT c_custkey, c_acctbal, left(c_phone, 2) AS prefix FROM customer
  WHERE left(c_phone, 2) IN ('10', '13', '17', '21', '25', '30', '34')),
typical AS (SELECT CAST(SUM(c_acctbal) AS DOUBLE) / COUNT(c_acctbal) AS mean FROM called WHERE c_acctbal > 0)
SELECT k.prefix AS cntrycode, COUNT(*) AS numcust, CAST(SUM(k.c_acctbal) AS DOUBLE) AS totacctbal
FROM called k CROSS JOIN typical t LEFT JOIN orders o ON o.o_custkey = k.c_custkey
WHERE o.o_custkey IS NULL AND k.c_acctbal > t.mean GROUP BY 1 ORDER BY 1""",
}

Q13A_SQL = """
SELECT CAST(coalesce(w.n, 0) AS BIGINT) AS ordercount, COUNT(*) AS custdist
FROM customer c LEFT JOIN (
  SELECT o_custkey, COUNT(*) AS n FROM orders WHERE NOT regexp_matches(o_comment, 'special.*requests') GROUP BY 1) w
  ON w.o_custkey = c.c_custkey
GROUP BY 1 ORDER BY 2 DESC, 1 DESC"""

# Variants must equal their base query; the oracle of a variant is its base text.
VARIANT_BASE = {
    "q08a_decode": "q08_market_share",
    "q12a_decode": "q12_shipping_modes",
    "q14a_decode": "q14_promotion_effect",
    "q15_view": "q15_top_supplier",
    "q15a_cte": "q15_top_supplier",
}


def query_oracles() -> dict[str, str]:
    out = {k: with_tables(v) for k, v in QUERY_SQL.items()}
    for variant, base in VARIANT_BASE.items():
        out[variant] = out[base]
    out["q13a_view"] = with_tables(Q13A_SQL)
    return out
