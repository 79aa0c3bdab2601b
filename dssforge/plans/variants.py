"""Query variants in SQL text: ``decode`` forms, a named view, a CTE form.

Each variant must return what its base query returns. They run through
``spark.sql`` with named parameters; the typed tables are bound to the
``{table}`` placeholders as DataFrames (Spark registers them under generated
names and drops them afterwards), so no temp view of the caller is touched
and Catalyst plans them exactly as it plans the DataFrame forms.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame

from dssforge.sources.tables import TABLE_NAMES, Catalog

Q08A = """
WITH sold AS (
  SELECT o.o_orderdate, li.l_suppkey, li.l_extendedprice * (1 - li.l_discount) AS earned
  FROM {lineitem} li
  LEFT SEMI JOIN {part} p ON p.p_partkey = li.l_partkey AND p.p_type = :ptype
  JOIN {orders} o ON o.o_orderkey = li.l_orderkey AND o.o_orderdate >= DATE '1995-01-01' AND o.o_orderdate < DATE '1997-01-01'
  JOIN {customer} c ON c.c_custkey = o.o_custkey
  JOIN {nation} home ON home.n_nationkey = c.c_nationkey
  JOIN {region} r ON r.r_regionkey = home.n_regionkey AND r.r_name = :region)
SELECT CAST(year(sold.o_orderdate) AS BIGINT) AS o_year,
       CAST(SUM(decode(n.n_name, :nation, sold.earned, 0)) AS DOUBLE) / CAST(SUM(sold.earned) AS DOUBLE) AS mkt_share
FROM sold JOIN {supplier} s ON s.s_suppkey = sold.l_suppkey JOIN {nation} n ON n.n_nationkey = s.s_nationkey
GROUP BY 1 ORDER BY 1"""

Q12A = """
WITH late AS (
  SELECT l_orderkey, l_shipmode FROM {lineitem}
  WHERE l_shipmode IN (:mode1, :mode2) AND l_receiptdate >= :day AND l_receiptdate < :day + INTERVAL '1' YEAR
    AND l_commitdate < l_receiptdate AND l_shipdate < l_commitdate),
rated AS (
  SELECT late.l_shipmode, decode(o.o_orderpriority, '1-URGENT', 1, '2-HIGH', 1, 0) AS high
  FROM late JOIN {orders} o ON o.o_orderkey = late.l_orderkey)
SELECT l_shipmode, CAST(SUM(high) AS BIGINT) AS high_line_count, CAST(SUM(1 - high) AS BIGINT) AS low_line_count
FROM rated GROUP BY l_shipmode ORDER BY l_shipmode"""

Q13A_VIEW = """
SELECT c.c_custkey AS custkey, COUNT(o.o_orderkey) AS ordercount
FROM {customer} c LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey AND o.o_comment NOT LIKE :pattern
GROUP BY c.c_custkey"""

Q13A = """
SELECT v.ordercount, COUNT(*) AS custdist FROM {view} v GROUP BY v.ordercount ORDER BY 2 DESC, 1 DESC"""

Q14A = """
WITH month_sales AS (
  SELECT decode(substring(p.p_type FROM 1 FOR 5), 'PROMO', 1, 0) AS promoted, li.l_extendedprice * (1 - li.l_discount) AS earned
  FROM {lineitem} li JOIN {part} p ON p.p_partkey = li.l_partkey
  WHERE li.l_shipdate >= :day AND li.l_shipdate < :day + INTERVAL '1' MONTH)
SELECT 100.0 * CAST(SUM(decode(promoted, 1, earned, 0)) AS DOUBLE) / CAST(SUM(earned) AS DOUBLE) AS promo_revenue
FROM month_sales"""

Q15_VIEW = """
SELECT li.l_suppkey AS supplier_no, SUM(li.l_extendedprice * (1 - li.l_discount)) AS total_revenue
FROM {lineitem} li WHERE li.l_shipdate >= :day AND li.l_shipdate < :day + INTERVAL '3' MONTH
GROUP BY li.l_suppkey"""

Q15_BODY = """
SELECT s.s_suppkey, s.s_name, s.s_address, s.s_phone, CAST(v.total_revenue AS DOUBLE) AS total_revenue
FROM {view} v JOIN {supplier} s ON s.s_suppkey = v.supplier_no
WHERE v.total_revenue = (SELECT MAX(total_revenue) FROM {view})
ORDER BY s.s_suppkey"""

Q15A = """
WITH earnings (supplier_no, total) AS (
  SELECT li.l_suppkey, SUM(li.l_extendedprice * (1 - li.l_discount)) FROM {lineitem} li
  WHERE li.l_shipdate >= :day AND li.l_shipdate < :day + INTERVAL '3' MONTH GROUP BY li.l_suppkey)
SELECT s.s_suppkey, s.s_name, s.s_address, s.s_phone, CAST(e.total AS DOUBLE) AS total_revenue
FROM earnings e JOIN {supplier} s ON s.s_suppkey = e.supplier_no
WHERE e.total = (SELECT MAX(total) FROM earnings)
ORDER BY s.s_suppkey"""


def _day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _frames(cat: Catalog, text: str) -> dict:
    """The tables that the text names."""
    return {t: cat.table(t) for t in TABLE_NAMES if f"{{{t}}}" in text}


def _sql(cat: Catalog, text: str, **args) -> DataFrame:
    return cat.spark.sql(text, args=args, **_frames(cat, text))


def q08a_decode(cat: Catalog, nation="NATION_1", region="AMERICA", ptype="ECONOMY") -> DataFrame:
    return _sql(cat, Q08A, nation=nation, region=region, ptype=ptype)


def q12a_decode(cat: Catalog, mode1="MAIL", mode2="SHIP", day="1996-01-01") -> DataFrame:
    return _sql(cat, Q12A, mode1=mode1, mode2=mode2, day=_day(day))


def _with_view(cat: Catalog, view_sql: str, body: str, name: str, **args) -> DataFrame:
    """Create a named view, plan the query over it, drop the view.

    The view is the parametrised SELECT registered under a unique name
    (parameter markers are not allowed inside CREATE VIEW text). The analyzed
    plan keeps the view's definition, so the returned DataFrame stays valid
    after the drop.
    """
    view = f"{name}_{uuid.uuid4().hex[:12]}"
    cat.spark.sql(view_sql, args=args, **_frames(cat, view_sql)).createOrReplaceTempView(view)
    try:
        return cat.spark.sql(body.replace("{view}", view), **_frames(cat, body))
    finally:
        cat.spark.catalog.dropTempView(view)


def q13a_view(cat: Catalog, word1="special", word2="requests") -> DataFrame:
    return _with_view(cat, Q13A_VIEW, Q13A, "orders_per_cust", pattern=f"%{word1}%{word2}%")


def q14a_decode(cat: Catalog, day="1996-09-01") -> DataFrame:
    return _sql(cat, Q14A, day=_day(day))


def q15_view(cat: Catalog, day="1996-01-01") -> DataFrame:
    return _with_view(cat, Q15_VIEW, Q15_BODY, "revenue0", day=_day(day))


def q15a_cte(cat: Catalog, day="1996-01-01") -> DataFrame:
    return _sql(cat, Q15A, day=_day(day))


VARIANTS = {
    "q08a_decode": q08a_decode,
    "q12a_decode": q12a_decode,
    "q13a_view": q13a_view,
    "q14a_decode": q14a_decode,
    "q15_view": q15_view,
    "q15a_cte": q15a_cte,
}
