"""Column expressions shared by the queries.

Money stays an exact decimal through every sum; a result column is turned
into DOUBLE only at the end (``dsum``), and averages are computed as
``double(sum) / count`` so that every engine rounds them identically.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _one() -> Column:
    return F.lit(Decimal("1.00"))


def date(value: str | _dt.date) -> Column:
    """A DATE literal."""
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def add_months(value: str, months: int) -> Column:
    """DATE literal shifted by whole months (``date 'x' + interval 'n' month``)."""
    return F.add_months(date(value), months)


def add_days(value: str, days: int) -> Column:
    return F.date_add(date(value), days)


def in_range(column: str, lo: Column, hi: Column) -> Column:
    """Half-open range ``lo <= c < hi``: both bounds reach the scan as pushed filters."""
    c = F.col(column)
    return (c >= lo) & (c < hi)


def revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Discounted line price, exact decimal."""
    return F.col(price) * (_one() - F.col(discount))


def charge(price: str = "l_extendedprice", discount: str = "l_discount", tax: str = "l_tax") -> Column:
    return revenue(price, discount) * (_one() + F.col(tax))


def dsum(c: Column | str) -> Column:
    """Exact (decimal) sum, returned as DOUBLE."""
    return F.sum(c).cast("double")


def revenue_by(df: DataFrame, keys: list[str], alias: str = "revenue",
               price: str = "l_extendedprice", discount: str = "l_discount") -> DataFrame:
    """``sum(price * (1 - discount))`` per ``keys``, returned as DOUBLE.

    Discounts are DECIMAL(4,2): few values. Prices are summed per (keys,
    discount) first -- partial aggregation with decimal additions only -- and
    multiplied once per group; by distributivity the exact decimal sum is
    the same as over per-line products.
    """
    return (df.groupBy(*keys, discount).agg(F.sum(price).alias("_price"))
            .groupBy(*keys).agg(dsum(revenue("_price", discount)).alias(alias)))


def mean(c: Column | str) -> Column:
    """Average as ``double(sum(x)) / count(x)``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast("double") / F.count(c)


def year(c: str) -> Column:
    return F.year(F.col(c)).cast("bigint")


def dec(value) -> Column:
    """Exact decimal literal of a parameter."""
    return F.lit(Decimal(str(value)))
