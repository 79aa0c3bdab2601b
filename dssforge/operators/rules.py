"""Business rules of the benchmark's row builder, checked as relations.

The row builder ties columns and tables together (price from part key,
supplier bridge, order total and status from the lines, line flags from
dates, customers without orders, sparse order keys, phone prefixes,
supplier comment phrases). Each rule here is a Spark job over whole tables
that counts rows agreeing and disagreeing with it; every result has the
columns ``rule, checked, agree, disagree``.

Per-order rules aggregate lineitem by order key with partial aggregation
before the shuffle and then meet orders in one equi-join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dssforge.operators.windows import distributed_rank
from dssforge.sources.tables import Catalog, union_all

c = F.col

# --- fixed values: builder constants ---
CURRENT_DATE = dt.date(1995, 6, 17)
SUPP_PER_PART = 4
CUST_MORTALITY = 3
SPARSE_BITS = 2
SPARSE_KEEP = 3
COMPLAINT_PATTERN = "Customer.*Complaints"
COMMENDATION_PATTERN = "Customer.*Recommends"

# --- fixed values: nations in key order with their region adjustments ---
NATION_ADJUSTMENTS = [
    ("ALGERIA", 0), ("ARGENTINA", 1), ("BRAZIL", 0), ("CANADA", 0), ("EGYPT", 3),
    ("ETHIOPIA", -4), ("FRANCE", 3), ("GERMANY", 0), ("INDIA", -1), ("INDONESIA", 0),
    ("IRAN", 2), ("IRAQ", 0), ("JAPAN", -2), ("JORDAN", 2), ("KENYA", -4),
    ("MOROCCO", 0), ("MOZAMBIQUE", 0), ("PERU", 1), ("CHINA", 1), ("ROMANIA", 1),
    ("SAUDI ARABIA", 1), ("VIETNAM", -2), ("RUSSIA", 1), ("UNITED KINGDOM", 0), ("UNITED STATES", -2),
]


def _counts(rule: str, df: DataFrame, ok: Column) -> DataFrame:
    """rule, checked, agree, disagree over the rows of ``df``."""
    return df.agg(F.count(F.lit(1)).alias("checked"),
                  F.count(F.when(ok, 1)).alias("agree")) \
        .select(F.lit(rule).alias("rule"), "checked", "agree", (c("checked") - c("agree")).alias("disagree"))


def cents(col: str) -> Column:
    """Exact money value in integer cents."""
    return (c(col) * 100).cast("bigint")


def rule_retail_price(cat: Catalog) -> DataFrame:
    """Retail price in cents = 90000 + (p div 10) % 20001 + (p % 1000) * 100."""
    part = cat.part.select("p_partkey", "p_retailprice")
    expected = F.expr("90000 + (p_partkey div 10) % 20001 + (p_partkey % 1000) * 100")
    return _counts("retail_price", part, cents("p_retailprice") == expected)


def bridge_suppliers(cat: Catalog) -> DataFrame:
    """The SUPP_PER_PART bridge suppliers of every part: (b_partkey, b_suppkey).

    ``(p + i * (S / 4 + (p - 1) / S)) % S + 1`` for i in 0..3, with S the
    supplier count (a scalar subquery) and integer division.
    """
    n_supp = cat.supplier.agg(F.count(F.lit(1))).scalar()
    p = c("p_partkey")
    # integer divisions truncating toward zero (operands are far below 2**53)
    spread = (n_supp / SUPP_PER_PART).cast("bigint") + ((p - 1) / n_supp).cast("bigint")
    return (cat.part.select(p, F.explode(F.sequence(F.lit(0), F.lit(SUPP_PER_PART - 1))).alias("i"))
            .select(p.alias("b_partkey"), ((p + c("i") * spread) % n_supp + 1).alias("b_suppkey")))


def rule_supplier_bridge(cat: Catalog) -> DataFrame:
    """partsupp pairs that are bridge pairs of their part, and bridge pairs that partsupp holds.

    One full outer meeting of the two pair sets: pairs of either side are counted per key (partial
    aggregation), so a gap on each side shows.
    """
    def side(df, stored):
        part, supp = df.columns
        return df.select(c(part).alias("part"), c(supp).alias("supp"), F.lit(stored).alias("stored"), F.lit(1 - stored).alias("built"))

    stored = side(cat.partsupp.select("ps_partkey", "ps_suppkey"), 1)
    built = side(bridge_suppliers(cat).distinct(), 0)
    pairs = stored.unionByName(built).groupBy("part", "supp").agg(F.sum("stored").alias("stored"), F.max("built").alias("built"))
    counts = pairs.agg(
        F.coalesce(F.sum("stored"), F.lit(0)).alias("n_stored"), F.coalesce(F.sum(F.when(c("built") == 1, c("stored")).otherwise(0)), F.lit(0)).alias("stored_ok"),
        F.coalesce(F.sum("built"), F.lit(0)).alias("n_built"), F.count_if((c("built") == 1) & (c("stored") > 0)).alias("built_ok"))
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), c(n).cast("bigint").alias("checked"), c(ok).cast("bigint").alias("agree"), (c(n) - c(ok)).cast("bigint").alias("disagree"))
        for rule, n, ok in (("supplier_bridge", "n_stored", "stored_ok"), ("supplier_bridge_complete", "n_built", "built_ok"))])))


def rule_extended_price(cat: Catalog) -> DataFrame:
    """l_extendedprice = p_retailprice * l_quantity."""
    lines = (cat.lineitem.select("l_partkey", "l_quantity", "l_extendedprice")
             .join(cat.part.select("p_partkey", "p_retailprice"), c("l_partkey") == c("p_partkey"), "left"))
    return _counts("extended_price", lines, c("l_extendedprice") == c("p_retailprice") * c("l_quantity"))


def line_charge_cents(cat: Catalog) -> DataFrame:
    """Per order: sum of ((e * (100 - d)) / 100) * (100 + t) / 100 in cents, truncating."""
    lines = cat.lineitem.select("l_orderkey", cents("l_extendedprice").alias("e"),
                                cents("l_discount").alias("d"), cents("l_tax").alias("t"))
    charge = F.expr("((e * (100 - d)) div 100 * (100 + t)) div 100")
    return lines.groupBy("l_orderkey").agg(F.sum(charge).alias("total_cents"))


def rule_order_total(cat: Catalog) -> DataFrame:
    per_order = line_charge_cents(cat)
    orders = cat.orders.select("o_orderkey", "o_totalprice").join(
        per_order, c("o_orderkey") == c("l_orderkey"), "left")
    return _counts("order_total", orders, cents("o_totalprice") == c("total_cents"))


def rule_order_status(cat: Catalog) -> DataFrame:
    """o_orderstatus is F when all lines are F, O when none is, P otherwise."""
    per_order = (cat.lineitem.groupBy("l_orderkey")
                 .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(c("l_linestatus") == "F", 1)).alias("nf")))
    expected = F.when(c("nf") == c("n"), "F").when(c("nf") == 0, "O").otherwise("P")
    orders = cat.orders.select("o_orderkey", "o_orderstatus").join(
        per_order, c("o_orderkey") == c("l_orderkey"), "left")
    return _counts("order_status", orders, c("o_orderstatus") == expected)


def rule_line_flags(cat: Catalog, current: dt.date = CURRENT_DATE) -> DataFrame:
    """Line status from ship date, return flag from receipt date, against the current date."""
    lines = cat.lineitem.select("l_shipdate", "l_receiptdate", "l_linestatus", "l_returnflag")
    cur = F.lit(current)
    status_ok = c("l_linestatus") == F.when(c("l_shipdate") <= cur, "F").otherwise("O")
    flag_ok = F.when(c("l_receiptdate") <= cur, c("l_returnflag").isin("R", "A")) \
        .otherwise(c("l_returnflag") == "N")
    both = lines.agg(F.count(F.lit(1)).alias("checked"),
                     F.count(F.when(status_ok, 1)).alias("status_agree"),
                     F.count(F.when(flag_ok, 1)).alias("flag_agree"))
    return both.select(F.inline(F.array(
        F.struct(F.lit("line_status").alias("rule"), c("checked"), c("status_agree").alias("agree"),
                 (c("checked") - c("status_agree")).alias("disagree")),
        F.struct(F.lit("return_flag").alias("rule"), c("checked"), c("flag_agree").alias("agree"),
                 (c("checked") - c("flag_agree")).alias("disagree")))))


def rule_customer_gap(cat: Catalog) -> DataFrame:
    """Orders never belong to a customer whose key is a multiple of CUST_MORTALITY."""
    orders = cat.orders.select("o_custkey")
    return _counts("customer_gap", orders, c("o_custkey") % CUST_MORTALITY != 0)


def rule_sparse_order_key(cat: Catalog, seq: int = 0) -> DataFrame:
    """Order keys carry the sequence number ``seq`` in their sparse bits."""
    mask = (1 << SPARSE_BITS) - 1
    key = c("o_orderkey")
    return _counts("sparse_order_key", cat.orders.select("o_orderkey"),
                   F.shiftright(key, SPARSE_KEEP).bitwiseAND(F.lit(mask)) == seq)


def dense_index(key: Column) -> Column:
    """The running number that a sparse key was made from (its sequence bits taken out)."""
    high = F.shiftleft(F.shiftright(key, SPARSE_KEEP + SPARSE_BITS), SPARSE_KEEP)
    return high + key.bitwiseAND(F.lit((1 << SPARSE_KEEP) - 1))


def islands(df: DataFrame, group: str, index: str) -> DataFrame:
    """(group, kind, first_index, last_index, n_rows): runs of a group's index values.

    ``present`` runs have every index from first to last, ``missing`` runs are the gaps between
    them, ``doubled`` runs have indexes that occur more than once. An index less its running number among the
    group's distinct ones is constant on a run; the running number is taken over range partitions with
    offsets (``distributed_rank``), so no task holds a group.
    """
    values = df.where(c(index).isNotNull()).groupBy(group, index).agg(F.count(F.lit(1)).alias("n"))

    def runs(rows: DataFrame, kind: str) -> DataFrame:
        numbered = distributed_rank(rows, [group], [index], "_number", "rank")
        per = numbered.groupBy(group, (c(index) - c("_number")).alias("run"))
        return per.agg(F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.sum("n").alias("n_rows")).select(
            group, F.lit(kind).alias("kind"), "first_index", "last_index", "n_rows")

    present, doubled = runs(values, "present"), runs(values.where("n > 1"), "doubled")
    # Runs are numbered the same way; a gap lies between a run and the next.
    ordered = distributed_rank(present, [group], ["first_index"], "_run", "rank")
    following = ordered.select(c(group).alias("_g"), (c("_run") - 1).alias("_before"), c("first_index").alias("_next"))
    gaps = ordered.join(following, c(group).eqNullSafe(c("_g")) & (c("_run") == c("_before")))
    gaps = gaps.select(group, F.lit("missing").alias("kind"), (c("last_index") + 1).alias("first_index"), (c("_next") - 1).alias("last_index"), F.lit(0).cast("bigint").alias("n_rows"))
    return union_all([present, gaps, doubled])


def order_key_islands(cat: Catalog) -> DataFrame:
    """Runs, gaps and doubled indexes of the order keys' dense numbers, for each value of their sequence bits."""
    key = c("o_orderkey")
    seq = F.shiftright(key, SPARSE_KEEP).bitwiseAND(F.lit((1 << SPARSE_BITS) - 1)).cast("bigint")
    return islands(cat.orders.select(seq.alias("seq"), dense_index(key).alias("dense_index")), "seq", "dense_index")


def rule_phone_country(cat: Catalog) -> DataFrame:
    """The first two phone digits are 10 + nation key (customers, then suppliers)."""
    def check(df, rule, phone, nation):
        return _counts(rule, df.select(phone, nation),
                       F.substring(c(phone), 1, 2) == F.lpad((c(nation) + 10).cast("string"), 2, "0"))
    return union_all([check(cat.customer, "customer_phone_country", "c_phone", "c_nationkey"),
                      check(cat.supplier, "supplier_phone_country", "s_phone", "s_nationkey")])


def rule_supplier_flag(cat: Catalog) -> DataFrame:
    """Suppliers whose comment carries a complaint or a commendation phrase."""
    s = cat.supplier.select("s_comment")
    counts = s.agg(F.count(F.lit(1)).alias("checked"),
                   F.count(F.when(c("s_comment").rlike(COMPLAINT_PATTERN), 1)).alias("complaints"),
                   F.count(F.when(c("s_comment").rlike(COMMENDATION_PATTERN), 1)).alias("commendations"))
    return counts.select(F.inline(F.array(
        F.struct(F.lit("complaint").alias("rule"), c("checked"), c("complaints").alias("agree"),
                 (c("checked") - c("complaints")).alias("disagree")),
        F.struct(F.lit("commendation").alias("rule"), c("checked"), c("commendations").alias("agree"),
                 (c("checked") - c("commendations")).alias("disagree")))))


def nation_region_map(cat: Catalog) -> DataFrame:
    """Region of each nation as the running sum of the listed adjustments.

    The 25 listed pairs get their key from list position; the running sum
    is a window over that position (25 rows, one partition by design). The
    result is joined with the data's nation table on the key.
    """
    listed = cat.spark.createDataFrame(
        [(i, name, adj) for i, (name, adj) in enumerate(NATION_ADJUSTMENTS)],
        "m_nationkey int, m_name string, adjustment int")
    running = Window.orderBy("m_nationkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mapped = listed.select("m_nationkey", "m_name", F.sum("adjustment").over(running).cast("int").alias("m_regionkey"))
    return (cat.small("nation").join(mapped, c("n_nationkey") == c("m_nationkey"), "left")
            .select("n_nationkey", "n_name", "n_regionkey", c("m_name").alias("listed_name"),
                    c("m_regionkey").alias("listed_regionkey"),
                    (c("n_regionkey") == c("m_regionkey")).alias("region_agrees")))


def calendar_dim(cat: Catalog, week_start_day: int = 3) -> DataFrame:
    """One row per day between the first order date and the last receipt date.

    date_key counts days from 1970-01-01 starting at 1; month counts months
    from January 1970 starting at 1; week is ``(day_of_year + start - 1) / 7 + 1``.
    """
    last = cat.lineitem.agg(F.max("l_receiptdate")).scalar()
    days = (cat.orders.agg(F.min("o_orderdate").alias("d0"))
            .select(F.explode(F.sequence(c("d0"), last)).alias("d")))
    return days.select(
        (F.datediff(c("d"), F.lit(dt.date(1970, 1, 1))) + 1).cast("bigint").alias("date_key"),
        F.date_format(c("d"), "yyyy-MM-dd").alias("date_text"),
        F.year("d").cast("bigint").alias("year"),
        ((F.year("d") - 1970) * 12 + F.month("d")).cast("bigint").alias("month"),
        ((F.dayofyear("d") + week_start_day - 1) / 7 + 1).cast("bigint").alias("week"),
        F.dayofmonth("d").cast("bigint").alias("day"))
