"""Variants return what their base query returns; results do not depend on partitioning."""

import pytest

from conftest import SF_MID
from dssforge.plans import queries as Q
from dssforge.plans import variants as V
from dssforge.sources.tables import Catalog
from helpers import rows_of

PAIRS = [
    (V.q08a_decode, Q.q08, {}),
    (V.q12a_decode, Q.q12, {}),
    (V.q14a_decode, Q.q14, {}),
    (V.q15_view, Q.q15, {}),
    (V.q15a_cte, Q.q15, {}),
]


@pytest.mark.parametrize("variant,base,rename", PAIRS)
def test_variant_equals_base(spark, variant, base, rename):
    cat = Catalog(spark, SF_MID, complete=True)
    assert rows_of(variant(cat)) == rows_of(base(cat))


def test_q13a_equals_q13(spark):
    cat = Catalog(spark, SF_MID, complete=True)
    a = V.q13a_view(cat).withColumnRenamed("ordercount", "c_count")
    assert rows_of(a) == rows_of(Q.q13(cat))


@pytest.mark.parametrize("qname", ["q01", "q05", "q09", "q15", "q17", "q18", "q21"])
def test_partition_invariance(spark, qname):
    cat = Catalog(spark, SF_MID, complete=True)
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(rows_of(getattr(Q, qname)(cat)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


def test_variants_leave_caller_views_alone(spark):
    spark.range(3).createOrReplaceTempView("lineitem")
    try:
        cat = Catalog(spark, SF_MID, complete=True)
        for fn in (V.q08a_decode, V.q13a_view, V.q15_view, V.q15a_cte):
            fn(cat).collect()
        assert spark.table("lineitem").columns == ["id"]
        names = {t.name for t in spark.catalog.listTables()}
        assert not any(n.startswith(("orders_per_cust", "revenue0")) for n in names)
    finally:
        spark.catalog.dropTempView("lineitem")
