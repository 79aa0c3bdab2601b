"""Steps whose work per task follows the input: partition counts, key sets, line parsing and one-pass folders."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dssforge.operators import layout
from dssforge.operators.key_sets import without_keys
from dssforge.operators.refresh import as_result, refresh_sets, LINE_COLS
from dssforge.plans.explain import plan_text
from dssforge.plans.operator_queries import load_counts_by_file_q
from dssforge.sources import sizing
from dssforge.sources.delimited import parse_lines, to_file_shape, write_delimited
from dssforge.sources.tables import Catalog

from conftest import SF_SMALL


def test_written_parts_follow_small_shares_of_the_input(spark, monkeypatch):
    monkeypatch.setattr(sizing, "stored_bytes", lambda spark, path: 960 << 20)
    assert sizing.written_parts(spark, "any") == 30
    monkeypatch.setattr(sizing, "stored_bytes", lambda spark, path: 0)
    assert sizing.written_parts(spark, "any") == 1


@pytest.mark.parametrize("write", [layout.write_sorted, layout.write_year_partitioned])
def test_ranges_are_as_many_as_asked(spark, tmp_dir, write):
    days = spark.range(600).select("id", F.date_add(F.lit("1994-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("day"))
    by = ["day"] if write is layout.write_sorted else "day"
    args = (days, f"{tmp_dir}/t", by) if write is layout.write_sorted else (days, by, f"{tmp_dir}/t")
    write(*args, spread_cols=["id"], parts=6)
    assert len(list(Path(f"{tmp_dir}/t").rglob("*.parquet"))) == 6
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 600


@pytest.mark.parametrize("n_keys", [4, 10**9, None])
@pytest.mark.parametrize("parts", [3, None])
def test_without_keys_is_the_same_sent_or_dealt(spark, n_keys, parts):
    rows = spark.createDataFrame([(1, 0), (1, 5), (2, 0), (None, 0), (3, 0)], "k long, s int")
    keys = spark.createDataFrame([(1, 2), (1, 2), (3, 9), (7, 1)], "d long, g int")
    found = without_keys(rows, "k", keys, "d", n_keys=n_keys, parts=parts)
    assert sorted(map(str, found.select("k").collect())) == ["Row(k=2)", "Row(k=None)"]
    plan = plan_text(found, "simple")
    if n_keys == 4:
        assert "BroadcastHashJoin" in plan
    elif parts:
        assert "ShuffledHashJoin" in plan and "Sort" not in plan
    newer = without_keys(rows, "k", keys, "d", F.col("s") < F.col("g"), n_keys=n_keys, parts=parts)
    assert sorted(newer.collect(), key=str) == sorted([(1, 5), (2, 0), (None, 0)], key=str)


def test_lines_do_not_shuffle_to_meet_a_few_insert_keys(spark):
    cat = Catalog(spark, SF_SMALL, complete=True)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    size = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "20KB")  # under the bytes of orders, over those of its new keys
        s = refresh_sets(cat, store_keys=True)
        for df in (s.base_lines, s.insert_lines):
            assert "hashpartitioning(l_orderkey" not in plan_text(as_result(df, LINE_COLS), "simple")
    finally:
        spark.conf.set(conf, size)


def test_lines_with_and_without_escapes_parse_alike(spark):
    lines = spark.createDataFrame([("1|plain|2.50|",), (r"2|a\|b\\c\nd|3.00|",), ("3|||",), (r"\4|x|1|",)], "value string")
    df = parse_lines(lines, "k int, t string, m decimal(12,2)")
    assert [(r.k, r.t, r.m and float(r.m)) for r in df.collect()] == [
        (1, "plain", 2.5), (2, "a|b\\c\nd", 3.0), (3, None, None), (4, "x", 1.0)]
    # Regular expressions run on lines with a backslash alone, not on each field.
    assert plan_text(df, "simple").count("regexp_replace") <= 3
    for bad in ("1|x|2", "1|x|", "1|x|2|3|", "", r"1|x\|2|", "|1|x|2", "one|x|2|", r"\one|x|2|"):
        with pytest.raises(Exception, match="not 3 fields|no int in field k"):
            parse_lines(spark.createDataFrame([(bad,)], "value string"), "k int, t string, m decimal(12,2)").collect()


def test_folders_are_written_in_one_pass(spark, tmp_dir):
    orders = spark.createDataFrame([(1, datetime.date(1994, 5, 1)), (2, datetime.date(1994, 6, 1)), (3, None), (4, datetime.date(2001, 1, 1))],
                                   "o_orderkey long, o_orderdate date")
    write_delimited(to_file_shape(orders, "orders"), f"{tmp_dir}/orders.tbl", folders={"year": layout.year_partition("o_orderdate")})
    found = {p.name: sum(len(f.read_text().splitlines()) for f in p.glob("part-*")) for p in Path(f"{tmp_dir}/orders.tbl").glob("year=*")}
    assert found == {"year=1994": 2, "year=others": 2}


def test_counts_by_file_scan_each_table_once(spark, monkeypatch):
    from dssforge.plans import operator_queries
    calls = []
    monkeypatch.setattr(operator_queries, "write_delimited", lambda df, path, **kw: (calls.append(path), write_delimited(df, path, **kw)))
    counted = load_counts_by_file_q(Catalog(spark, SF_SMALL, complete=True))
    assert len(calls) == 2
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert counted.where("table_name = 'lineitem'").agg(F.sum("tuples")).first()[0] == lines
