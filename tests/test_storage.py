"""Stored states, layouts, key sets and statistics, each against a plain version."""

import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dssforge.operators import key_sets, layout, partition_stats
from dssforge.operators.refresh import refresh_partitions
from dssforge.operators.rules import islands
from dssforge.plans.explain import plan_statistics, plan_text
from dssforge.plans.queries import q02, q05, q08, q09
from dssforge.registry import registered_queries
from dssforge.sources.delimited import to_file_shape, write_delimited
from dssforge.sources.load import load_counted, load_tables
from dssforge.sources.sizing import size_runtime_filters
from dssforge.sources.tables import Catalog
from dssforge.streaming.refresh_stream import apply_batch, compact, manifests, read_state, segment_stream

ORDERS = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(12,2), o_orderdate date, "
          "o_orderpriority string, o_clerk string, o_shippriority int, o_comment string")


def orders(spark, keys, mark="x"):
    return spark.createDataFrame([(k, k, mark, None, dt.date(1990 + k % 12, 1, 1), None, None, 0, "a|b") for k in keys], ORDERS)


def test_replaced_table_is_read_anew(spark, tmp_dir):
    for name in ("region", "nation", "supplier", "part", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_dir}/{name}.parquet")
    cat = Catalog(spark, tmp_dir, complete=True)
    before = cat.partsupp.count()
    assert before > 100 and Catalog(spark, tmp_dir, complete=True).partsupp is cat.partsupp
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(10).write.mode("overwrite").parquet(f"{tmp_dir}/lineitem.parquet")
    fresh = Catalog(spark, tmp_dir, complete=True)
    pairs = {(r.l_partkey, r.l_suppkey) for r in spark.read.parquet(f"{tmp_dir}/lineitem.parquet").collect()}
    assert {(r.ps_partkey, r.ps_suppkey) for r in fresh.partsupp.collect()} == pairs
    assert fresh.lineitem.count() == 10
    q02(fresh).collect()


def segments(spark, landing, refresh_set, segment, rows=(), gone=(), mark="x"):
    if rows:
        write_delimited(to_file_shape(orders(spark, rows, mark), "orders"), f"{landing}/orders.tbl.u{refresh_set}.{segment}")
    if gone:
        write_delimited(spark.createDataFrame([(k,) for k in gone], "o_orderkey bigint"), f"{landing}/delete.u{refresh_set}.{segment}")


def test_segments_in_any_order_over_restarts(spark, tmp_dir):
    landing, state, ckpt = (f"{tmp_dir}/{x}" for x in ("landing", "state", "ckpt"))
    base = orders(spark, range(10), "base")

    def run():
        segment_stream(spark, "orders", "o_orderkey", landing, state, ckpt, files_per_batch=1).awaitTermination()

    def now():
        return sorted((r.o_orderkey, r.o_orderstatus) for r in read_state(spark, base, "o_orderkey", state).collect())

    segments(spark, landing, 2, 1, rows=[30], gone=[21, 3])  # the second set comes first
    run()
    assert now() == sorted([(k, "base") for k in range(10) if k != 3] + [(30, "x")])
    segments(spark, landing, 1, 2, rows=[20, 21, 5], gone=[1, 5, 30], mark="y")  # 5 is replaced, 21 deleted by the later set
    run()
    want = sorted([(k, "base") for k in range(10) if k not in (1, 3, 5)] + [(5, "y"), (20, "y"), (30, "x")])
    assert now() == want
    run()  # nothing new
    assert now() == want
    # A batch replayed replaces its output; one without a manifest is not seen.
    batches = [r.batch_id for r in manifests(spark, state).collect()]
    log = spark.read.parquet(f"{state}/log")
    again = spark.createDataFrame(log.where(F.col("batch_id") == batches[0]).drop("batch_id").collect(), log.drop("batch_id").schema)
    apply_batch(again, batches[0], state)
    again.write.parquet(f"{state}/log/batch_id=999")
    assert now() == want
    folded = compact(spark, base, "o_orderkey", state, f"{tmp_dir}/next")
    assert sorted((r.o_orderkey, r.o_orderstatus) for r in folded.collect()) == want


def files_of(path, part):
    return {(f.name, f.stat().st_mtime_ns) for f in Path(path).glob(f"year={part}/*.parquet")}


def test_refresh_rewrites_touched_partitions_only(spark, tmp_dir):
    state = f"{tmp_dir}/orders"
    base = orders(spark, range(60))
    year = layout.year_partition("o_orderdate")
    layout.write_year_partitioned(base, "o_orderdate", state)
    schema = base.withColumn("year", year).schema
    before = {y: files_of(state, y) for y in ("1992", "1993", "1994", "1995", "others")}
    gone = [k for k in range(60) if k % 12 == 3] + [2, 777, None]  # all of 1993, one of 1992
    new = orders(spark, [101, 113], "new").withColumn("year", year)  # 1995
    keys = spark.createDataFrame([(k,) for k in gone], "k bigint")
    for _ in range(2):  # applied once more, nothing changes
        assert set(refresh_partitions(state, schema, "year", "o_orderkey", keys, new)) <= {"1992", "1993", "1995"}
        got = sorted((r.o_orderkey, r.o_orderstatus) for r in spark.read.schema(schema).parquet(state).collect())
        assert got == sorted([(k, "x") for k in range(60) if k not in gone] + [(101, "new"), (113, "new")])
    after = {y: files_of(state, y) for y in before}
    assert after["1994"] == before["1994"] and after["others"] == before["others"]
    assert not after["1993"] and after["1992"] != before["1992"] and after["1995"] != before["1995"]


def test_key_sets_equal_plain_sets(spark):
    rng = random.Random(3)
    sets = {n: {rng.randint(-300, 300) for _ in range(rng.randint(0, 200))} | extra for n, extra in (("a", {2**62, -(2**63), 63, 64}), ("b", {2**62, -1}), ("c", set()))}
    frames = {n: spark.createDataFrame([(k,) for k in [*ks, *list(ks)[:5], None]], "k bigint") for n, ks in sets.items()}
    maps = {n: key_sets.bitmap(df) for n, df in frames.items()}

    def back(bits):
        found = [r.key for r in key_sets.keys_of(bits).collect()]
        assert len(found) == len(set(found)) == key_sets.size(bits).first().n
        return set(found)

    a, b = sets["a"], sets["b"]
    assert back(maps["a"]) == a
    assert back(key_sets.both(maps["a"], maps["b"])) == a & b
    assert back(key_sets.either(maps["a"], maps["b"])) == a | b
    assert back(key_sets.without(maps["a"], maps["b"])) == a - b
    got = {(r.left_set, r.right_set): r.common_keys for r in key_sets.overlaps(frames).collect()}
    assert got == {(x, y): len(sets[x] & sets[y]) for x in sets for y in sets if x <= y}


def test_dense_keys_take_a_row_per_block(spark):
    assert key_sets.bitmap(spark.range(64_000)).count() == 1000


def test_plan_statistics_list_every_operator(spark):
    cat = Catalog(spark, SF_SMALL, complete=True)
    rows = plan_statistics(q05(cat)).collect()
    assert rows[0].parent is None and all(r.parent < r.node for r in rows[1:])
    scans = {r.relation: r.rows_out for r in rows if r.relation}
    assert scans["lineitem"] == cat.lineitem.count() and scans["customer"] == cat.customer.count()
    assert any("Join" in r.operator and r.rows_out is not None for r in rows) and any(r.time_ms for r in rows)


def test_interleaved_files_skip_on_every_column(spark, tmp_dir):
    rows = spark.range(40_000).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(1000))).cast("int").alias("a"), F.date_add(F.lit(dt.date(2000, 1, 1)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900)).cast("int")).alias("d"),
        F.element_at(F.array(*map(F.lit, ["AIR", "FOB", "MAIL", "RAIL", "REG AIR", "SHIP", "TRUCK"])), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7)).cast("int") + 1).alias("mode"),
        F.when(F.col("id") % 9 > 0, F.col("id").cast("double")).alias("n"))
    path = f"{tmp_dir}/z"
    layout.write_interleaved(rows, path, ["a", "d", "mode"], files=64, spread_cols=["id"])
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    for predicate in (F.col("a") < 100, F.col("d") >= dt.date(2002, 4, 1), F.col("mode") == "TRUCK"):
        bounds = stored.groupBy(F.col("_metadata.file_path")).agg(F.min("a").alias("a0"), F.max("a").alias("a1"))
        found = layout.files_read(spark, path, predicate).first()
        assert found.files == 64 and found.files_hit <= 40, (predicate, found)
        assert bounds.count() == 64
    both = layout.files_read(spark, path, (F.col("a") < 100) & (F.col("mode") == "TRUCK")).first()
    assert both.files_hit <= 16
    with pytest.raises(ValueError):
        layout.interleaved(rows, ["a"] * 11)
    assert rows.select(layout.interleaved(rows, ["n"]).alias("z")).where("z is null").isEmpty()
    assert rows.limit(0).select(layout.interleaved(rows.limit(0), ["n", "mode"]).alias("z")).count() == 0


def test_ranks_follow_the_values(spark):
    rows = spark.createDataFrame([(x,) for x in ["", "A", "AB", "B", "Ba", "a", "é", None] * 9], "s string")
    got = sorted({(r.s, r.z) for r in rows.select("s", layout.interleaved(rows, ["s"]).alias("z")).collect() if r.s is not None}, key=lambda p: p[0].encode())
    assert [z for _, z in got] == sorted(z for _, z in got) and len({z for _, z in got}) >= 6


def test_order_proof_finds_what_is_out_of_order(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(layout, "PROOF_ROWS", 8)
    good = spark.range(1000).selectExpr("CASE WHEN id < 7 THEN NULL ELSE id div 3 END AS k", "id")
    layout.write_sorted(good, f"{tmp_dir}/good", ["k"], spread_cols=["id"])
    found = layout.order_proof(spark, f"{tmp_dir}/good", "k").first()
    assert (found.rows, found.unsorted_rows, found.overlapping_files, found.first_key, found.last_key) == (1000, 0, 0, None, 333)
    keys = list(range(100))
    keys[40], keys[70] = 200, -5  # at a block's border and inside
    spark.createDataFrame([(k,) for k in keys], "k bigint").coalesce(1).write.parquet(f"{tmp_dir}/bad")
    spark.createDataFrame([(k,) for k in range(150, 160)], "k bigint").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/bad")
    found = layout.order_proof(spark, f"{tmp_dir}/bad", "k").first()
    assert (found.files, found.rows, found.unsorted_rows, found.overlapping_files) == (2, 110, 2, 1)


def test_loaded_rows_are_counted_by_file(spark, tmp_dir):
    src, dst = f"{tmp_dir}/src", f"{tmp_dir}/dst"
    for k, keys in enumerate(([1, 2, 3], range(50), [])):
        write_delimited(to_file_shape(orders(spark, keys).repartition(3 if k == 1 else 1), "orders"), f"{src}/orders.tbl.{k}")
    write_delimited(to_file_shape(spark.createDataFrame([], "r_regionkey int, r_name string"), "region"), f"{src}/region.tbl")
    got = load_counted(spark, src, dst, ["orders", "region"]).collect()
    lines = Counter()
    for f in Path(src).glob("orders.tbl.*/part-*"):
        if n := len(f.read_text().splitlines()):
            lines[f"{f.parent.name}/{f.name}"] = n
    assert {r.source_file: r.tuples for r in got if r.table_name == "orders"} == dict(lines)
    assert [(r.source_file, r.tuples) for r in got if r.table_name == "region"] == [(None, 0)]
    assert spark.read.parquet(f"{dst}/orders.parquet").count() == 53


def test_each_of_very_many_files_is_counted(spark, tmp_dir):
    src, dst = Path(tmp_dir, "src", "orders.tbl"), f"{tmp_dir}/dst"
    src.mkdir(parents=True)
    want = {f"orders.tbl/part-{k:05d}": 1 + k % 3 for k in range(9_001)}
    for name, n in want.items():
        (src.parent / name).write_text("".join(f"{k}|1|F|1.00|1994-01-01|x|y|0|z|\n" for k in range(n)))
    # In folders of thousands of small files the default opening cost makes a task of every 32.
    conf = "spark.sql.files.openCostInBytes"
    cost = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "64k")
        got = load_counted(spark, str(src.parent), dst, ["orders"]).collect()
    finally:
        spark.conf.set(conf, cost)
    assert {r.source_file: r.tuples for r in got} == want and len(got) == len(want)
    assert spark.read.parquet(f"{dst}/orders.parquet").count() == sum(want.values())


@pytest.mark.parametrize("table, row", [("orders", "1|1|F|1.00|1994-01-01|x|y|0|z|\n"), ("region", "1|x|y|\n")])
def test_files_are_counted_alike_whether_the_table_is_sorted_or_not(spark, tmp_dir, table, row):
    src, dst = Path(tmp_dir, "src"), f"{tmp_dir}/dst"
    src.mkdir()
    for k, n in enumerate((3, 0, 5)):
        (src / f"{table}.tbl.{k}").write_text(row * n)
    got = load_counted(spark, str(src), dst, [table]).collect()
    assert sorted((r.table_name, r.source_file, r.tuples) for r in got) == [(table, f"src/{table}.tbl.0", 3), (table, f"src/{table}.tbl.2", 5)]
    loaded = spark.read.parquet(f"{dst}/{table}.parquet")
    assert loaded.count() == 8 and "source_file" not in loaded.columns


def test_folder_names_of_the_source_are_no_columns_of_the_table(spark, tmp_dir):
    src = Path(tmp_dir, "src")
    for name, row in (("orders", "1|1|F|1.00|1994-01-01|x|y|0|z|\n"), ("region", "1|x|y|\n")):
        for year in (1994, 1995):
            (src / f"{name}.tbl" / f"year={year}").mkdir(parents=True)
            (src / f"{name}.tbl" / f"year={year}" / "part-0").write_text(row)
    for load, dst in ((load_tables, f"{tmp_dir}/a"), (load_counted, f"{tmp_dir}/b")):
        found = load(spark, str(src), dst, ["orders", "region"]).groupBy("table_name").agg(F.sum("tuples").alias("n")).collect()
        assert {r.table_name: r.n for r in found} == {"orders": 2, "region": 2}
        assert len(spark.read.parquet(f"{dst}/orders.parquet").columns) == 9 and len(spark.read.parquet(f"{dst}/region.parquet").columns) == 3


def test_islands_equal_a_plain_walk(spark):
    rng = random.Random(4)
    rows = [(g, rng.randint(0, 60)) for g in (0, 1, None) for _ in range(45)] + [(7, 5), (8, None)]
    found = islands(spark.createDataFrame(rows, "g bigint, i bigint"), "g", "i").collect()
    want = set()
    for g in {g for g, i in rows if i is not None}:
        counts = Counter(i for h, i in rows if h == g and i is not None)
        for kind, values in (("present", sorted(counts)), ("doubled", sorted(i for i in counts if counts[i] > 1))):
            run = []
            for i in [*values, None]:
                if run and i != run[-1] + 1:
                    want.add((g, kind, run[0], run[-1], sum(counts[x] for x in run)))
                    if kind == "present" and i is not None:
                        want.add((g, "missing", run[-1] + 1, i - 1, 0))
                    run = []
                run.append(i)
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_partition_statistics_merge_to_a_full_scan(spark, tmp_dir):
    rows = spark.range(500).selectExpr("id % 5 AS p", "CASE WHEN id % 11 > 0 THEN id * 7 % 90 END AS n", "date_add(DATE '1969-12-20', cast(id % 30 AS int)) AS d", "CAST(NULL AS int) AS e")
    widths = {"n": 10.0, "d": 7.0, "e": 1.0}
    path = f"{tmp_dir}/stats"
    partition_stats.analyze(rows.where("p < 3"), "p", widths, path)
    partition_stats.analyze(rows, "p", widths, path, ["3", "4"])

    def told(stats):
        return sorted((r.column_name, r.row_count, r.null_count, r.min_value, r.max_value, r.bounds) for r in partition_stats.merged(stats, widths).collect())

    full = told(partition_stats.partition_rows(rows.withColumn("p", F.lit("all")), "p", widths))
    assert told(partition_stats.read(spark, path)) == full
    assert full[1][:5] == ("e", 500, 500, None, None) and full[0][3:5] == (-12.0, 17.0)
    partition_stats.analyze(rows.where("p <> 2 OR n < 20"), "p", widths, path, ["2"])  # a changed partition replaces its own rows
    partition_stats.forget(spark, path, ["4"])
    assert told(partition_stats.read(spark, path)) == told(partition_stats.partition_rows(rows.where("p < 4 AND (p <> 2 OR n < 20)"), "p", widths))


def test_statistics_of_a_column_without_values(spark):
    spark.sql("CREATE TABLE no_values AS SELECT CAST(NULL AS int) AS k FROM range(3)")
    try:
        layout.compute_stats(spark, "no_values")
        assert layout.table_stats(spark, "no_values", "k") == {"rows": 3, "min": None, "max": None, "num_nulls": 3}
    finally:
        spark.sql("DROP TABLE no_values")


@pytest.mark.parametrize("query", [q05, q08, q09])
def test_runtime_filters_stay_when_the_build_side_grows(spark, query):
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    names = ["spark.sql.autoBroadcastJoinThreshold"] + [f"{prefix}.{x}" for x in (
        "applicationSideScanSizeThreshold", "creationSideThreshold", "expectedNumItems", "maxNumItems", "numBits", "maxNumBits")]
    old = {k: spark.conf.get(k) for k in names}
    try:
        spark.conf.set(names[0], "-1")
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1b")  # as if the build side had outgrown the default
        folder = "/root/testdata/sf0.1"
        assert "might_contain" not in plan_text(query(Catalog(spark, folder, complete=True)), "simple")
        size_runtime_filters(spark, f"{folder}/orders.parquet", f"{folder}/lineitem.parquet")
        assert "might_contain" in plan_text(query(Catalog(spark, folder, complete=True)), "simple")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_nothing_is_made_up_unless_asked(spark, tmp_dir):
    from dssforge.__main__ import main

    with pytest.raises(Exception, match="l_shipmode"):
        registered_queries(False)["q12_shipping_modes"](spark, SF_SMALL)
    with pytest.raises(Exception, match="l_shipmode"):
        main([SF_SMALL, "q12_shipping_modes"])
    assert main([SF_SMALL, "q12_shipping_modes", "--complete", "--out", f"{tmp_dir}/out"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/out/q12_shipping_modes").count() == 2
