"""All registered operators as ``(spark, sf_dir) -> DataFrame`` callables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dssforge.operators import checks, refresh, rules, windows
from dssforge.plans import operator_queries as io
from dssforge.plans.oracle import query_oracles
from dssforge.plans.oracle_ops import operator_oracles
from dssforge.plans.queries import QUERIES
from dssforge.plans.variants import VARIANTS
from dssforge.sources.delimited import load_counts
from dssforge.sources.tables import Catalog

OPERATORS = {
    # 2F integrity checks
    "pk_violations": checks.pk_violations,
    "fk_orphans": checks.fk_orphans,
    "not_null": checks.not_null,
    # 2G business rules
    "rule_retail_price": rules.rule_retail_price,
    "rule_supplier_bridge": rules.rule_supplier_bridge,
    "rule_extended_price": rules.rule_extended_price,
    "rule_order_total": rules.rule_order_total,
    "rule_order_status": rules.rule_order_status,
    "rule_line_flags": rules.rule_line_flags,
    "rule_customer_gap": rules.rule_customer_gap,
    "rule_sparse_order_key": rules.rule_sparse_order_key,
    "order_key_islands": rules.order_key_islands,
    "rule_phone_country": rules.rule_phone_country,
    "rule_supplier_flag": rules.rule_supplier_flag,
    "nation_region_map": rules.nation_region_map,
    "calendar_dim": rules.calendar_dim,
    # 2H refresh sets
    "refresh_insert": refresh.refresh_insert_query,
    "refresh_insert_lines": refresh.refresh_insert_lines_query,
    "refresh_delete": refresh.refresh_delete_query,
    "refresh_delete_orders": refresh.refresh_delete_orders_query,
    "refresh_apply": refresh.refresh_apply_query,
    "refresh_apply_lines": refresh.refresh_apply_lines_query,
    "refresh_partitioned": refresh.refresh_partitioned_query,
    "refresh_partitioned_lines": refresh.refresh_partitioned_lines_query,
    "refresh_key_sets": refresh.refresh_key_sets_query,
    "refresh_stream": io.refresh_stream_q,
    "refresh_stream_lines": io.refresh_stream_lines_q,
    # 2D sources and sinks
    "load_delimited": io.load_delimited_q,
    "load_csv_nodummy": io.load_csv_nodummy_q,
    "load_copy": io.load_copy_q,
    "load_counts": load_counts,
    "load_counts_by_file": io.load_counts_by_file_q,
    "load_tables": io.load_tables_q,
    "write_delimited": io.write_delimited_q,
    "write_table": io.write_table_q,
    "table_from_query": io.table_from_query_q,
    # 2E layout
    "layout_year_partition": io.layout_year_partition_q,
    "layout_hash": io.layout_hash_q,
    "layout_bucketed": io.layout_bucketed_q,
    "layout_minmax": io.layout_minmax_q,
    "layout_interleaved": io.layout_interleaved_q,
    "layout_sorted": io.layout_sorted_q,
    "layout_random": io.layout_random_q,
    "layout_compress": io.layout_compress_q,
    "recreate_schema": io.recreate_schema_q,
    "compact": io.compact_q,
    "stats": io.stats_q,
    "stats_by_partition": io.stats_by_partition_q,
    # 2I run-log reports
    "runlog_load": io.runlog_load_q,
    "report_queries": io.report_queries_q,
    "report_loads": io.report_loads_q,
    "report_analyze": io.report_analyze_q,
    "report_gen_data": io.report_gen_data_q,
    "report_sessions": io.report_sessions_q,
    # 2J result comparison
    "result_diff": io.result_diff_q,
    # 2C windows
    "w_row_number": windows.w_row_number,
    "w_rank": windows.w_rank,
    # 2C plans with run statistics
    "plan_statistics": io.plan_statistics_q,
}


def _on_catalog(fn, complete: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Catalog(spark, sf_dir, complete=complete))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def registered_queries(complete: bool = True) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every key; ``complete`` derives the columns and the partsupp table that a data set lacks (see ``Catalog``)."""
    return {k: _on_catalog(f, complete) for group in (QUERIES, VARIANTS, OPERATORS) for k, f in group.items()}


def oracle_statements() -> dict[str, str]:
    out = query_oracles()
    out.update(operator_oracles())
    return out
