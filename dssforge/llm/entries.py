"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dssforge.llm import alignment, audit, chat, decontam, line_dedup, minhash, mixing, packing, quality, token_counts, token_store, topk, toxicity

_MODULES = {
    "op1_line_dedup": line_dedup,
    "op2_token_store": token_store,
    "op3_token_counts": token_counts,
    "op4_exact_topk": topk,
    "op5_mix_sources": mixing,
    "op6_toxicity": toxicity,
    "op7_minhash_dedup": minhash,
    "op8_quality": quality,
    "op9_decontaminate": decontam,
    "op10_chat_format": chat,
    "op11_packing": packing,
    "op12_filter_audit": audit,
    "op13_token_alignment": alignment,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE for name, module in _MODULES.items() if getattr(module, "ORACLE", None)}
