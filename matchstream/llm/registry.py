"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchstream.llm import (
    bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    fill_middle,
    fuzzy_lines,
    jaccard_join,
    language_id,
    link_graph,
    merkle,
    packing,
    pii,
    suffix_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_fuzzy_lines": fuzzy_lines.op4_fuzzy_lines,
    "op5_url_filter": link_graph.op5_url_filter,
    "op6_chat_format": chat_format.op6_chat_format,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_pii": pii.op8_pii,
    "op9_language_id": language_id.op9_language_id,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_merkle": merkle.op11_merkle,
    "op12_packing": packing.op12_packing,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op6_chat_format": chat_format.OP6_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op13_fill_middle": fill_middle.OP13_SQL,
}
