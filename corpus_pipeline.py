"""The corpus pipeline: from ``documents`` to token ids, stage by stage.

Each stage reads what its predecessor kept, written as Parquet and read again,
and its decisions take effect: rows that it rejects are gone.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchstream.llm.bpe import bpe_stage
from matchstream.llm.common import stored, table
from matchstream.llm.decontaminate import decontaminate_stage
from matchstream.llm.exact_dedup import exact_stage
from matchstream.llm.jaccard_join import jaccard_stage
from matchstream.llm.language_id import language_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("byte-level BPE", bpe_stage),
]

#: Compression sizes, R-trees and BPE merges have no SQL form; the pipeline is
#: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
