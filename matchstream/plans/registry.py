"""Union of the batch and streamed query catalogs with their oracles."""

from __future__ import annotations

from matchstream.plans.catalog import BATCH_QUERIES, Query
from matchstream.plans.oracle import batch_oracles
from matchstream.streaming.catalog import STREAM_QUERIES, stream_oracles


def all_queries() -> dict[str, Query]:
    return {**BATCH_QUERIES, **STREAM_QUERIES}


def all_oracles() -> dict[str, str]:
    return {**batch_oracles(), **stream_oracles()}
