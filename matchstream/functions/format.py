"""Presentation helpers for serving queries and text sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchstream.schema import ALERT_LABEL


def window_bound_text(c: Column | str) -> Column:
    """Window bound as ``yyyy-MM-dd HH:mm:ss`` text (only for text sinks)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def percent_text(c: Column | str) -> Column:
    """``12.3456`` -> ``"12.35%"``.

    ``format_number`` rounds like Python's ``f"{x:.2f}"`` on the binary value
    (``format_string`` rounds the decimal text half-up and differs on ties); it
    adds thousands separators, which are removed.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.regexp_replace(F.format_number(col, 2), ",", ""), F.lit("%"))


def alert_label(c: Column | str) -> Column:
    """Boolean player alert -> display label (empty string when not alerted)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col, F.lit(ALERT_LABEL)).otherwise(F.lit(""))
