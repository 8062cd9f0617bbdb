"""ANSI-safe casts for text coming from outside (CSV cells, JSON fields).

Spark 4 runs in ANSI mode: a plain ``cast`` of a bad string throws and kills
the job.  Every external value therefore goes through ``try_cast``, which
yields NULL instead, and the caller decides (default, quarantine).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_timestamp(c: Column | str, ntz: bool = True) -> Column:
    """ISO-8601 text (``2025-04-15T06:12:00``, optional fraction) -> timestamp.

    ``ntz=True`` gives TIMESTAMP_NTZ (wall-clock, batch tables); ``False``
    gives TIMESTAMP, which event-time watermarks require.  Bad text -> NULL.
    """
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("timestamp_ntz" if ntz else "timestamp")


def int_or_zero(c: Column | str) -> Column:
    """Integer cell where blank (or whitespace) means 0; unparsable -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    trimmed = F.trim(col)
    return F.when(col.isNull() | (trimmed == ""), F.lit(0)).otherwise(trimmed.try_cast("int"))


_NTZ_EPOCH = "1970-01-01 00:00:00"


def utc_instant(c: Column | str) -> Column:
    """TIMESTAMP_NTZ wall-clock -> TIMESTAMP instant, read as UTC.

    Independent of ``spark.sql.session.timeZone`` (a plain cast would use it,
    and shift windows in zones with offsets or DST).
    """
    col = F.col(c) if isinstance(c, str) else c
    epoch = F.lit(_NTZ_EPOCH).cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, col))


def utc_wall_clock(c: Column | str) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall-clock in UTC (inverse of :func:`utc_instant`)."""
    col = F.col(c) if isinstance(c, str) else c
    epoch = F.lit(_NTZ_EPOCH).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), epoch)
