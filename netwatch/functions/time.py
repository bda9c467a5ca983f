"""Event-time helpers.

Batch tables here carry wall-clock UTC timestamps without a zone
(``timestamp_ntz``); a stream's watermark needs a real instant
(``timestamp``). The two conversions below go through microseconds since the
epoch, so they do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_instant(c: Column | str) -> Column:
    """UTC wall clock (timestamp_ntz) -> instant (timestamp)."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _as_col(c))
    return F.timestamp_micros(micros)


def utc_wall_clock(c: Column | str) -> Column:
    """Instant (timestamp) -> UTC wall clock (timestamp_ntz)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_as_col(c)), F.expr(_EPOCH_NTZ))


def parse_event_time(c: Column | str) -> Column:
    """ISO-8601 text -> timestamp; unparsable text gives NULL.

    A plain cast raises under ANSI mode and one bad record would stop a
    stream, hence ``try_cast``.
    """
    return _as_col(c).try_cast("timestamp")


def clock_as(clock: str | Column | None, df: DataFrame, time_column: str) -> Column:
    """The detection clock, typed like ``df[time_column]``.

    ``None`` is processing time (``current_timestamp()``, one value per
    micro-batch). A string is a fixed UTC wall-clock time, which makes a run
    reproducible. A Column is taken as an instant.
    """
    ntz = isinstance(df.schema[time_column].dataType, TimestampNTZType)
    if clock is None:
        now = F.current_timestamp()
        return utc_wall_clock(now) if ntz else now
    if isinstance(clock, str):
        fixed = F.expr(f"TIMESTAMP_NTZ'{clock}'")
        return fixed if ntz else utc_instant(fixed)
    return utc_wall_clock(clock) if ntz else clock
