"""Column expressions. All of them stay inside Spark's generated code."""

from netwatch.functions.hashing import pseudonymise
from netwatch.functions.strings import name_length, shannon_entropy
from netwatch.functions.time import (
    clock_as,
    parse_event_time,
    utc_instant,
    utc_wall_clock,
)

__all__ = [
    "clock_as",
    "name_length",
    "parse_event_time",
    "pseudonymise",
    "shannon_entropy",
    "utc_instant",
    "utc_wall_clock",
]
