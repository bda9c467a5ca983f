"""Archive projections: every decoded event, in the sink table's columns.

Stateless; on a stream no watermark filters them, so late events are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.schemas import DNS_EVENTS_COLUMNS, ROUTING_EVENTS_COLUMNS


def routing_events(decoded: DataFrame, time_column: str = "event_time") -> DataFrame:
    """Decoded routing updates -> routing_events (as_path, communities and
    the payload timestamp are not archived)."""
    return decoded.select(F.col(time_column).alias("timestamp"),
                          *[F.col(c) for c in ROUTING_EVENTS_COLUMNS[1:]])


def dns_events(decoded: DataFrame, time_column: str = "event_time") -> DataFrame:
    """Decoded lookups -> dns_events."""
    return decoded.select(F.col(time_column).alias("timestamp"),
                          *[F.col(c) for c in DNS_EVENTS_COLUMNS[1:]])
