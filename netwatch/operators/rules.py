"""Detection rules.

A rule is one DataFrame function. The same call works on a batch table and
on a streaming DataFrame; on a stream it sets the rule's watermark after its
filter, so only matching rows advance event time, as in the original jobs.
Thresholds, windows, keys and the clock are parameters; the defaults are the
reference values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import TimestampNTZType

from netwatch.functions.prefixes import unexpected_path_as
from netwatch.functions.time import clock_as, utc_instant
from netwatch.operators.windows import windowed_counts

# The origin allow-list of the routing rules, in the order the
# reference lists them.
KNOWN_ORIGIN_AS = (
    15169, 16509, 8075, 32934, 13335, 1299, 3356, 174, 2914, 7018,
    20940, 54113, 36040, 15133, 22822, 6939, 3257, 1273, 5511, 6453,
)

# The networks of the routing simulation, in its order; an AS
# path made of them is unsuspicious.
PATH_AS = (15169, 32934, 16509, 8075, 13335, 20940, 1299, 3356, 6461, 2914,
           7018, 3320, 5400, 12389, 9002)

BGP = "bgp"
DNS = "dns"


def alert_projection(
    df: DataFrame,
    kind: str,
    alert_type: str,
    severity: str,
    detected_at: Column,
) -> DataFrame:
    """Shape windowed counts into an alert table row.

    BGP alerts: window_start, window_end, prefix, origin_as, event_count,
    alert_type, severity, detected_at. DNS alerts carry source_ip in place of
    prefix and origin_as.
    """
    cols = df.columns
    head = [F.col("window_start"), F.col("window_end")]
    if kind == BGP:
        origin = F.col("origin_as") if "origin_as" in cols else F.lit(None).cast("int")
        keys = [F.col("prefix"), origin.alias("origin_as")]
    else:
        keys = [F.col("source_ip")]
    return df.select(
        *head,
        *keys,
        F.col("event_count").cast("long").alias("event_count"),
        F.lit(alert_type).alias("alert_type"),
        F.lit(severity).alias("severity"),
        detected_at.alias("detected_at"),
    )


def stream_time_ready(df: DataFrame, time_column: str) -> DataFrame:
    """A watermark needs an instant: on a stream, a UTC wall-clock time
    column (timestamp_ntz) is converted to a timestamp first."""
    if df.isStreaming and isinstance(df.schema[time_column].dataType, TimestampNTZType):
        return df.withColumn(time_column, utc_instant(time_column))
    return df


@dataclass(frozen=True)
class WindowRule:
    """filter -> [watermark] -> count per (window, keys) -> count > threshold."""

    name: str
    kind: str
    alert_type: str
    severity: str
    predicate: Callable[[], Column]
    keys: Sequence[str]
    width: str
    slide: str | None = None
    threshold: int | None = None
    watermark: str = "30 seconds"
    output_mode: str = "append"
    time_column: str = "event_time"
    # Record fields the predicate and keys read (None: unknown, decode all).
    fields: tuple[str, ...] | None = None

    def _stream_ready(self, df: DataFrame) -> DataFrame:
        return stream_time_ready(df, self.time_column)

    def counts(self, df: DataFrame) -> DataFrame:
        df = self._stream_ready(df)
        rows = df.filter(self.predicate())
        if df.isStreaming:
            rows = rows.withWatermark(self.time_column, self.watermark)
        counted = windowed_counts(rows, self.time_column, self.keys, self.width, self.slide)
        if self.threshold is not None:
            counted = counted.filter(F.col("event_count") > self.threshold)
        return counted

    def apply(self, df: DataFrame, clock: str | Column | None = None) -> DataFrame:
        df = self._stream_ready(df)
        detected_at = clock_as(clock, df, self.time_column)
        return alert_projection(self.counts(df), self.kind, self.alert_type,
                                self.severity, detected_at)

    def with_params(self, **changes) -> "WindowRule":
        """A copy with some parameters changed; a new predicate or new keys
        forget the declared fields (everything is decoded again)."""
        values = {f: getattr(self, f) for f in self.__dataclass_fields__}
        if ("predicate" in changes or "keys" in changes) and "fields" not in changes:
            values["fields"] = None
        values.update(changes)
        return WindowRule(**values)


@dataclass(frozen=True)
class EventRule:
    """One alert per matching event; the window bounds are the clock. A
    lookup rule names its source by ``key``, a routing rule by prefix and
    origin."""

    name: str
    kind: str
    alert_type: str
    severity: str
    predicate: Callable[[], Column]
    key: str = "source_ip"
    time_column: str = "event_time"
    output_mode: str = field(default="append")

    def apply(self, df: DataFrame, clock: str | Column | None = None) -> DataFrame:
        now = clock_as(clock, df, self.time_column)
        keys = ([F.col("prefix"), F.col("origin_as").cast("int").alias("origin_as")] if self.kind == BGP
                else [F.col(self.key).alias(self.key)])
        return df.filter(self.predicate()).select(
            now.alias("window_start"),
            now.alias("window_end"),
            *keys,
            F.lit(1).cast("long").alias("event_count"),
            F.lit(self.alert_type).alias("alert_type"),
            F.lit(self.severity).alias("severity"),
            now.alias("detected_at"),
        )


def route_flap_rule(threshold: int = 5, width: str = "60 seconds",
                    watermark: str = "30 seconds") -> WindowRule:
    """More than ``threshold`` ANNOUNCE/WITHDRAW messages for a prefix in a
    tumbling window. Messages are counted, not route changes; PATH_CHANGE is
    not counted."""
    return WindowRule(
        name="route_flap", kind=BGP, alert_type="ROUTE_FLAP", severity="HIGH",
        predicate=lambda: F.col("event_type").isin("ANNOUNCE", "WITHDRAW"),
        keys=("prefix",), width=width, threshold=threshold, watermark=watermark,
        output_mode="append", fields=("prefix", "event_type"))


def as_hijack_rule(known_origins: Sequence[int] = KNOWN_ORIGIN_AS,
                   width: str = "60 seconds", watermark: str = "30 seconds") -> WindowRule:
    """ANNOUNCE messages whose origin AS is not on the allow-list, counted
    per prefix and origin in a tumbling window; every group alerts. A NULL
    origin is not a hijack (NOT IN over NULL is NULL)."""
    allowed = list(known_origins)
    return WindowRule(
        name="as_hijack", kind=BGP, alert_type="BGP_HIJACK", severity="CRITICAL",
        predicate=lambda: (F.col("event_type") == "ANNOUNCE") & ~F.col("origin_as").isin(allowed),
        keys=("prefix", "origin_as"), width=width, threshold=None, watermark=watermark,
        output_mode="append", fields=("prefix", "origin_as", "event_type"))


def nxdomain_storm_rule(threshold: int = 100, width: str = "30 seconds",
                        slide: str = "10 seconds", watermark: str = "15 seconds") -> WindowRule:
    """More than ``threshold`` NXDOMAIN answers for one source in a sliding
    window. Emitted in update mode on a stream."""
    return WindowRule(
        name="nxdomain_storm", kind=DNS, alert_type="NXDOMAIN_STORM", severity="HIGH",
        predicate=lambda: F.col("response_code") == "NXDOMAIN",
        keys=("source_ip",), width=width, slide=slide, threshold=threshold,
        watermark=watermark, output_mode="update", fields=("source_ip", "response_code"))


def amplification_rule(threshold: int = 50, width: str = "30 seconds",
                       slide: str = "10 seconds", watermark: str = "15 seconds") -> WindowRule:
    """More than ``threshold`` ANY/TXT queries from one source in a sliding
    window. Emitted in update mode on a stream."""
    return WindowRule(
        name="amplification", kind=DNS, alert_type="AMPLIFICATION", severity="MEDIUM",
        predicate=lambda: F.col("query_type").isin("ANY", "TXT"),
        keys=("source_ip",), width=width, slide=slide, threshold=threshold,
        watermark=watermark, output_mode="update", fields=("source_ip", "query_type"))


def dns_tunneling_rule(max_length: int = 50, max_entropy: float = 3.5) -> EventRule:
    """Names longer than ``max_length`` or with entropy above
    ``max_entropy``; both comparisons strict, NULL-aware (NULL OR true)."""
    return EventRule(
        name="dns_tunneling", kind=DNS, alert_type="DNS_TUNNELING", severity="CRITICAL",
        predicate=lambda: (F.col("domain_length") > max_length) | (F.col("entropy") > max_entropy))


def path_anomaly_rule(expected: Sequence[int] = PATH_AS, typed: bool = False) -> EventRule:
    """Updates whose AS path holds a network that is not expected (a foreign
    AS put into the path). ``typed`` when the path is decoded as an array."""
    networks = list(expected)
    return EventRule(
        name="path_anomaly", kind=BGP, alert_type="PATH_ANOMALY", severity="HIGH",
        predicate=lambda: F.size(F.coalesce(
            unexpected_path_as("as_path", networks, typed), F.array().cast("array<int>"))) > 0)
