"""Windowed metrics: several measures of a window, one row per measure.

All measures of a set are aggregates of one grouping (one exchange, partial
sums and sketches per task), unpivoted afterwards to (metric_type,
metric_value, labels). The same set runs on a batch table and on a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch.operators.rules import stream_time_ready
from netwatch.operators.windows import window_column

# Distinct counts are exact up to 2**16 values of a group; beyond, the
# sketch keeps that many hashes and errs by about 0.4 percent.
DISTINCT_LOG2 = 16


@dataclass(frozen=True)
class Measure:
    """A named aggregate over the rows of a group."""

    name: str
    value: Callable[[], Column]


def count_of(name: str, predicate: Callable[[], Column] | None = None) -> Measure:
    """Rows for which ``predicate`` holds (all rows without one)."""
    return Measure(name, lambda: F.count_if(predicate() if predicate else F.lit(True)))


def share_of(name: str, predicate: Callable[[], Column]) -> Measure:
    """Share of the rows for which ``predicate`` holds; a row for which it
    is NULL counts in the whole only."""
    return Measure(name, lambda: F.count_if(predicate()).cast("double") / F.count(F.lit(1)))


def distinct_of(name: str, column: str, log2: int = DISTINCT_LOG2) -> Measure:
    """Distinct values without NULL, from a sketch that merges: state and
    shuffle stay bounded however many values a window has."""
    return Measure(name, lambda: F.theta_sketch_estimate(F.theta_sketch_agg(F.col(column), log2)))


def mean_of(name: str, column: str) -> Measure:
    return Measure(name, lambda: F.avg(column))


def max_of(name: str, column: str) -> Measure:
    return Measure(name, lambda: F.max(column))


@dataclass(frozen=True)
class MetricSet:
    """Measures per (window, labels)."""

    name: str
    measures: Sequence[Measure]
    labels: Sequence[str] = ()
    width: str = "60 seconds"
    slide: str | None = None
    watermark: str = "30 seconds"
    time_column: str = "event_time"
    output_mode: str = "append"
    # Record fields the measures and labels read (None: decode all).
    fields: tuple[str, ...] | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """window_start, window_end, metric_type, metric_value, labels.

        ``labels`` is a JSON object of the label columns in their order, NULL
        labels included. A measure without a value (a mean of NULLs) makes
        no row. Rows without an event time belong to no window.
        """
        df = stream_time_ready(df, self.time_column)
        if df.isStreaming:
            df = df.withWatermark(self.time_column, self.watermark)
        values = [m.value().cast("double").alias(f"__m{i}") for i, m in enumerate(self.measures)]
        grouped = (df.groupBy(window_column(self.time_column, self.width, self.slide).alias("window"), *self.labels)
                   .agg(*values))
        labels = (F.to_json(F.struct(*self.labels), {"ignoreNullFields": "false"}) if self.labels
                  else F.lit("{}"))
        rows = F.array(*[F.struct(F.lit(m.name).alias("metric_type"), F.col(f"__m{i}").alias("metric_value"))
                         for i, m in enumerate(self.measures)])
        return grouped.select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            labels.alias("labels"), F.inline(F.filter(rows, lambda r: r["metric_value"].isNotNull()))
        ).select("window_start", "window_end", "metric_type", "metric_value", "labels")


def routing_metrics(width: str = "60 seconds", watermark: str = "30 seconds",
                    labels: Sequence[str] = ()) -> MetricSet:
    """Message counts by kind, share of withdrawals, distinct prefixes,
    origins and routers of a window."""
    def kind(name: str) -> Callable[[], Column]:
        return lambda: F.col("event_type") == name

    return MetricSet("routing_metrics", (
        count_of("bgp_updates"), count_of("bgp_announcements", kind("ANNOUNCE")),
        count_of("bgp_withdrawals", kind("WITHDRAW")), count_of("bgp_path_changes", kind("PATH_CHANGE")),
        share_of("bgp_withdrawal_share", kind("WITHDRAW")), distinct_of("bgp_distinct_prefixes", "prefix"),
        distinct_of("bgp_distinct_origins", "origin_as"), distinct_of("bgp_distinct_routers", "router_id"),
    ), labels, width, watermark=watermark,
        fields=("event_type", "prefix", "origin_as", "router_id", *labels))


def lookup_metrics(width: str = "60 seconds", watermark: str = "15 seconds",
                   labels: Sequence[str] = ("resolver_ip",)) -> MetricSet:
    """Lookups, share of failed and of large-answer queries, distinct
    sources and names, highest name entropy; per resolver by default."""
    return MetricSet("lookup_metrics", (
        count_of("dns_queries"), share_of("dns_nxdomain_share", lambda: F.col("response_code") == "NXDOMAIN"),
        share_of("dns_any_txt_share", lambda: F.col("query_type").isin("ANY", "TXT")),
        distinct_of("dns_distinct_sources", "source_ip"), distinct_of("dns_distinct_names", "queried_domain"),
        max_of("dns_max_entropy", "entropy"),
    ), labels, width, watermark=watermark,
        fields=("response_code", "query_type", "source_ip", "queried_domain", "entropy", *labels))
