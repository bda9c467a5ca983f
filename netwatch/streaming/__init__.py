"""Structured Streaming: sinks, query starters, monitors."""

from netwatch.streaming.committed import CommittedBatchSink, committed_sinks, compact_days, vacuum
from netwatch.streaming.rolling import RollingView, latest_alerts_view, series_view
from netwatch.streaming.runner import (
    await_any,
    jdbc_sinks,
    parquet_sinks,
    progress_summary,
    progress_totals,
    run_until_drained,
    staged_stream,
    start_joined_rule,
    start_lookup_monitor,
    start_metrics,
    start_query,
    start_routing_monitor,
    start_rule,
    start_staging,
)
from netwatch.streaming.sinks import FanOutSink, JdbcBatchSink, ParquetBatchSink, compact
from netwatch.streaming.topics import (
    TopicBatchSink,
    alert_frames,
    folder_publisher,
    kafka_publisher,
    received_alerts,
    topic_sinks,
)

__all__ = [
    "CommittedBatchSink", "FanOutSink", "JdbcBatchSink", "ParquetBatchSink", "RollingView", "TopicBatchSink", "alert_frames", "await_any",
    "committed_sinks", "compact", "compact_days", "folder_publisher", "jdbc_sinks", "kafka_publisher", "latest_alerts_view",
    "received_alerts", "series_view",
    "parquet_sinks", "progress_summary", "progress_totals",
    "run_until_drained", "staged_stream", "start_joined_rule", "start_lookup_monitor", "start_metrics", "start_query",
    "start_routing_monitor", "start_rule", "start_staging", "topic_sinks", "vacuum",
]
