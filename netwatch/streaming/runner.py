"""Start detection queries on a stream.

One streaming query per windowed rule, as in the original deployment: each
has its own checkpoint and state store, and a rule's watermark moves only
with the rows it counts. Everything stateless about one source (archive,
dead letters, per-event rules) runs as a single query that reads and
decodes the source once. Several queries run in one session; ``await_any``
ends the program when one fails.
"""

from __future__ import annotations

import os
import threading
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from netwatch.operators.alerts import fused_routing_alerts, fused_window_alerts
from netwatch.operators.archive import dns_events, routing_events
from netwatch.operators.metrics import MetricSet
from netwatch.operators.rules import (
    EventRule,
    WindowRule,
    amplification_rule,
    as_hijack_rule,
    dns_tunneling_rule,
    nxdomain_storm_rule,
    route_flap_rule,
)
from netwatch.sources.decode import (
    LOOKUP_REQUIRED,
    ROUTING_REQUIRED,
    decode_lookups,
    decode_routing,
    keep_raw_of_rejects,
    split_rejects,
)
from netwatch.session import make_dir
from netwatch.streaming.sinks import BatchWriter, FanOutSink, JdbcBatchSink, ParquetBatchSink

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}

# (path, writer, options of ParquetBatchSink) -> what writes a micro-batch.
SinkFactory = Callable[..., BatchWriter]


def parquet_sinks(table_root: str) -> SinkFactory:
    """The default sinks: one parquet table per name below ``table_root``."""
    def make(table: str, writer: str, **options) -> BatchWriter:
        return ParquetBatchSink(os.path.join(table_root, table), writer, **options)
    return make


def jdbc_sinks(url: str, properties: Mapping[str, str], batch_column: str | None = None,
               num_partitions: int | None = None) -> SinkFactory:
    """Database tables of the same names. With ``batch_column`` replays are
    idempotent."""
    def make(table: str, writer: str, cache: bool = True, **parquet_only) -> BatchWriter:
        return JdbcBatchSink(url, table, properties, batch_column, writer, num_partitions, cache)
    return make


def start_query(frame: DataFrame, sink: BatchWriter, checkpoint: str,
                output_mode: str = "append", name: str | None = None,
                trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """``frame`` -> ``foreachBatch(sink)`` with its own checkpoint."""
    progress_totals(frame.sparkSession)
    writer = (frame.writeStream.outputMode(output_mode).foreachBatch(sink)
              .option("checkpointLocation", checkpoint)
              .trigger(**dict(trigger or DEFAULT_TRIGGER)))
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_rule(decoded: DataFrame, rule: WindowRule | EventRule, sink: BatchWriter,
               checkpoint: str, clock: str | Column | None = None,
               trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """One detection rule as one streaming query (watermark set by the rule)."""
    return start_query(rule.apply(decoded, clock), sink, checkpoint, rule.output_mode,
                       rule.name, trigger)


def start_joined_rule(decoded: DataFrame, rule: WindowRule | EventRule,
                      join: Callable[[DataFrame], DataFrame], sink: BatchWriter, checkpoint: str,
                      clock: str | Column | None = None,
                      trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """A rule whose alerts are joined with a reference table batch by batch.

    ``join`` gets the alerts of a micro-batch and reads the table itself
    (through ``alerts.sparkSession``), so every batch sees the table as it
    is then, and its size is checked then. A stream-static join would keep
    the files that were there when the query started. ``sink`` should not
    cache: the batch is cached here.
    """
    return start_query(rule.apply(decoded, clock), FanOutSink({rule.name: (join, sink)}), checkpoint,
                       rule.output_mode, rule.name, trigger)


def start_metrics(decoded: DataFrame, metrics: MetricSet, sink: BatchWriter, checkpoint: str,
                  trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Windowed metrics as one stateful query."""
    return start_query(metrics.apply(decoded), sink, checkpoint, metrics.output_mode, metrics.name, trigger)


def start_staging(decoded: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None,
                  retention: str | None = None) -> StreamingQuery:
    """Decoded frames as a table that other queries stream from
    (``staged_stream``).

    The file sink of Structured Streaming lists the files of a batch when it
    is committed, and its readers take listed files only, so every frame is
    staged once, whatever is replayed. ``retention`` (as "7d") takes
    older files off the list, which otherwise grows; the files themselves
    may be removed once every reader has passed them.
    """
    progress_totals(decoded.sparkSession)
    writer = (decoded.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
              .queryName(os.path.basename(checkpoint)).trigger(**dict(trigger or DEFAULT_TRIGGER)))
    if retention:
        writer = writer.option("retention", retention)
    return writer.start()


def staged_stream(spark: SparkSession, path: str, schema: StructType,
                  files_per_trigger: int | None = None) -> DataFrame:
    """The staged frames as a stream with ``schema``, the one they were
    decoded to. The folder may be empty yet. A query reads the columns it
    uses only."""
    make_dir(spark, path)
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _decode_once(decoded: DataFrame, root: str, name: str, checkpoint_root: str, trigger,
                 files_per_trigger: int | None) -> tuple[DataFrame, list[StreamingQuery]]:
    """Start the staging of a monitor: what its other queries read, and the
    query. With ``availableNow`` the others would end before there is
    anything staged, so it is run to its end first."""
    path = os.path.join(root, name)
    query = start_staging(decoded, path, os.path.join(checkpoint_root, name), trigger)
    if (trigger or {}).get("availableNow"):
        run_until_drained([query])
    return staged_stream(decoded.sparkSession, path, decoded.schema, files_per_trigger), [query]


def _alert_sink(sinks: SinkFactory, table: str, writer: str, mode: str) -> BatchWriter:
    """Alerts of a stateful query: few rows over many state partitions, so
    merged by size before they are written."""
    return sinks(table, writer, mode=mode, date_column="window_start", rebalance=True)


def _stateless_outputs(sinks: SinkFactory, archive: str, rejects: str, project,
                       required: Sequence[str]) -> dict:
    return {
        archive: (project, sinks(archive, "archive", cache=False, date_column="timestamp")),
        rejects: ((lambda df: split_rejects(df, required)[1]), sinks(rejects, "decode", cache=False)),
    }


def _event_outputs(rules: Sequence[WindowRule | EventRule], table: str, sinks: SinkFactory, clock) -> dict:
    """The per-event rules as outputs of the stateless query."""
    return {rule.name: ((lambda df, r=rule: r.apply(df, clock)),
                        sinks(table, rule.name, cache=False, date_column="window_start"))
            for rule in rules if isinstance(rule, EventRule)}


def _start_metrics(metrics: MetricSet | None, decode, sinks: SinkFactory, checkpoint_root: str,
                   trigger) -> list[StreamingQuery]:
    if metrics is None:
        return []
    sink = sinks("aggregated_metrics", metrics.name, mode=metrics.output_mode, date_column="window_start",
                 rebalance=True)
    return [start_metrics(decode(metrics.fields), metrics, sink, os.path.join(checkpoint_root, metrics.name),
                          trigger)]


def _start_windowed(rules: Sequence[WindowRule], decode, fuse, name: str, table: str,
                    sinks: SinkFactory, checkpoint_root: str, clock, trigger) -> list[StreamingQuery]:
    """One query per rule, or with ``fuse`` one for all of them, each
    decoding only the record fields its rules read."""
    if fuse is not None and len(rules) > 1:
        fields = None if any(r.fields is None for r in rules) else sorted({f for r in rules for f in r.fields})
        mode = rules[0].output_mode
        return [start_query(fuse(decode(fields), rules, clock), _alert_sink(sinks, table, name, mode),
                            os.path.join(checkpoint_root, name), mode, name, trigger)]
    return [start_rule(decode(rule.fields), rule, _alert_sink(sinks, table, rule.name, rule.output_mode),
                       os.path.join(checkpoint_root, rule.name), clock, trigger) for rule in rules]


def start_routing_monitor(wire: DataFrame, table_root: str | None, checkpoint_root: str,
                          clock: str | Column | None = None,
                          trigger: Mapping[str, object] | None = None,
                          rules: list[WindowRule | EventRule] | None = None,
                          fuse_windowed: bool = False,
                          sinks: SinkFactory | None = None,
                          metrics: MetricSet | None = None,
                          staging: str | None = None,
                          files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Archive (+ dead letters), the routing rules, metrics on request.

    Tables: ``routing_events``, ``routing_rejects`` (malformed frames and
    frames without a required field, with the raw text and the reason; they
    stay in the archive) and ``bgp_alerts``; parquet below ``table_root``
    unless ``sinks`` makes others. One stateless query writes the archive,
    the rejects and the alerts of per-event rules from the same micro-batch;
    each windowed rule is its own query and decodes without carrying the raw
    text. ``metrics`` (``routing_metrics()``) adds a query that fills
    ``aggregated_metrics``. With ``fuse_windowed``
    all rules are one query (writer ``bgp_windowed``), and rules that cannot
    be fused raise; see ``fused_routing_alerts``.

    By default every query reads and decodes the source itself, as in the
    original deployment. With a ``staging`` folder one more query decodes
    each frame once into ``<staging>/routing_decoded``, and the others
    stream from there, ``files_per_trigger`` files at a time.
    """
    sinks = sinks or parquet_sinks(table_root)
    decoded = keep_raw_of_rejects(decode_routing(wire, keep_raw=True), ROUTING_REQUIRED)
    rules = rules or [route_flap_rule(), as_hijack_rule()]
    outputs = _stateless_outputs(sinks, "routing_events", "routing_rejects", routing_events, ROUTING_REQUIRED)
    outputs |= _event_outputs(rules, "bgp_alerts", sinks, clock)
    queries = []
    if staging:
        decoded, queries = _decode_once(decoded, staging, "routing_decoded", checkpoint_root, trigger, files_per_trigger)

    def decode(fields):
        return decoded.drop("raw_value") if staging else decode_routing(wire, fields=fields)

    queries += [start_query(decoded, FanOutSink(outputs), os.path.join(checkpoint_root, "routing_stateless"),
                           "append", "routing_stateless", trigger)]
    queries += _start_metrics(metrics, decode, sinks, checkpoint_root, trigger)
    return queries + _start_windowed(
        [r for r in rules if isinstance(r, WindowRule)], decode,
        fused_routing_alerts if fuse_windowed else None, "bgp_windowed", "bgp_alerts", sinks,
        checkpoint_root, clock, trigger)


def start_lookup_monitor(wire: DataFrame, table_root: str | None, checkpoint_root: str,
                         clock: str | Column | None = None,
                         trigger: Mapping[str, object] | None = None,
                         rules: list[WindowRule | EventRule] | None = None,
                         fuse_windowed: bool = False,
                         sinks: SinkFactory | None = None,
                         metrics: MetricSet | None = None,
                         staging: str | None = None,
                         files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Archive (+ dead letters), tunneling, the windowed lookup rules, and
    metrics on request (``metrics=lookup_metrics()``).

    Tables: ``dns_events``, ``dns_rejects`` and ``dns_alerts``; parquet below
    ``table_root`` unless ``sinks`` makes others. The stateless outputs
    (archive, rejects and every per-event rule) share one query and one read
    of the source; each windowed rule is its own stateful query, or with
    ``fuse_windowed`` all of them are one query (writer ``dns_windowed``),
    and rules that cannot be fused raise; see ``fused_window_alerts``.
    ``staging`` (table ``dns_decoded``) is as in ``start_routing_monitor``.
    """
    sinks = sinks or parquet_sinks(table_root)
    decoded = keep_raw_of_rejects(decode_lookups(wire, keep_raw=True), LOOKUP_REQUIRED)
    rules = rules or [nxdomain_storm_rule(), dns_tunneling_rule(), amplification_rule()]
    outputs = _stateless_outputs(sinks, "dns_events", "dns_rejects", dns_events, LOOKUP_REQUIRED)
    outputs |= _event_outputs(rules, "dns_alerts", sinks, clock)
    queries = []
    if staging:
        decoded, queries = _decode_once(decoded, staging, "dns_decoded", checkpoint_root, trigger, files_per_trigger)

    def decode(fields):
        return decoded.drop("raw_value") if staging else decode_lookups(wire, fields=fields)

    queries += [start_query(decoded, FanOutSink(outputs),
                           os.path.join(checkpoint_root, "dns_stateless"),
                           "append", "dns_stateless", trigger)]
    queries += _start_metrics(metrics, decode, sinks, checkpoint_root, trigger)
    return queries + _start_windowed(
        [r for r in rules if isinstance(r, WindowRule)], decode,
        fused_window_alerts if fuse_windowed else None, "dns_windowed", "dns_alerts", sinks,
        checkpoint_root, clock, trigger)


def await_any(spark: SparkSession, queries: list[StreamingQuery],
              timeout: float | None = None, poll_seconds: float = 1.0) -> None:
    """Block until one of ``queries`` ends (or ``timeout``), then stop the
    others.

    Only the given queries count, not others of the session. A failed
    query's exception is raised; its batch was not committed, so a restart
    from the same checkpoints re-reads it.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while all(q.isActive for q in queries):
            if deadline is not None and time.monotonic() >= deadline:
                return
            queries[0].awaitTermination(poll_seconds)
        for q in queries:
            if not q.isActive and q.exception() is not None:
                raise q.exception()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def run_until_drained(queries: list[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries to finish; raise the first error."""
    for q in queries:
        q.awaitTermination()
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"query {q.name} failed: {q.exception()}")


class ProgressTotals(StreamingQueryListener):
    """Adds up the progress of every query of a session from its start: a
    query itself remembers only its last reports."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, dict[str, float]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _of(self, run: str) -> dict[str, float]:
        self._ended.setdefault(run, threading.Event())
        return self._totals.setdefault(run, {"batches": 0, "input_rows": 0, "rows_dropped_by_watermark": 0,
                                             "processed_rows_per_second": 0.0})

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = event.progress
        with self._lock:
            own = self._of(str(report.runId))
            own["batches"] += 1
            own["input_rows"] += report.numInputRows
            own["rows_dropped_by_watermark"] += sum(o.numRowsDroppedByWatermark for o in report.stateOperators)
            if report.numInputRows:
                own["processed_rows_per_second"] = max(own["processed_rows_per_second"], report.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._of(str(event.runId))
            self._ended[str(event.runId)].set()

    def summary(self, query: StreamingQuery, wait: float = 10.0) -> dict[str, float]:
        """Totals of this run of ``query``; of an ended one all of them
        (reports arrive a little after the query ends)."""
        run = str(query.runId)
        with self._lock:
            self._of(run)
        if not query.isActive:
            self._ended[run].wait(wait)
        with self._lock:
            return dict(self._of(run))


_totals: dict[str, ProgressTotals] = {}


def progress_totals(spark: SparkSession) -> ProgressTotals:
    """The session's listener, added at the first call."""
    key = spark._jsparkSession.sessionUUID()
    if key not in _totals:
        _totals[key] = ProgressTotals()
        spark.streams.addListener(_totals[key])
    return _totals[key]


def progress_summary(query: StreamingQuery) -> dict[str, float]:
    """Batches, rows in, late rows dropped and the best rate of one query
    since it was started by ``start_query`` in the active session."""
    return progress_totals(SparkSession.active()).summary(query)
