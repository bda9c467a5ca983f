"""Registered queries: each takes (spark, table_dir) and returns a DataFrame.

Batch queries read the driver's tables and derive routing / lookup events
from ``events`` (``netwatch.sources.fixtures``). ``stream_*`` queries encode
those events as wire frames, run the real streaming job over them as a file
stream (``availableNow``), and return the sink table read back; the work is
written below the session's shared folder. Detection times use the fixed
clock ``CLOCK`` so results are reproducible.
"""

from __future__ import annotations

import datetime
import functools
import os
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from netwatch.functions.strings import name_length, shannon_entropy
from netwatch.functions.hashing import pseudonymise
from netwatch.functions.time import utc_instant, utc_wall_clock
from netwatch.operators import (
    BGP,
    DNS,
    amplification_rule,
    as_hijack_rule,
    bgp_alerts,
    current_alerts,
    dns_alerts,
    dns_events,
    dns_tunneling_rule,
    event_series,
    hijack_by_table,
    known_prefix_hijack,
    latest_alerts,
    lookup_metrics,
    nxdomain_storm_rule,
    not_listed,
    path_anomaly_rule,
    read_table,
    recent_alerts,
    route_flap_rule,
    routing_events,
    routing_metrics,
    union_alerts,
    within_known,
)
from netwatch.plans import CLOCK
from netwatch.schemas import DNS_ALERTS_SCHEMA, DNS_EVENTS_SCHEMA, SINK_PARTITIONS, TABLE_SCHEMAS
from netwatch.session import fresh_dir, remove_dir
from netwatch.sources import (
    ROUTING_REQUIRED,
    allowed_origins_fixture,
    decode_lookups,
    decode_routing,
    known_prefix_fixture,
    load_table,
    lookup_fixture,
    lookup_wire,
    page_hosts,
    routing_fixture,
    routing_wire,
    split_rejects,
    wire_file_stream,
)
from netwatch.streaming.rolling import latest_alerts_view, series_view
from netwatch.streaming.committed import CommittedBatchSink, compact_days, vacuum
from netwatch.streaming.runner import (
    await_any,
    progress_summary,
    run_until_drained,
    start_lookup_monitor,
    start_query,
    start_routing_monitor,
    start_rule,
)
from netwatch.streaming.sinks import FanOutSink, ParquetBatchSink

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, root: str) -> DataFrame:
    return load_table(spark, root, "events")


def _routing(spark: SparkSession, root: str) -> DataFrame:
    return routing_fixture(_events(spark, root))


def _lookups(spark: SparkSession, root: str) -> DataFrame:
    return lookup_fixture(_events(spark, root))


def _wall_clock(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall clock, so streamed tables compare with batch ones."""
    return df.withColumns({f.name: utc_wall_clock(f.name) for f in df.schema.fields
                           if isinstance(f.dataType, TimestampType)})


# -- batch rules ---------------------------------------------------------------

def q_route_flap(spark, root):
    return route_flap_rule().apply(_routing(spark, root), CLOCK)


def q_as_hijack(spark, root):
    return as_hijack_rule().apply(_routing(spark, root), CLOCK)


def q_nxdomain_storm(spark, root):
    return nxdomain_storm_rule().apply(_lookups(spark, root), CLOCK)


def q_amplification(spark, root):
    return amplification_rule().apply(_lookups(spark, root), CLOCK)


def q_dns_tunneling(spark, root):
    return dns_tunneling_rule().apply(_lookups(spark, root), CLOCK)


def q_bgp_alerts(spark, root):
    return bgp_alerts(_routing(spark, root), CLOCK)


def q_dns_alerts(spark, root):
    return dns_alerts(_lookups(spark, root), CLOCK)


def _known(spark: SparkSession, root: str) -> DataFrame:
    return known_prefix_fixture(load_table(spark, root, "supplier"))


def _allowed(spark: SparkSession, root: str) -> DataFrame:
    return allowed_origins_fixture(load_table(spark, root, "nation"))


def q_known_prefix_hijack(spark, root):
    return known_prefix_hijack(_routing(spark, root), _known(spark, root), CLOCK)


def q_as_hijack_table(spark, root):
    return hijack_by_table(_routing(spark, root), _allowed(spark, root), CLOCK)


def q_path_anomaly(spark, root):
    return path_anomaly_rule().apply(_routing(spark, root), CLOCK)


LOOKUP_METRICS = lookup_metrics(width="10 seconds")


def q_windowed_metrics(spark, root):
    """Both metric sets; each is one aggregation of its source."""
    return union_alerts([routing_metrics().apply(_routing(spark, root)),
                         LOOKUP_METRICS.apply(_lookups(spark, root))])


# -- archives and reports ---------------------------------------------------------

def q_archive_routing_events(spark, root):
    return routing_events(_routing(spark, root))


def q_archive_dns_events(spark, root):
    return dns_events(_lookups(spark, root))


def q_bgp_events_series(spark, root):
    return event_series(routing_events(_routing(spark, root)))


def q_dns_events_series(spark, root):
    return event_series(dns_events(_lookups(spark, root)))


def q_order_date_series(spark, root):
    return event_series(load_table(spark, root, "orders"), "o_orderdate")


# A windowed alert is detected when its window ends, a per-event one at its
# event, as a monitor that keeps up would see them.

def q_recent_bgp_alerts(spark, root):
    routing = _routing(spark, root)
    ends = utc_instant("window_end")
    return recent_alerts(union_alerts([route_flap_rule().apply(routing, ends),
                                       as_hijack_rule().apply(routing, ends)]), BGP)


def q_recent_dns_alerts(spark, root):
    lookups = _lookups(spark, root)
    ends = utc_instant("window_end")
    return recent_alerts(union_alerts([nxdomain_storm_rule().apply(lookups, ends),
                                       amplification_rule().apply(lookups, ends),
                                       dns_tunneling_rule().apply(lookups, utc_instant("event_time"))]), DNS)


# -- decoding and enrichment ------------------------------------------------------

def q_decode_bgp(spark, root):
    decoded = decode_routing(routing_wire(_routing(spark, root)))
    return _wall_clock(decoded.drop("kafka_ts"))


def q_decode_bgp_typed(spark, root):
    """Typed-list decode; the arrays are shown as their elements joined by
    ',' so the result compares as flat values."""
    decoded = decode_routing(routing_wire(_routing(spark, root)), typed_lists=True,
                             event_time="payload")
    return _wall_clock(decoded.drop("kafka_ts")).withColumns({
        "as_path": F.array_join(F.col("as_path").cast("array<string>"), ","),
        "communities": F.array_join("communities", ","),
    })


def q_decode_dns(spark, root):
    decoded = decode_lookups(lookup_wire(_lookups(spark, root)))
    return _wall_clock(decoded)


def q_decode_rejects(spark, root):
    """Dead letters of routing frames of which one in ten is no record and
    one in ten lacks its prefix."""
    routing = _routing(spark, root)
    kind = F.col("event_id") % 10
    sound = routing_wire(routing.filter(~kind.isin(3, 7)))
    damaged = routing.filter(kind.isin(3, 7)).select(
        F.lit(None).cast("binary").alias("key"),
        F.when(kind == 3, F.concat(F.lit("broken "), F.col("event_id").cast("string")))
        .otherwise(F.to_json(F.struct("event_type", "med"))).cast("binary").alias("value"),
        F.lit("bgp_raw_events").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").cast("long").alias("offset"), utc_instant("event_time").alias("timestamp"),
        F.lit(0).alias("timestampType"))
    decoded = decode_routing(sound.unionByName(damaged), keep_raw=True)
    return _wall_clock(split_rejects(decoded, ROUTING_REQUIRED)[1].select("raw_value", "reject_reason", "event_time"))


def q_domain_entropy(spark, root):
    lookups = lookup_fixture(_events(spark, root), enrich=False)
    return lookups.select("event_id", "queried_domain",
                          shannon_entropy("queried_domain").alias("entropy"))


def q_domain_length(spark, root):
    lookups = lookup_fixture(_events(spark, root), enrich=False)
    return lookups.select("event_id", "queried_domain",
                          name_length("queried_domain").alias("domain_length"))


def q_pseudonymise_ip(spark, root):
    events = _events(spark, root)
    client = F.expr("concat('192.168.', cast((user_id div 250) % 256 AS string), '.', "
                    "cast(user_id % 250 + 1 AS string))")
    return events.select("event_id", "user_id", pseudonymise(client).alias("source_ip"))


def q_page_host_entropy(spark, root):
    hosts = page_hosts(load_table(spark, root, "pages"))
    return hosts.select("page_id", "host", name_length("host").alias("host_length"),
                        shannon_entropy("host").alias("entropy"))


# -- streams ----------------------------------------------------------------------

# Seconds each call spent on writing its test frames (see bench.py).
STAGING_SECONDS: list[float] = []
SLICES = 4
FILES_PER_SLICE = 4


def _spread(events: DataFrame) -> DataFrame:
    """Events dealt to all cores: a few MB of them are one split, but many
    times that as frames, and most of the time goes into making these."""
    cores = events.sparkSession.sparkContext.defaultParallelism
    return events if events.rdd.getNumPartitions() >= cores else events.repartition(cores)


def _stage_wire(frames: DataFrame, run: str) -> str:
    path = os.path.join(run, "wire")
    began = time.perf_counter()
    frames.write.mode("overwrite").parquet(path)
    STAGING_SECONDS.append(time.perf_counter() - began)
    return path


def _stage_slices(frames: DataFrame, run: str, order: Sequence[int]) -> str:
    """Frames cut by time into ``SLICES`` equal spans, written one after the
    other in ``order``, each as ``FILES_PER_SLICE`` files: a file stream that
    reads so many files per trigger gets a slice per batch. Frames are made
    once, into a folder per slice; the files of a slice come from there."""
    path, made = os.path.join(run, "wire"), os.path.join(run, "frames")
    began = time.perf_counter()
    at = F.unix_micros("timestamp")
    low, high = frames.agg(F.min(at), F.max(at)).first()
    starts = [low + (high - low) * i // SLICES for i in range(1, SLICES)]
    slice_ = sum(((at >= start).cast("int") for start in starts), F.lit(0))
    frames.filter(at.isNotNull()).withColumn("slice", slice_).write.partitionBy("slice").parquet(made)
    kept = frames.sparkSession.read.schema(StructType([*frames.schema.fields, StructField("slice", IntegerType())])).parquet(made)
    for k in order:
        part = kept.filter(F.col("slice") == k).drop("slice")
        part.repartitionByRange(FILES_PER_SLICE, "offset").write.mode("append").parquet(path)
    remove_dir(frames.sparkSession, made)
    STAGING_SECONDS.append(time.perf_counter() - began)
    return path


def _run_stream(spark, root, kind, build, order=None, join=None, view=None, sink_of=ParquetBatchSink):
    """Stage the wire frames (in time slices when ``order`` is given), run
    ``build(decoded) -> (frame, mode, name)`` to completion with
    availableNow, and read its table back. ``join`` is applied to every
    micro-batch and may add ``known_prefix``. ``view(run folder, table path)``
    is returned in place of the table. Returns table and query; the
    staged frames and the checkpoint are removed."""
    run = fresh_dir(spark, "runs")
    events = _spread(_events(spark, root))
    frames = routing_wire(routing_fixture(events)) if kind == BGP else lookup_wire(lookup_fixture(events))
    wire_path = _stage_wire(frames, run) if order is None else _stage_slices(frames, run, order)
    stream = wire_file_stream(spark, wire_path, FILES_PER_SLICE if order else None)
    frame, mode, name = build(decode_routing(stream) if kind == BGP else decode_lookups(stream))
    table, checkpoint = os.path.join(run, "table"), os.path.join(run, "checkpoint")
    sink = sink_of(table, name, mode=mode, cache=join is None)
    schema = frame.schema
    if join is not None:
        schema = StructType([*schema.fields, StructField("known_prefix", StringType())])
        sink = FanOutSink({name: (join, sink)})
    query = start_query(frame, sink, checkpoint, mode, None, {"availableNow": True})
    run_until_drained([query])
    for path in (wire_path, checkpoint):
        remove_dir(spark, path)
    rows = read_table(spark, table, schema)
    return (rows, query) if view is None else (view(run, table), query)


def _plain(table: DataFrame) -> DataFrame:
    return _wall_clock(table.drop(*(name for name, _ in SINK_PARTITIONS)))


def _rule_stream(rule, kind, latest=False):
    def query(spark, root):
        history, _ = _run_stream(spark, root, kind,
                                 lambda d: (rule.apply(d, CLOCK), rule.output_mode, rule.name))
        return _wall_clock(latest_alerts(history, kind)) if latest else _plain(history)
    return query


def q_stream_nxdomain_history(spark, root):
    """Every emission of an update-mode rule over several data batches."""
    rule = nxdomain_storm_rule(threshold=3)
    history, _ = _run_stream(spark, root, DNS, lambda d: (rule.apply(d, CLOCK), rule.output_mode, rule.name),
                             order=range(SLICES))
    return _plain(history)


def _rolled(spark, view):
    """Settled batches folded into the state, the newest read on top."""
    if not view.advance(spark):
        raise RuntimeError("no settled batch")
    return _wall_clock(view.read(spark))


def q_stream_latest_snapshot(spark, root):
    """The latest row per alert from a state that is carried along."""
    rule = nxdomain_storm_rule(threshold=3)
    rows, _ = _run_stream(
        spark, root, DNS, lambda d: (rule.apply(d, CLOCK), rule.output_mode, rule.name), order=range(SLICES),
        view=lambda run, table: _rolled(spark, latest_alerts_view(table, DNS_ALERTS_SCHEMA, os.path.join(run, "state"), DNS)))
    return rows.drop("run", "batch_id")


def q_stream_series_rollup(spark, root):
    """Events per timestamp from partial counts; the first slice comes last."""
    return _run_stream(
        spark, root, DNS, lambda d: (dns_events(d), "append", "archive"), order=[*range(1, SLICES), 0],
        view=lambda run, table: _rolled(spark, series_view(table, DNS_EVENTS_SCHEMA, os.path.join(run, "state"))))[0]


def q_stream_late_rows(spark, root):
    """The first slice arrives last: the rule drops its groups behind the
    watermark. ``late_groups`` is how many it dropped."""
    rule = route_flap_rule()
    table, query = _run_stream(spark, root, BGP, lambda d: (rule.apply(d, CLOCK), rule.output_mode, rule.name),
                               order=[*range(1, SLICES), 0])
    dropped = int(progress_summary(query)["rows_dropped_by_watermark"])
    return _plain(table).withColumn("late_groups", F.lit(dropped).cast("long"))


def q_stream_known_prefix_hijack(spark, root):
    """The join in the micro-batch; the registry is read by every batch."""
    return _plain(_run_stream(
        spark, root, BGP, lambda d: (as_hijack_rule().apply(d, CLOCK), "append", "known_prefix"),
        join=lambda alerts: within_known(alerts, _known(alerts.sparkSession, root)))[0])


def q_stream_as_hijack_table(spark, root):
    """Every announced origin is counted; each batch is held against the
    allow-list as it is then."""
    table = _run_stream(
        spark, root, BGP, lambda d: (as_hijack_rule(()).apply(d, CLOCK), "append", "as_hijack"),
        join=lambda alerts: not_listed(alerts, _allowed(alerts.sparkSession, root), "origin_as"))[0]
    return _plain(table).drop("known_prefix")


def q_stream_windowed_metrics(spark, root):
    return _plain(_run_stream(spark, root, DNS, lambda d: (LOOKUP_METRICS.apply(d), "append", "metrics"))[0])


def q_stream_path_anomaly(spark, root):
    """A routing monitor with a per-event rule among the windowed ones and a
    metrics query next to them; its alert table."""
    return _monitor_alerts(BGP, rules=[route_flap_rule(), path_anomaly_rule()], metrics=routing_metrics())(spark, root)


def q_stream_archive(spark, root):
    return _plain(_run_stream(spark, root, BGP, lambda d: (routing_events(d), "append", "archive"))[0])


def q_stream_dns_archive(spark, root):
    return _plain(_run_stream(spark, root, DNS, lambda d: (dns_events(d), "append", "archive"))[0])


def q_stream_committed_archive(spark, root):
    """Batches that count once they are listed; the settled ones compacted
    into days, the newest read as it is."""
    def upkeep(run, table):
        last = read_table(spark, table, DNS_EVENTS_SCHEMA).agg(F.max("event_date")).first()[0]
        for _ in range(2):
            compact_days(spark, table, DNS_EVENTS_SCHEMA, last or datetime.date.max)
        vacuum(spark, table)
        return _plain(read_table(spark, table, DNS_EVENTS_SCHEMA))

    return _run_stream(spark, root, DNS, lambda d: (dns_events(d), "append", "archive"), order=range(SLICES), view=upkeep,
                       sink_of=functools.partial(CommittedBatchSink, date_column="timestamp"))[0]


def q_stream_triggered_storm(spark, root):
    """The storm rule under a processing-time trigger; ``await_any`` sees its
    end once all frames are through."""
    rule, run = nxdomain_storm_rule(), fresh_dir(spark, "runs")
    wire = _stage_wire(lookup_wire(_lookups(spark, root)), run)
    table, checkpoint = os.path.join(run, "table"), os.path.join(run, "checkpoint")
    query = start_rule(decode_lookups(wire_file_stream(spark, wire)), rule,
                       ParquetBatchSink(table, rule.name, mode=rule.output_mode), checkpoint, CLOCK,
                       {"processingTime": "1 second"})
    query.processAllAvailable()
    query.stop()
    await_any(spark, [query])
    for path in (wire, checkpoint):
        remove_dir(spark, path)
    return _wall_clock(latest_alerts(read_table(spark, table, DNS_ALERTS_SCHEMA), DNS))


def _monitor_alerts(kind, fuse_windowed=False, rules=None, metrics=None, staged=False):
    """Run the whole monitor of one source (all of its streaming queries in
    one session) and read its alert table back as current alerts."""
    def query(spark, root):
        run = fresh_dir(spark, "runs")
        once = {"availableNow": True}
        tables, checkpoints = os.path.join(run, "tables"), os.path.join(run, "checkpoints")
        if kind == BGP:
            wire, start, name = routing_wire(_routing(spark, root)), start_routing_monitor, "bgp_alerts"
        else:
            wire, start, name = lookup_wire(_lookups(spark, root)), start_lookup_monitor, "dns_alerts"
        wire = _stage_wire(wire, run)
        run_until_drained(start(wire_file_stream(spark, wire), tables, checkpoints, CLOCK, once,
                                rules=rules, fuse_windowed=fuse_windowed, metrics=metrics,
                                staging=os.path.join(run, "staged") if staged else None))
        for path in (wire, checkpoints, os.path.join(run, "staged")):
            remove_dir(spark, path)
        return _wall_clock(current_alerts(
            read_table(spark, os.path.join(tables, name), TABLE_SCHEMAS[name]), kind))
    return query


QUERIES: dict[str, Query] = {
    "route_flap": q_route_flap,
    "as_hijack": q_as_hijack,
    "nxdomain_storm": q_nxdomain_storm,
    "amplification": q_amplification,
    "dns_tunneling": q_dns_tunneling,
    "known_prefix_hijack": q_known_prefix_hijack,
    "as_hijack_table": q_as_hijack_table,
    "path_anomaly": q_path_anomaly,
    "windowed_metrics": q_windowed_metrics,
    "bgp_alerts": q_bgp_alerts,
    "dns_alerts": q_dns_alerts,
    "archive_routing_events": q_archive_routing_events,
    "archive_dns_events": q_archive_dns_events,
    "bgp_events_series": q_bgp_events_series,
    "dns_events_series": q_dns_events_series,
    "order_date_series": q_order_date_series,
    "recent_bgp_alerts": q_recent_bgp_alerts,
    "recent_dns_alerts": q_recent_dns_alerts,
    "decode_bgp": q_decode_bgp,
    "decode_bgp_typed": q_decode_bgp_typed,
    "decode_dns": q_decode_dns,
    "decode_rejects": q_decode_rejects,
    "domain_entropy": q_domain_entropy,
    "domain_length": q_domain_length,
    "pseudonymise_ip": q_pseudonymise_ip,
    "page_host_entropy": q_page_host_entropy,
    "stream_route_flap": _rule_stream(route_flap_rule(), BGP),
    "stream_as_hijack": _rule_stream(as_hijack_rule(), BGP),
    "stream_nxdomain_storm": _rule_stream(nxdomain_storm_rule(), DNS, latest=True),
    "stream_amplification": _rule_stream(amplification_rule(), DNS, latest=True),
    "stream_dns_tunneling": _rule_stream(dns_tunneling_rule(), DNS),
    "stream_known_prefix_hijack": q_stream_known_prefix_hijack,
    "stream_as_hijack_table": q_stream_as_hijack_table,
    "stream_windowed_metrics": q_stream_windowed_metrics,
    "stream_path_anomaly": q_stream_path_anomaly,
    "stream_bgp_alerts": _monitor_alerts(BGP),
    "stream_bgp_alerts_staged": _monitor_alerts(BGP, staged=True),
    "stream_bgp_alerts_fused": _monitor_alerts(BGP, fuse_windowed=True),
    "stream_dns_alerts": _monitor_alerts(DNS),
    "stream_dns_alerts_staged": _monitor_alerts(DNS, staged=True),
    "stream_triggered_storm": q_stream_triggered_storm,
    "stream_dns_alerts_fused": _monitor_alerts(DNS, fuse_windowed=True),
    "stream_nxdomain_history": q_stream_nxdomain_history,
    "stream_latest_snapshot": q_stream_latest_snapshot,
    "stream_series_rollup": q_stream_series_rollup,
    "stream_late_rows": q_stream_late_rows,
    "stream_archive": q_stream_archive,
    "stream_dns_archive": q_stream_dns_archive,
    "stream_committed_archive": q_stream_committed_archive,
}
