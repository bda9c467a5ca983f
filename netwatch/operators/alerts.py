"""Alert tables: the union of the rules of one source.

Rules that read the same events with the same window are fused into one
aggregation with one exchange: the routing rules by turning each row into
one candidate per rule it matches, the windowed lookup rules by one
``count_if`` per rule, unpivoted afterwards. A union of separately planned
rules would scan and shuffle the source once per rule (Catalyst prunes each
branch to its own count, so the branches never share an exchange).
``bgp_alerts`` is then one scan; ``dns_alerts`` is two, one for the windowed
rules and one, without a shuffle, for the per-event rule. Streams keep one
query per rule unless asked to fuse (see ``netwatch.streaming``), because
fusing changes when a watermark moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch.functions.time import clock_as
from netwatch.operators.rules import (
    BGP,
    DNS,
    EventRule,
    WindowRule,
    amplification_rule,
    as_hijack_rule,
    dns_tunneling_rule,
    nxdomain_storm_rule,
    route_flap_rule,
    stream_time_ready,
)
from netwatch.operators.windows import window_column, windowed_counts
from netwatch.schemas import BGP_ALERT_COLUMNS, DNS_ALERT_COLUMNS


def union_alerts(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; duplicates are kept."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def fusable(rules: Sequence[WindowRule], streaming: bool) -> bool:
    """Whether rules can share one aggregation: same source and window, and
    the same keys (lookups) or keys among prefix and origin in a tumbling
    window (routing). On a stream also the same watermark and output mode;
    a batch has neither."""
    shared = {(r.kind, r.width, r.slide, r.time_column) for r in rules}
    if len(shared) != 1:
        return False
    if streaming and len({(r.watermark, r.output_mode) for r in rules}) != 1:
        return False
    if rules[0].kind == BGP:
        return rules[0].slide is None and all(
            tuple(r.keys) in (("prefix",), ("prefix", "origin_as")) for r in rules)
    return len({tuple(r.keys) for r in rules}) == 1


def _require_fusable(rules: Sequence[WindowRule], streaming: bool) -> None:
    if not fusable(rules, streaming):
        raise ValueError(
            f"rules {[r.name for r in rules]} cannot be fused: they need one source, window and "
            "time column, matching keys, and on a stream one watermark and output mode")


def bgp_alerts(
    routing: DataFrame,
    clock: str | Column | None = None,
    flap: WindowRule | None = None,
    hijack: WindowRule | None = None,
) -> DataFrame:
    """Route flaps and origin hijacks in one table."""
    rules = [flap or route_flap_rule(), hijack or as_hijack_rule()]
    if routing.isStreaming or not fusable(rules, False):
        return union_alerts([r.apply(routing, clock) for r in rules])
    return fused_routing_alerts(routing, rules, clock)


def fused_routing_alerts(
    routing: DataFrame,
    rules: Sequence[WindowRule],
    clock: str | Column | None = None,
) -> DataFrame:
    """Alerts of several routing rules from one aggregation.

    A row becomes one candidate (rule, prefix, origin or NULL) for every
    rule it matches and none for the others, so the exchange carries only
    groups that some rule counts: as many as the rules' own exchanges
    together. On a stream it is one stateful query; its watermark follows
    the rows of any of the rules.
    """
    _require_fusable(rules, routing.isStreaming)
    routing = stream_time_ready(routing, rules[0].time_column)
    detected_at = clock_as(clock, routing, rules[0].time_column)
    counted = window_groups(routing, rules)

    def of_rule(values: Sequence) -> Column:
        """The value of the row's rule."""
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule") + 1)

    return counted.filter(F.col("event_count") > of_rule([r.threshold or 0 for r in rules])).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "prefix", F.col("origin").alias("origin_as"), "event_count",
        of_rule([r.alert_type for r in rules]).alias("alert_type"),
        of_rule([r.severity for r in rules]).alias("severity"),
        detected_at.alias("detected_at"),
    )


def window_groups(routing: DataFrame, rules: Sequence[WindowRule]) -> DataFrame:
    """window, prefix, rule (its place in ``rules``), origin, event_count:
    the groups that fused routing rules count, before their thresholds."""
    first = rules[0]
    matched = rules[0].predicate()
    for rule in rules[1:]:
        matched = matched | rule.predicate()
    rows = routing.filter(matched)
    if routing.isStreaming:
        rows = rows.withWatermark(first.time_column, first.watermark)
    candidates = F.array(*[
        F.when(r.predicate(), F.struct(
            F.lit(i).alias("rule"),
            (F.col("origin_as") if "origin_as" in r.keys else F.lit(None)).cast("int").alias("origin")))
        for i, r in enumerate(rules)])
    rows = rows.select(
        window_column(first.time_column, first.width, None).alias("window"), "prefix",
        F.inline(F.filter(candidates, lambda c: c.isNotNull())))
    return rows.groupBy("window", "prefix", "rule", "origin").agg(F.count("*").alias("event_count"))


def fused_window_alerts(
    lookups: DataFrame,
    rules: Sequence[WindowRule],
    clock: str | Column | None = None,
) -> DataFrame:
    """Several windowed DNS rules with the same keys and window, counted in
    one aggregation (one ``count_if`` per rule) and unpivoted to one alert
    row per rule over its own threshold.

    On a stream this is one stateful query instead of one per rule: the
    source is read once and one state store holds all counts. The shared
    watermark then follows the rows of every fused rule, so the windows
    closing at the very end of a stream, and the rows dropped as late, can
    differ from separate queries, and in update mode a window is re-emitted
    when any of its counts grows. ``current_alerts`` reads both to the same
    final state.
    """
    _require_fusable(rules, lookups.isStreaming)
    first = rules[0]
    lookups = stream_time_ready(lookups, first.time_column)
    detected_at = clock_as(clock, lookups, first.time_column)
    preds = [r.predicate() for r in rules]
    any_match = preds[0]
    for p in preds[1:]:
        any_match = any_match | p
    rows = lookups.filter(any_match)
    if lookups.isStreaming:
        rows = rows.withWatermark(first.time_column, first.watermark)
    counts = windowed_counts(rows, first.time_column, first.keys, first.width, first.slide,
                             counts={f"c{i}": p for i, p in enumerate(preds)})
    # Unpivot the per-rule counts to one candidate row per rule, then apply
    # each rule's own threshold.
    candidates = F.array(*[
        F.struct(F.lit(r.alert_type).alias("alert_type"),
                 F.lit(r.severity).alias("severity"),
                 F.col(f"c{i}").alias("event_count"),
                 F.lit(r.threshold or 0).alias("threshold"))
        for i, r in enumerate(rules)])
    stacked = (counts.select("window_start", "window_end", *first.keys, F.inline(candidates))
               .filter(F.col("event_count") > F.col("threshold")))
    return stacked.select(
        "window_start", "window_end", "source_ip",
        F.col("event_count").cast("long").alias("event_count"),
        "alert_type", "severity", detected_at.alias("detected_at"))


def dns_alerts(
    lookups: DataFrame,
    clock: str | Column | None = None,
    storm: WindowRule | None = None,
    amplification: WindowRule | None = None,
    tunneling: EventRule | None = None,
) -> DataFrame:
    """NXDOMAIN storms, tunneling and amplification in one table."""
    storm = storm or nxdomain_storm_rule()
    amplification = amplification or amplification_rule()
    tunneling = tunneling or dns_tunneling_rule()
    windowed = [storm, amplification]
    if lookups.isStreaming or not fusable(windowed, False):
        return union_alerts([r.apply(lookups, clock) for r in windowed]
                            + [tunneling.apply(lookups, clock)])
    return union_alerts([fused_window_alerts(lookups, windowed, clock),
                         tunneling.apply(lookups, clock)]).select(*DNS_ALERT_COLUMNS)


def latest_alerts(history: DataFrame, kind: str) -> DataFrame:
    """Current state of update-mode alerts.

    An update-mode rule re-emits a window each time its count grows, and
    the sink appends every emission. This keeps, per (alert_type, window,
    key), the row detected last; the history stays untouched. Batch ids
    order the emissions of one run only, so they decide among rows of one
    detection time and run (of several runs, the last by name).
    """
    keys = ["alert_type", "window_start", "window_end"]
    keys += ["prefix", "origin_as"] if kind == BGP else ["source_ip"]
    columns = BGP_ALERT_COLUMNS if kind == BGP else DNS_ALERT_COLUMNS
    rest = [c for c in columns if c not in keys]
    latest = history.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct("detected_at", "run", "batch_id")).alias("latest"))
    return latest.select(*keys, "latest.*").select(*columns)


def current_alerts(table: DataFrame, kind: str) -> DataFrame:
    """An alert table as a reader wants it.

    Rows written by update-mode queries (the ``mode`` folder says so) are
    reduced to the latest per key; rows of append-mode queries, which emit
    an alert once, are taken as they are. Bookkeeping columns are dropped.
    """
    columns = BGP_ALERT_COLUMNS if kind == BGP else DNS_ALERT_COLUMNS
    updated = F.col("mode") == "update"
    return union_alerts([
        table.filter(~updated).select(*columns),
        latest_alerts(table.filter(updated), kind),
    ])


__all__ = ["bgp_alerts", "current_alerts", "dns_alerts", "fusable", "fused_routing_alerts",
           "fused_window_alerts", "latest_alerts", "union_alerts", "window_groups", "DNS"]
