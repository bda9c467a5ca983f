"""DataFrame operators: rules, alert tables, archives, reports."""

from netwatch.operators.alerts import (
    bgp_alerts,
    current_alerts,
    dns_alerts,
    fused_window_alerts,
    latest_alerts,
    union_alerts,
    window_groups,
)
from netwatch.operators.archive import dns_events, routing_events
from netwatch.operators.enrich import enrich_lookups
from netwatch.operators.lists import hijack_by_table, known_prefix_hijack, not_listed, within_known
from netwatch.operators.metrics import (
    Measure,
    MetricSet,
    count_of,
    distinct_of,
    lookup_metrics,
    max_of,
    mean_of,
    routing_metrics,
    share_of,
)
from netwatch.operators.reports import event_series, read_table, recent_alerts, register_tables
from netwatch.operators.rules import (
    BGP,
    DNS,
    KNOWN_ORIGIN_AS,
    EventRule,
    WindowRule,
    amplification_rule,
    as_hijack_rule,
    dns_tunneling_rule,
    nxdomain_storm_rule,
    path_anomaly_rule,
    route_flap_rule,
)
from netwatch.operators.windows import windowed_counts

__all__ = [
    "BGP", "DNS", "KNOWN_ORIGIN_AS", "EventRule", "Measure", "MetricSet", "WindowRule",
    "amplification_rule", "as_hijack_rule", "bgp_alerts", "count_of", "current_alerts", "distinct_of", "dns_alerts",
    "dns_events", "dns_tunneling_rule", "enrich_lookups", "event_series", "fused_window_alerts",
    "hijack_by_table", "known_prefix_hijack", "lookup_metrics", "max_of", "mean_of", "not_listed",
    "path_anomaly_rule", "routing_metrics", "share_of", "within_known",
    "latest_alerts", "nxdomain_storm_rule", "read_table", "recent_alerts", "register_tables", "route_flap_rule",
    "routing_events", "union_alerts", "window_groups", "windowed_counts",
]
