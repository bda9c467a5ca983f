"""DuckDB SQL for every registered query: the independent check.

Each statement reads only the base tables and uses nothing of the library.
The event views are written again in DuckDB's dialect (integer microsecond
arithmetic for time, explicit epoch-aligned window starts instead of a
window function), so a mistake in the Spark code does not carry over into
its check.
"""

from __future__ import annotations

# Stated again here, not imported: a slip in the library's own values must
# show as a difference. Fixed values, in their natural order.
CLOCK = "2024-02-01 00:00:00"
KNOWN_ORIGIN_AS = (
    15169, 16509, 8075, 32934, 13335, 1299, 3356, 174, 2914, 7018,
    20940, 54113, 36040, 15133, 22822, 6939, 3257, 1273, 5511, 6453,
)
SIMULATED_AS = (15169, 32934, 16509, 8075, 13335, 20940, 1299, 3356, 6461, 2914, 7018, 3320, 5400, 12389, 9002)
SIMULATED_TTL = (60, 300, 3600, 86400)
ROUTING_TIME_FACTOR = 2592
LOOKUP_TIME_FACTOR = 25920
URL_HOST_PATTERN = '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)'

_T0_US = 1704067200000000  # 2024-01-01 00:00:00 UTC in microseconds
_CLOCK_SQL = f"TIMESTAMP '{CLOCK}'"
_AS_LIST = "[" + ",".join(str(a) for a in SIMULATED_AS) + "]"
_TTL_LIST = "[" + ",".join(str(t) for t in SIMULATED_TTL) + "]"
_KNOWN = ",".join(str(a) for a in KNOWN_ORIGIN_AS)


def _origin(expr: str) -> str:
    return f"cast({_AS_LIST}[cast({expr} AS int) + 1] AS int)"


BGP_FX = f"""bgp_fx AS (
  SELECT event_id,
         make_timestamp({_T0_US} + (epoch_us(ts) - {_T0_US}) // {ROUTING_TIME_FACTOR}) AS event_time,
         concat('10.', cast((event_id // 256) % 256 AS varchar), '.', cast(event_id % 256 AS varchar), '.1') AS router_id,
         {_origin('(event_id // 15) % 15')} AS peer_as,
         {_origin('event_id % 15')} AS origin_as,
         concat('10.', cast(user_id // 256 AS varchar), '.', cast(user_id % 256 AS varchar), '.0/24') AS prefix,
         CASE event_type WHEN 'click' THEN 'WITHDRAW' WHEN 'error' THEN 'PATH_CHANGE' ELSE 'ANNOUNCE' END AS event_type,
         CASE WHEN event_type = 'error'
              THEN concat('[', cast({_origin('event_id % 15')} AS varchar), ',', cast(60000 + event_id % 5001 AS varchar), ',', cast({_origin('(event_id // 15) % 15')} AS varchar), ']')
              ELSE concat('[', cast({_origin('event_id % 15')} AS varchar), ',', cast({_origin('(event_id // 15) % 15')} AS varchar), ']') END AS as_path,
         concat('192.168.', cast((event_id // 254) % 256 AS varchar), '.', cast(event_id % 254 + 1 AS varchar)) AS next_hop,
         cast(event_id % 1001 AS int) AS med,
         concat('["', cast(user_id % 65535 + 1 AS varchar), ':', cast(event_id % 65535 + 1 AS varchar), '"]') AS communities
  FROM events)"""

_DNS_BASE = f"""SELECT event_id,
         make_timestamp({_T0_US} + (epoch_us(ts) - {_T0_US}) // {LOOKUP_TIME_FACTOR}) AS event_time,
         concat('8.8.', cast(event_id % 2 AS varchar), '.', cast(event_id % 8 + 1 AS varchar)) AS resolver_ip,
         substr(sha256(concat('192.168.1.', cast(least(user_id % 8, (user_id // 8) % 8) AS varchar))), 1, 16) AS source_ip,
         CASE WHEN event_type = 'error' AND event_id % 2 = 0
              THEN concat(substr(sha256(cast(event_id AS varchar)), 1, cast(40 + event_id % 21 AS int)), '.evil.com')
              WHEN event_id % 3 = 0 THEN 'stackoverflow.com' ELSE 'google.com' END AS queried_domain,
         CASE event_type WHEN 'click' THEN 'TXT' WHEN 'purchase' THEN 'ANY' ELSE 'A' END AS query_type,
         CASE event_type WHEN 'error' THEN 'NXDOMAIN' ELSE 'NOERROR' END AS response_code,
         cast({_TTL_LIST}[cast(event_id % 4 AS int) + 1] AS int) AS ttl
  FROM events"""


def _entropy(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL OR length({col}) = 0 THEN 0.0 "
            f"ELSE round_even(list_entropy(string_split({col}, '')), 3) END")


DNS_FX = f"""dns_fx AS (
  SELECT event_id, event_time, resolver_ip, source_ip, queried_domain, query_type, response_code, ttl,
         cast(length(queried_domain) AS int) AS domain_length,
         {_entropy('queried_domain')} AS entropy
  FROM ({_DNS_BASE}))"""


def _bucket(col: str, seconds: int, back: str = "0") -> str:
    """Epoch-aligned start of the ``seconds``-wide bucket of ``col``,
    moved ``back`` buckets earlier."""
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({col}) // {us} - {back}) * {us})"


def _tumbling(name: str, where: str, keys: list[str], having: str | None,
              alert_type: str, severity: str) -> str:
    key_list = ", ".join(keys)
    origin = "origin_as" if "origin_as" in keys else "CAST(NULL AS INTEGER) AS origin_as"
    having_sql = f" HAVING count(*) > {having}" if having is not None else ""
    return f"""{name} AS (
  SELECT ws AS window_start, ws + INTERVAL 60 SECOND AS window_end, prefix, {origin},
         count(*) AS event_count, '{alert_type}' AS alert_type, '{severity}' AS severity,
         {_CLOCK_SQL} AS detected_at
  FROM (SELECT {_bucket('event_time', 60)} AS ws, {key_list} FROM bgp_fx WHERE {where})
  GROUP BY ws, {key_list}{having_sql})"""


def _sliding(name: str, where: str, threshold: int, alert_type: str, severity: str) -> str:
    # A row at t lies in the 30 s windows starting at its 10 s bucket and the
    # two buckets before it.
    return f"""{name} AS (
  SELECT ws AS window_start, ws + INTERVAL 30 SECOND AS window_end, source_ip,
         count(*) AS event_count, '{alert_type}' AS alert_type, '{severity}' AS severity,
         {_CLOCK_SQL} AS detected_at
  FROM (SELECT {_bucket('event_time', 10, 'k')} AS ws, source_ip
        FROM dns_fx, (VALUES (0), (1), (2)) AS shifts(k) WHERE {where})
  GROUP BY ws, source_ip HAVING count(*) > {threshold})"""


FLAP_WHERE = "event_type IN ('ANNOUNCE', 'WITHDRAW')"
HIJACK_WHERE = f"event_type = 'ANNOUNCE' AND origin_as NOT IN ({_KNOWN})"
STORM_WHERE = "response_code = 'NXDOMAIN'"
AMP_WHERE = "query_type IN ('ANY', 'TXT')"

FLAP = _tumbling("flap", FLAP_WHERE, ["prefix"], "5", "ROUTE_FLAP", "HIGH")
HIJACK = _tumbling("hijack", HIJACK_WHERE, ["prefix", "origin_as"], None, "BGP_HIJACK", "CRITICAL")
STORM = _sliding("storm", STORM_WHERE, 100, "NXDOMAIN_STORM", "HIGH")
AMP = _sliding("amp", AMP_WHERE, 50, "AMPLIFICATION", "MEDIUM")
TUNNEL = f"""tunnel AS (
  SELECT {_CLOCK_SQL} AS window_start, {_CLOCK_SQL} AS window_end, source_ip,
         CAST(1 AS BIGINT) AS event_count, 'DNS_TUNNELING' AS alert_type, 'CRITICAL' AS severity,
         {_CLOCK_SQL} AS detected_at
  FROM dns_fx WHERE domain_length > 50 OR entropy > 3.5)"""

BGP_ALERTS = f"""bgp_alerts AS (SELECT * FROM flap UNION ALL SELECT * FROM hijack)"""
DNS_ALERTS = f"""dns_alerts AS (SELECT * FROM storm UNION ALL SELECT * FROM tunnel UNION ALL SELECT * FROM amp)"""
ROUTING_EVENTS = """routing_events AS (
  SELECT event_time AS timestamp, router_id, peer_as, origin_as, prefix, event_type, next_hop, med FROM bgp_fx)"""
DNS_EVENTS = """dns_events AS (
  SELECT event_time AS timestamp, source_ip, resolver_ip, queried_domain, query_type, response_code,
         ttl, entropy, domain_length FROM dns_fx)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _iso(col: str) -> str:
    return f"concat(strftime({col}, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00')"


def _watermarked(alerts: str, where: str, delay_s: int) -> str:
    """Windows an append-mode stream has emitted after one batch and the
    closing no-data batch: those ending at or before the watermark, which
    is the latest matching event time minus the delay."""
    return (f"SELECT * FROM {alerts} WHERE window_end <= "
            f"(SELECT max(event_time) FROM bgp_fx WHERE {where}) - INTERVAL {delay_s} SECOND")


def _detected(alerts: str, at: str) -> str:
    """An alert table with detection times taken from a column."""
    return f"SELECT * REPLACE ({at} AS detected_at) FROM {alerts}"


TUNNEL_AT_EVENT = """SELECT event_time AS window_start, event_time AS window_end, source_ip,
         CAST(1 AS BIGINT) AS event_count, 'DNS_TUNNELING' AS alert_type, 'CRITICAL' AS severity,
         event_time AS detected_at
  FROM dns_fx WHERE domain_length > 50 OR entropy > 3.5"""


def _sliced(source: str) -> str:
    """The rows of a view with their slice: four equal spans of time."""
    return f"""sliced AS (
  SELECT f.*, (SELECT count(*) FROM (VALUES (1), (2), (3)) AS b(k)
               WHERE epoch_us(event_time) >= lo + (hi - lo) * k // 4) AS slice
  FROM {source} f, (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM {source}))"""


# Known blocks per supplier; a prefix lies in a block when the block is no
# longer and both agree in the block's leading bits. The longest wins.
KNOWN = """parts AS (
  SELECT known_prefix, cast(split_part(known_prefix, '/', 2) AS int) AS bits,
         list_reduce([cast(x AS bigint) FOR x IN string_split(split_part(known_prefix, '/', 1), '.')],
                     lambda a, b: a * 256 + b) AS address
  FROM (SELECT DISTINCT CASE s_suppkey % 4
          WHEN 0 THEN concat('10.0.', cast(s_suppkey % 256 AS varchar), '.0/24')
          WHEN 1 THEN concat('10.0.', cast((s_suppkey // 16) * 32 % 256 AS varchar), '.0/20')
          WHEN 2 THEN concat('10.0.', cast(s_suppkey % 256 AS varchar), '.0/25')
          ELSE concat('10.', cast(s_suppkey % 256 AS varchar), '.0.0/16') END AS known_prefix FROM supplier)),
announced AS (
  SELECT prefix, cast(split_part(prefix, '/', 2) AS int) AS own_bits,
         list_reduce([cast(x AS bigint) FOR x IN string_split(split_part(prefix, '/', 1), '.')],
                     lambda a, b: a * 256 + b) AS own_address
  FROM (SELECT DISTINCT prefix FROM bgp_fx)),
longest AS (
  SELECT prefix, arg_max(known_prefix, bits) AS known_prefix
  FROM announced JOIN parts ON bits <= own_bits AND own_address >> (32 - bits) = address >> (32 - bits)
  GROUP BY prefix)"""
_ALLOWED = f"(SELECT {_AS_LIST}[cast(n_nationkey % 15 AS int) + 1] FROM nation WHERE n_regionkey <= 2)"
TABLE_HIJACK = _tumbling("hijack", f"event_type = 'ANNOUNCE' AND origin_as NOT IN {_ALLOWED}", ["prefix", "origin_as"],
                         None, "BGP_HIJACK", "CRITICAL")
# The fixture writes the foreign AS between origin and peer, and the path is
# text; a number counts when it is on no list.
PATH = f"""path_anomaly AS (
  SELECT {_CLOCK_SQL} AS window_start, {_CLOCK_SQL} AS window_end, prefix, origin_as, CAST(1 AS BIGINT) AS event_count,
         'PATH_ANOMALY' AS alert_type, 'HIGH' AS severity, {_CLOCK_SQL} AS detected_at
  FROM bgp_fx WHERE len([x FOR x IN CAST(as_path AS INTEGER[]) IF x NOT IN ({", ".join(map(str, SIMULATED_AS))})]) > 0)"""


def _metrics(source: str, seconds: int, labels: str, measures: dict[str, str]) -> str:
    """One aggregate per window, one row per measure."""
    rows = ", ".join(f"{{'metric_type': '{name}', 'metric_value': CAST({value} AS DOUBLE)}}"
                     for name, value in measures.items())
    return f"""SELECT window_start, window_start + INTERVAL {seconds} SECOND AS window_end, m.metric_type, m.metric_value, labels
  FROM (SELECT window_start, labels, unnest([{rows}]) AS m
        FROM (SELECT *, {_bucket('event_time', seconds)} AS window_start, {labels} AS labels FROM {source})
        GROUP BY window_start, labels) WHERE m.metric_value IS NOT NULL"""


ROUTING_METRICS = _metrics("bgp_fx", 60, "'{}'", {
    "bgp_updates": "count(*)", "bgp_announcements": "count(*) FILTER (event_type = 'ANNOUNCE')",
    "bgp_withdrawals": "count(*) FILTER (event_type = 'WITHDRAW')",
    "bgp_path_changes": "count(*) FILTER (event_type = 'PATH_CHANGE')",
    "bgp_withdrawal_share": "count(*) FILTER (event_type = 'WITHDRAW')::DOUBLE / count(*)",
    "bgp_distinct_prefixes": "count(DISTINCT prefix)", "bgp_distinct_origins": "count(DISTINCT origin_as)",
    "bgp_distinct_routers": "count(DISTINCT router_id)"})
LOOKUP_METRICS = _metrics("dns_fx", 10, "concat('{\"resolver_ip\":\"', resolver_ip, '\"}')", {
    "dns_queries": "count(*)", "dns_nxdomain_share": "count(*) FILTER (response_code = 'NXDOMAIN')::DOUBLE / count(*)",
    "dns_any_txt_share": "count(*) FILTER (query_type IN ('ANY', 'TXT'))::DOUBLE / count(*)",
    "dns_distinct_sources": "count(DISTINCT source_ip)", "dns_distinct_names": "count(DISTINCT queried_domain)",
    "dns_max_entropy": "max(entropy)"})

SQL: dict[str, str] = {
    "known_prefix_hijack": _with(BGP_FX, HIJACK, KNOWN) + "SELECT * FROM hijack JOIN longest USING (prefix)",
    "as_hijack_table": _with(BGP_FX, TABLE_HIJACK) + "SELECT * FROM hijack",
    "path_anomaly": _with(BGP_FX, PATH) + "SELECT * FROM path_anomaly",
    "windowed_metrics": _with(BGP_FX, DNS_FX) + f"{ROUTING_METRICS} UNION ALL {LOOKUP_METRICS}",
    "stream_known_prefix_hijack": _with(BGP_FX, HIJACK, KNOWN)
    + "SELECT * FROM (" + _watermarked("hijack", HIJACK_WHERE, 30) + ") JOIN longest USING (prefix)",
    # Every announcement is counted, so every announcement moves the watermark.
    "stream_as_hijack_table": _with(BGP_FX, TABLE_HIJACK) + _watermarked("hijack", "event_type = 'ANNOUNCE'", 30),
    "stream_path_anomaly": _with(BGP_FX, FLAP, PATH)
    + _watermarked("flap", FLAP_WHERE, 30) + " UNION ALL SELECT * FROM path_anomaly",
    "stream_windowed_metrics": _with(DNS_FX) + f"SELECT * FROM ({LOOKUP_METRICS}) WHERE window_end <= "
    "(SELECT max(event_time) FROM dns_fx) - INTERVAL 15 SECOND",
    "route_flap": _with(BGP_FX, FLAP) + "SELECT * FROM flap",
    "as_hijack": _with(BGP_FX, HIJACK) + "SELECT * FROM hijack",
    "nxdomain_storm": _with(DNS_FX, STORM) + "SELECT * FROM storm",
    "amplification": _with(DNS_FX, AMP) + "SELECT * FROM amp",
    "dns_tunneling": _with(DNS_FX, TUNNEL) + "SELECT * FROM tunnel",
    "bgp_alerts": _with(BGP_FX, FLAP, HIJACK, BGP_ALERTS) + "SELECT * FROM bgp_alerts",
    "dns_alerts": _with(DNS_FX, STORM, AMP, TUNNEL, DNS_ALERTS) + "SELECT * FROM dns_alerts",
    "archive_routing_events": _with(BGP_FX, ROUTING_EVENTS) + "SELECT * FROM routing_events",
    "archive_dns_events": _with(DNS_FX, DNS_EVENTS) + "SELECT * FROM dns_events",
    "bgp_events_series": _with(BGP_FX, ROUTING_EVENTS)
    + "SELECT timestamp AS time, count(*) AS event_count FROM routing_events "
      "GROUP BY timestamp ORDER BY timestamp NULLS LAST",
    "dns_events_series": _with(DNS_FX, DNS_EVENTS)
    + "SELECT timestamp AS time, count(*) AS event_count FROM dns_events "
      "GROUP BY timestamp ORDER BY timestamp NULLS LAST",
    "order_date_series": "SELECT o_orderdate AS time, count(*) AS event_count FROM orders "
                         "GROUP BY o_orderdate ORDER BY o_orderdate NULLS LAST",
    "recent_bgp_alerts": _with(BGP_FX, FLAP, HIJACK)
    + "SELECT detected_at, alert_type, severity, prefix, origin_as, event_count FROM ("
    + _detected("flap", "window_end") + " UNION ALL " + _detected("hijack", "window_end")
    + ") ORDER BY detected_at DESC NULLS FIRST, window_start DESC NULLS FIRST, "
      "window_end DESC NULLS FIRST, alert_type ASC NULLS LAST, severity ASC NULLS LAST, "
      "prefix ASC NULLS LAST, origin_as ASC NULLS LAST, event_count DESC NULLS FIRST LIMIT 20",
    "recent_dns_alerts": _with(DNS_FX, STORM, AMP)
    + "SELECT detected_at, alert_type, severity, source_ip, event_count FROM ("
    + _detected("storm", "window_end") + " UNION ALL " + _detected("amp", "window_end")
    + " UNION ALL " + TUNNEL_AT_EVENT
    + ") ORDER BY detected_at DESC NULLS FIRST, window_start DESC NULLS FIRST, "
      "window_end DESC NULLS FIRST, alert_type ASC NULLS LAST, severity ASC NULLS LAST, "
      "source_ip ASC NULLS LAST, event_count DESC NULLS FIRST LIMIT 20",
    "decode_rejects": _with(BGP_FX)
    + "SELECT concat('broken ', event_id) AS raw_value, 'missing prefix,missing event_type' AS reject_reason, event_time "
      "FROM bgp_fx WHERE event_id % 10 = 3 UNION ALL "
      "SELECT concat('{\"event_type\":\"', event_type, '\",\"med\":', med, '}'), 'missing prefix', event_time "
      "FROM bgp_fx WHERE event_id % 10 = 7",
    "stream_latest_snapshot": _with(DNS_FX, _sliding("storm", STORM_WHERE, 3, "NXDOMAIN_STORM", "HIGH"))
    + "SELECT * FROM storm",
    "stream_series_rollup": _with(DNS_FX, DNS_EVENTS)
    + "SELECT timestamp AS time, count(*) AS event_count FROM dns_events GROUP BY timestamp",
    # Slice by slice, every window that gained rows and is over the
    # threshold is emitted with its count so far.
    "stream_nxdomain_history": _with(DNS_FX, _sliced("dns_fx"))
    + f"SELECT ws AS window_start, ws + INTERVAL 30 SECOND AS window_end, source_ip, event_count, "
      f"'NXDOMAIN_STORM' AS alert_type, 'HIGH' AS severity, {_CLOCK_SQL} AS detected_at FROM ("
      "SELECT ws, source_ip, slice, CAST(sum(n) OVER (PARTITION BY ws, source_ip ORDER BY slice) AS BIGINT) "
      "AS event_count FROM ("
      f"SELECT {_bucket('event_time', 10, 'k')} AS ws, source_ip, slice, count(*) AS n "
      f"FROM sliced, (VALUES (0), (1), (2)) AS shifts(k) WHERE {STORM_WHERE} GROUP BY ALL)) WHERE event_count > 3",
    # The first slice comes last: its groups are behind the watermark.
    "stream_late_rows": _with(BGP_FX, _sliced("bgp_fx"), f"late AS (SELECT count(*) AS late_groups FROM "
                              f"(SELECT DISTINCT {_bucket('event_time', 60)}, prefix FROM sliced "
                              f"WHERE slice = 0 AND {FLAP_WHERE}))",
                              _tumbling("flap", FLAP_WHERE, ["prefix"], "5", "ROUTE_FLAP", "HIGH")
                              .replace("FROM bgp_fx", "FROM sliced").replace("WHERE event_type", "WHERE slice > 0 AND event_type"))
    + "SELECT *, (SELECT late_groups FROM late) AS late_groups FROM ("
    + _watermarked("flap", FLAP_WHERE, 30) + ")",
    "decode_bgp": _with(BGP_FX)
    + f"SELECT {_iso('event_time')} AS timestamp, router_id, peer_as, origin_as, prefix, event_type, "
      "as_path, next_hop, med, communities, event_time FROM bgp_fx",
    "decode_bgp_typed": _with(BGP_FX)
    + f"SELECT {_iso('event_time')} AS timestamp, router_id, peer_as, origin_as, prefix, event_type, "
      "array_to_string(CAST(as_path AS INTEGER[]), ',') AS as_path, next_hop, med, "
      "array_to_string(from_json(communities, '[\"VARCHAR\"]'), ',') AS communities, "
      "event_time FROM bgp_fx",
    "decode_dns": _with(DNS_FX)
    + f"SELECT {_iso('event_time')} AS timestamp, resolver_ip, source_ip, queried_domain, query_type, "
      "response_code, ttl, entropy, domain_length, event_time FROM dns_fx",
    "domain_entropy": _with(DNS_FX) + "SELECT event_id, queried_domain, entropy FROM dns_fx",
    "domain_length": _with(DNS_FX) + "SELECT event_id, queried_domain, domain_length FROM dns_fx",
    "pseudonymise_ip": "SELECT event_id, user_id, substr(sha256(concat('192.168.', "
                       "cast((user_id // 250) % 256 AS varchar), '.', cast(user_id % 250 + 1 AS varchar))), 1, 16) "
                       "AS source_ip FROM events",
    "page_host_entropy": "SELECT page_id, host, cast(length(host) AS int) AS host_length, "
                         f"{_entropy('host')} AS entropy FROM (SELECT page_id, "
                         f"regexp_extract(url, '{URL_HOST_PATTERN}', 1) AS host FROM pages)",
    "stream_route_flap": _with(BGP_FX, FLAP) + _watermarked("flap", FLAP_WHERE, 30),
    "stream_as_hijack": _with(BGP_FX, HIJACK) + _watermarked("hijack", HIJACK_WHERE, 30),
    "stream_nxdomain_storm": _with(DNS_FX, STORM) + "SELECT * FROM storm",
    "stream_amplification": _with(DNS_FX, AMP) + "SELECT * FROM amp",
    "stream_dns_tunneling": _with(DNS_FX, TUNNEL) + "SELECT * FROM tunnel",
    "stream_bgp_alerts": _with(BGP_FX, FLAP, HIJACK)
    + _watermarked("flap", FLAP_WHERE, 30) + " UNION ALL " + _watermarked("hijack", HIJACK_WHERE, 30),
    # One fused query: both rules close windows on the watermark of their
    # combined rows, which for these rules are the flap rule's rows.
    "stream_bgp_alerts_fused": _with(BGP_FX, FLAP, HIJACK)
    + _watermarked("flap", FLAP_WHERE, 30) + " UNION ALL " + _watermarked("hijack", FLAP_WHERE, 30),
    "stream_dns_alerts": _with(DNS_FX, STORM, AMP, TUNNEL, DNS_ALERTS) + "SELECT * FROM dns_alerts",
    "stream_dns_alerts_fused": _with(DNS_FX, STORM, AMP, TUNNEL, DNS_ALERTS)
    + "SELECT * FROM dns_alerts",
    "stream_archive": _with(BGP_FX, ROUTING_EVENTS) + "SELECT * FROM routing_events",
    "stream_dns_archive": _with(DNS_FX, DNS_EVENTS) + "SELECT * FROM dns_events",
    "stream_committed_archive": _with(DNS_FX, DNS_EVENTS) + "SELECT * FROM dns_events",
}
# The same results by another way.
SQL |= {
    "stream_bgp_alerts_staged": SQL["stream_bgp_alerts"],
    "stream_dns_alerts_staged": SQL["stream_dns_alerts"],
    "stream_triggered_storm": SQL["stream_nxdomain_storm"],
}
