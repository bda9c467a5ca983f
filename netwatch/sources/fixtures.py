"""Routing and lookup events derived from the driver's ``events`` table.

``events`` spans 30 days with at most a couple of events per user and
minute, so with the reference windows and thresholds nothing would fire.
These views compress time by an integer factor and map users, event types
and ids onto routing and lookup fields with integer arithmetic; the
windows and thresholds stay the reference's. Every column is a function of
one input row, so the views are narrow (no shuffle) and grow with the
table. The same mapping, written for DuckDB, is the oracle's input
(``netwatch.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.functions.hashing import pseudonymise
from netwatch.operators.enrich import enrich_lookups
from netwatch.operators.rules import PATH_AS

SIMULATED_AS = PATH_AS
# Answer lifetimes of the lookup simulation.
SIMULATED_TTL = (60, 300, 3600, 86400)

ROUTING_TIME_FACTOR = 2592    # 30 days -> 1,000 s
LOOKUP_TIME_FACTOR = 25920    # 30 days -> 100 s
_T0 = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def _compressed_time(factor: int) -> str:
    return (f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, {_T0}, ts) div {factor}, {_T0})")


def _as_array() -> str:
    return "array(" + ",".join(str(a) for a in SIMULATED_AS) + ")"


def routing_fixture(events: DataFrame) -> DataFrame:
    """Typed routing updates: the columns a decoded record has."""
    ases = _as_array()
    origin = f"{ases}[cast(event_id % 15 AS int)]"
    peer = f"{ases}[cast((event_id div 15) % 15 AS int)]"
    etype = ("CASE event_type WHEN 'click' THEN 'WITHDRAW' WHEN 'error' THEN 'PATH_CHANGE' "
             "ELSE 'ANNOUNCE' END")
    return events.selectExpr(
        "event_id",
        f"{_compressed_time(ROUTING_TIME_FACTOR)} AS event_time",
        "concat('10.', cast((event_id div 256) % 256 AS string), '.', "
        "cast(event_id % 256 AS string), '.1') AS router_id",
        f"{peer} AS peer_as",
        f"{origin} AS origin_as",
        "concat('10.', cast(user_id div 256 AS string), '.', cast(user_id % 256 AS string), "
        "'.0/24') AS prefix",
        f"{etype} AS event_type",
        # A path change carries an unexpected private AS after the origin.
        f"CASE WHEN event_type = 'error' "
        f"THEN concat('[', cast({origin} AS string), ',', cast(60000 + event_id % 5001 AS string), "
        f"',', cast({peer} AS string), ']') "
        f"ELSE concat('[', cast({origin} AS string), ',', cast({peer} AS string), ']') END AS as_path",
        "concat('192.168.', cast((event_id div 254) % 256 AS string), '.', "
        "cast(event_id % 254 + 1 AS string)) AS next_hop",
        "cast(event_id % 1001 AS int) AS med",
        "concat('[\"', cast(user_id % 65535 + 1 AS string), ':', "
        "cast(event_id % 65535 + 1 AS string), '\"]') AS communities",
    )


def lookup_fixture(events: DataFrame, enrich: bool = True) -> DataFrame:
    """Typed lookup events; eight client hosts so per-source rules fire."""
    ttl = "array(" + ",".join(str(t) for t in SIMULATED_TTL) + ")"
    base = events.selectExpr(
        "event_id",
        f"{_compressed_time(LOOKUP_TIME_FACTOR)} AS event_time",
        "concat('192.168.1.', cast(least(user_id % 8, (user_id div 8) % 8) AS string)) AS client_ip",
        "concat('8.8.', cast(event_id % 2 AS string), '.', cast(event_id % 8 + 1 AS string)) "
        "AS resolver_ip",
        "CASE WHEN event_type = 'error' AND event_id % 2 = 0 "
        "THEN concat(substr(sha2(cast(event_id AS string), 256), 1, cast(40 + event_id % 21 AS int)), "
        "'.evil.com') WHEN event_id % 3 = 0 THEN 'stackoverflow.com' ELSE 'google.com' END "
        "AS queried_domain",
        "CASE event_type WHEN 'click' THEN 'TXT' WHEN 'purchase' THEN 'ANY' ELSE 'A' END "
        "AS query_type",
        "CASE event_type WHEN 'error' THEN 'NXDOMAIN' ELSE 'NOERROR' END AS response_code",
        f"{ttl}[cast(event_id % 4 AS int)] AS ttl",
    )
    out = base.withColumn("source_ip", pseudonymise("client_ip")).drop("client_ip")
    out = out.select("event_id", "event_time", "resolver_ip", "source_ip", "queried_domain",
                     "query_type", "response_code", "ttl")
    return enrich_lookups(out) if enrich else out


def known_prefix_fixture(suppliers: DataFrame) -> DataFrame:
    """prefix: a registry of known blocks, one per supplier, of nested
    lengths and with repeated blocks; some are narrower than any announced
    prefix, some far from all."""
    return suppliers.selectExpr(
        "CASE s_suppkey % 4 WHEN 0 THEN concat('10.0.', cast(s_suppkey % 256 AS string), '.0/24') "
        "WHEN 1 THEN concat('10.0.', cast((s_suppkey div 16) * 32 % 256 AS string), '.0/20') "
        "WHEN 2 THEN concat('10.0.', cast(s_suppkey % 256 AS string), '.0/25') "
        "ELSE concat('10.', cast(s_suppkey % 256 AS string), '.0.0/16') END AS prefix")


def allowed_origins_fixture(nations: DataFrame) -> DataFrame:
    """origin_as: an allow-list as a table, from the nations of three regions."""
    return nations.filter("n_regionkey <= 2").selectExpr(f"{_as_array()}[cast(n_nationkey % 15 AS int)] AS origin_as")


# Scheme, then the authority up to the first '/', ':', '?' or '#'.
URL_HOST_PATTERN = "^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)"


def page_hosts(pages: DataFrame) -> DataFrame:
    """Host part of each page URL (a second, real-string name input);
    empty when the URL has no scheme."""
    return pages.select("page_id", F.regexp_extract("url", URL_HOST_PATTERN, 1).alias("host"))
