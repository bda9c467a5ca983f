"""Declared schemas: the wire frame, the two event records, the sink tables.

Nothing is inferred. Every field is nullable, as on the wire, so a malformed
record decodes to NULLs instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# What a Kafka source yields; file-stream tests use the same columns.
WIRE_SCHEMA = _struct(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
    ("timestampType", IntegerType()),
)

# Field names and order of the two wire records.

# Routing update as the consumer declares it. as_path and communities are
# JSON arrays on the wire but kept as their JSON text by default.
BGP_SCHEMA = _struct(
    ("timestamp", StringType()),
    ("router_id", StringType()),
    ("peer_as", IntegerType()),
    ("origin_as", IntegerType()),
    ("prefix", StringType()),
    ("event_type", StringType()),
    ("as_path", StringType()),
    ("next_hop", StringType()),
    ("med", IntegerType()),
    ("communities", StringType()),
)

# Same record with the two list fields typed.
BGP_SCHEMA_TYPED = _struct(
    ("timestamp", StringType()),
    ("router_id", StringType()),
    ("peer_as", IntegerType()),
    ("origin_as", IntegerType()),
    ("prefix", StringType()),
    ("event_type", StringType()),
    ("as_path", ArrayType(IntegerType())),
    ("next_hop", StringType()),
    ("med", IntegerType()),
    ("communities", ArrayType(StringType())),
)

# Name-lookup record. entropy is double (the table column is double
# precision; a float would widen 2.646 to 2.6459999...). The unused
# `anomaly` field of the declared record is not carried.
DNS_SCHEMA = _struct(
    ("timestamp", StringType()),
    ("resolver_ip", StringType()),
    ("source_ip", StringType()),
    ("queried_domain", StringType()),
    ("query_type", StringType()),
    ("response_code", StringType()),
    ("ttl", IntegerType()),
    ("entropy", DoubleType()),
    ("domain_length", IntegerType()),
)

# Sink tables, column types as the original tables declare them. Serial ids
# and created_at are database defaults and are not produced here; rows are
# identified by their natural keys.
ROUTING_EVENTS_SCHEMA = _struct(
    ("timestamp", TimestampType()), ("router_id", StringType()), ("peer_as", IntegerType()),
    ("origin_as", IntegerType()), ("prefix", StringType()), ("event_type", StringType()),
    ("next_hop", StringType()), ("med", IntegerType()),
)
DNS_EVENTS_SCHEMA = _struct(
    ("timestamp", TimestampType()), ("source_ip", StringType()), ("resolver_ip", StringType()),
    ("queried_domain", StringType()), ("query_type", StringType()),
    ("response_code", StringType()), ("ttl", IntegerType()), ("entropy", DoubleType()),
    ("domain_length", IntegerType()),
)
BGP_ALERTS_SCHEMA = _struct(
    ("window_start", TimestampType()), ("window_end", TimestampType()), ("prefix", StringType()),
    ("origin_as", IntegerType()), ("event_count", LongType()), ("alert_type", StringType()),
    ("severity", StringType()), ("detected_at", TimestampType()),
)
DNS_ALERTS_SCHEMA = _struct(
    ("window_start", TimestampType()), ("window_end", TimestampType()),
    ("source_ip", StringType()), ("event_count", LongType()), ("alert_type", StringType()),
    ("severity", StringType()), ("detected_at", TimestampType()),
)
METRICS_SCHEMA = _struct(
    ("window_start", TimestampType()), ("window_end", TimestampType()), ("metric_type", StringType()),
    ("metric_value", DoubleType()), ("labels", StringType()),
)
TABLE_SCHEMAS = {
    "routing_events": ROUTING_EVENTS_SCHEMA,
    "dns_events": DNS_EVENTS_SCHEMA,
    "bgp_alerts": BGP_ALERTS_SCHEMA,
    "dns_alerts": DNS_ALERTS_SCHEMA,
    "aggregated_metrics": METRICS_SCHEMA,
}
ROUTING_EVENTS_COLUMNS = tuple(ROUTING_EVENTS_SCHEMA.names)
DNS_EVENTS_COLUMNS = tuple(DNS_EVENTS_SCHEMA.names)
BGP_ALERT_COLUMNS = tuple(BGP_ALERTS_SCHEMA.names)
DNS_ALERT_COLUMNS = tuple(DNS_ALERTS_SCHEMA.names)

# Folders the parquet sink adds above its files; they read back as columns.
SINK_PARTITIONS = (
    ("writer", StringType()), ("mode", StringType()), ("run", StringType()),
    ("batch_id", LongType()), ("event_date", DateType()),
)


def stored(schema: StructType) -> StructType:
    """A sink table's schema with the folder columns."""
    return StructType([*schema.fields, *_struct(*SINK_PARTITIONS).fields])
