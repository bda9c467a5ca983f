"""Record sources: the Kafka frame, a file stream with the same frame, and
an encoder that turns a typed table into that frame (for tests and replay)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from netwatch.functions.time import utc_instant
from netwatch.schemas import WIRE_SCHEMA

BGP_TOPIC = "bgp_raw_events"
DNS_TOPIC = "dns_raw_events"


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Subscribe to ``topic``. Needs the Kafka connector on the classpath.

    At scale set ``maxOffsetsPerTrigger`` (bounds a batch after downtime)
    and ``minPartitions`` (splits hot topic partitions across tasks) in
    ``options``.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def wire_file_stream(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of wire frames stored as parquet files under ``path``."""
    reader = spark.readStream.schema(WIRE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def iso_utc(c: Column | str) -> Column:
    """UTC timestamp -> ISO-8601 text with offset, microsecond precision."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def encode_wire(
    df: DataFrame,
    topic: str,
    key: str,
    payload: Sequence[Column],
    time_column: str = "event_time",
    partitions: int = 3,
) -> DataFrame:
    """Typed rows -> wire frames: JSON value, record key, broker timestamp.

    ``partition`` hashes the key like a keyed producer would; ``offset``
    is unique and increasing per frame, not dense.
    """
    t = F.col(time_column)
    if isinstance(df.schema[time_column].dataType, TimestampNTZType):
        t = utc_instant(t)
    return df.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*payload)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(F.col(key)), F.lit(partitions)).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        t.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def routing_wire(routing: DataFrame, time_column: str = "event_time") -> DataFrame:
    """Typed routing updates -> frames as the routing producer sends them
    (lists as JSON arrays, key = prefix)."""
    payload = [
        iso_utc(time_column).alias("timestamp"),
        F.col("router_id"), F.col("peer_as"), F.col("origin_as"), F.col("prefix"),
        F.col("event_type"),
        F.from_json("as_path", "array<int>").alias("as_path"),
        F.col("next_hop"), F.col("med"),
        F.from_json("communities", "array<string>").alias("communities"),
    ]
    return encode_wire(routing, BGP_TOPIC, "prefix", payload, time_column)


def lookup_wire(lookups: DataFrame, time_column: str = "event_time") -> DataFrame:
    """Typed lookups -> frames as the lookup producer sends them (entropy
    on the record, no length; key = source)."""
    payload = [
        iso_utc(time_column).alias("timestamp"),
        F.col("source_ip"), F.col("resolver_ip"), F.col("queried_domain"),
        F.col("query_type"), F.col("response_code"), F.col("ttl"), F.col("entropy"),
    ]
    return encode_wire(lookups, DNS_TOPIC, "source_ip", payload, time_column)
