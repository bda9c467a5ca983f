"""Alerts as topic frames: encode, publish (a folder stands for the topic), read."""

import datetime as dt
import os

from netwatch.operators import as_hijack_rule
from netwatch.schemas import BGP_ALERTS_SCHEMA, DNS_ALERTS_SCHEMA
from netwatch.sources import decode_routing, load_table, routing_fixture, routing_wire, wire_file_stream
from netwatch.streaming import (
    ParquetBatchSink,
    TopicBatchSink,
    alert_frames,
    folder_publisher,
    received_alerts,
    run_until_drained,
    start_query,
    topic_sinks,
)

T = dt.datetime(2024, 1, 1)
ROOT = "/root/testdata/sf0.001"


def alerts(spark, rows):
    return spark.createDataFrame([(T, T, s, 1, "DNS_TUNNELING", "CRITICAL", T) for s in rows], DNS_ALERTS_SCHEMA)


def text(rows):
    return sorted(map(str, rows))


def test_a_replay_sends_equal_keys_and_is_read_once(spark, workdir):
    batch = alerts(spark, ["a", "b", "b", "b", None])
    sink = TopicBatchSink("dns_alerts", "tunnel", folder_publisher(workdir))
    sink(batch, 3)
    sink(batch.orderBy("source_ip").repartition(3), 3)     # the same batch again, in another order
    frames = spark.read.parquet(workdir)
    assert frames.count() == 10 and frames.select("key").distinct().count() == 5
    assert {r.topic for r in frames.collect()} == {"dns_alerts"}
    assert text(received_alerts(frames, DNS_ALERTS_SCHEMA).collect()) == text(batch.collect())


def test_other_batches_runs_and_writers_have_other_keys(spark):
    batch = alerts(spark, ["a"])
    keys = {bytes(alert_frames(batch, "t", w, r, b).first().key)
            for w, r, b in (("w", "r", 0), ("w", "r", 1), ("w", "s", 0), ("v", "r", 0))}
    assert len(keys) == 4


def test_empty_batches_publish_nothing(spark):
    calls = []
    TopicBatchSink("t", "w", calls.append)(alerts(spark, []), 0)
    assert calls == []


def test_a_stream_writes_its_table_and_its_topic(spark, workdir):
    wire, table, topic = (os.path.join(workdir, x) for x in ("wire", "tables", "topic"))
    routing_wire(routing_fixture(load_table(spark, ROOT, "events"))).write.parquet(wire)
    make = topic_sinks(folder_publisher(topic), lambda name, writer, **o: ParquetBatchSink(os.path.join(table, name), writer, **o))
    rule = as_hijack_rule()
    query = start_query(rule.apply(decode_routing(wire_file_stream(spark, wire))), make("bgp_alerts", rule.name),
                        os.path.join(workdir, "ck"), "append", None, {"availableNow": True})
    run_until_drained([query])
    stored = spark.read.parquet(os.path.join(table, "bgp_alerts")).select(*BGP_ALERTS_SCHEMA.names)
    got = received_alerts(spark.read.parquet(topic), BGP_ALERTS_SCHEMA)
    assert stored.count() > 0 and got.count() == stored.count()
    assert got.exceptAll(stored).count() == 0
    assert isinstance(make("routing_events", "archive"), ParquetBatchSink)
