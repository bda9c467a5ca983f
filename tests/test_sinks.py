import datetime as dt
import os

import pytest

from netwatch.operators import DNS, current_alerts, latest_alerts, read_table, register_tables
from netwatch.schemas import ROUTING_EVENTS_SCHEMA, TABLE_SCHEMAS
from netwatch.streaming import JdbcBatchSink, ParquetBatchSink, compact, jdbc_sinks

T = dt.datetime(2024, 1, 1)


def test_jdbc_sink_replay_statement():
    sink = JdbcBatchSink("jdbc:postgresql://db/x", "dns_alerts", {"user": "u"},
                         batch_column="batch_id", writer="storm")
    assert sink.delete_statement() == "DELETE FROM dns_alerts WHERE batch_id = ? AND writer = ?"


def test_jdbc_sink_skips_empty_batches_without_connecting(spark):
    # An empty batch never opens a connection, so an unreachable URL is fine.
    sink = JdbcBatchSink("jdbc:unreachable:nowhere", "t", {}, batch_column="batch_id", writer="w")
    sink(spark.range(0), 1)


def test_jdbc_sink_deletes_then_appends_with_batch_columns(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    calls = []
    sink = JdbcBatchSink("jdbc:x://db/y", "bgp_alerts", {"user": "u", "driver": "D"},
                         batch_column="batch_id", writer="route_flap", num_partitions=4)
    monkeypatch.setattr(sink, "_delete_batch", lambda df, batch_id, writer: calls.append(("delete", batch_id, writer)))

    def fake_jdbc(self, url, table, mode=None, properties=None):
        calls.append(("append", table, mode, sorted(self._df.columns), properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    sink(spark.range(3).withColumnRenamed("id", "event_count"), 7)
    assert calls[0] == ("delete", 7, "route_flap@direct")
    kind, table, mode, columns, props = calls[1]
    assert (kind, table, mode) == ("append", "bgp_alerts", "append")
    assert columns == ["batch_id", "event_count", "writer"]
    assert props["numPartitions"] == "4" and props["user"] == "u"


def test_jdbc_batch_column_needs_a_writer():
    with pytest.raises(ValueError, match="writer"):
        JdbcBatchSink("jdbc:x", "t", {}, batch_column="batch_id")


def test_jdbc_sinks_name_table_and_writer():
    make = jdbc_sinks("jdbc:x://db/y", {"user": "u"}, "batch_id", num_partitions=3)
    sink = make("bgp_alerts", "route_flap", mode="append", date_column="window_start", rebalance=True)
    assert (sink.table, sink.writer, sink.num_partitions) == ("bgp_alerts", "route_flap", 3)


def test_jdbc_writer_differs_between_checkpoints_at_one_path(spark, workdir, monkeypatch):
    """A checkpoint folder made anew at the same path starts again at batch
    0: its deletes must not name the rows of the older one."""
    from pyspark.sql.readwriter import DataFrameWriter
    from netwatch.streaming import run_until_drained, start_query

    deletes, writers = [], []
    monkeypatch.setattr(JdbcBatchSink, "_delete_batch",
                        lambda self, df, batch_id, writer: deletes.append((batch_id, writer)))
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, **options: writers.append(
        self._df.select("writer").distinct().collect()[0][0]))
    spark.range(5).write.parquet(os.path.join(workdir, "in"))
    checkpoint = os.path.join(workdir, "ck")
    for _ in range(2):
        stream = spark.readStream.schema("id long").parquet(os.path.join(workdir, "in"))
        sink = jdbc_sinks("jdbc:x", {}, "batch_id")("t", "w")
        run_until_drained([start_query(stream, sink, checkpoint, trigger={"availableNow": True})])
        os.rename(checkpoint, checkpoint + f".{len(deletes)}")
    assert [b for b, _ in deletes] == [0, 0]
    assert len({w for _, w in deletes}) == 2 and writers == [w for _, w in deletes]
    assert all(w.startswith("w@") for w in writers)


def _dns_history(spark, rows):
    """rows: (source, count, detected second, mode, run, batch)"""
    return spark.createDataFrame(
        [(T, T + dt.timedelta(seconds=30), s, n, "NXDOMAIN_STORM", "HIGH", T + dt.timedelta(seconds=at), "w", m, r, b)
         for s, n, at, m, r, b in rows],
        "window_start timestamp, window_end timestamp, source_ip string, event_count long, alert_type string, "
        "severity string, detected_at timestamp, writer string, mode string, run string, batch_id long")


def test_latest_alert_of_a_new_run_wins_over_larger_batch_ids(spark):
    history = _dns_history(spark, [("a", 5, 1, "update", "r1", 8), ("a", 9, 2, "update", "r1", 9),
                                   ("a", 3, 50, "update", "r2", 0), ("b", 2, 1, "update", "r2", 1),
                                   ("b", 4, 1, "update", "r2", 2)])
    assert {r.source_ip: r.event_count for r in latest_alerts(history, DNS).collect()} == {"a": 3, "b": 4}


def test_update_rows_are_known_by_their_mode_not_their_writer(spark):
    history = _dns_history(spark, [("a", n, n, "update", "r", n) for n in (1, 2, 3)]
                           + [("t", 1, 1, "append", "r", 0), ("t", 1, 1, "append", "r", 0)])
    found = sorted((r.source_ip, r.event_count) for r in current_alerts(history, DNS).collect())
    assert found == [("a", 3), ("t", 1), ("t", 1)]


def test_unwritten_tables_are_empty_views_and_damage_raises(spark, workdir):
    names = register_tables(spark, workdir)
    assert names == ["routing_events", "dns_events", "bgp_alerts", "current_bgp_alerts", "dns_alerts",
                     "current_dns_alerts", "aggregated_metrics"]
    for name in names:
        assert spark.sql(f"SELECT * FROM {name}").count() == 0
    for name, schema in TABLE_SCHEMAS.items():
        assert spark.table(name).columns == [*schema.names, "event_date"]
    bad = os.path.join(workdir, "dns_events", "writer=archive")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        read_table(spark, os.path.join(workdir, "dns_events"), TABLE_SCHEMAS["dns_events"]).collect()


def test_small_output_is_merged_and_large_output_is_not_capped(spark, workdir):
    frame = spark.range(200_000).selectExpr("id", "sha2(cast(id as string), 256) AS text").repartition(8)
    sink = ParquetBatchSink(workdir, "w", rebalance=True)
    sink(frame.limit(100).repartition(8), 0)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sink(frame, 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {b: len([f for f in os.listdir(sink.folder(b, "direct")) if f.endswith(".parquet")]) for b in (0, 1)}
    assert files[0] == 1 and files[1] > 2
    assert spark.read.parquet(workdir).count() == 200_100


def test_compaction_keeps_rows_and_columns(spark, workdir):
    rows = [(T + dt.timedelta(days=d), f"r{d}", 1, 2, "p", "ANNOUNCE", "h", d) for d in range(3)]
    source, target = os.path.join(workdir, "t"), os.path.join(workdir, "c")
    sink = ParquetBatchSink(source, "archive", date_column="timestamp")
    for b in range(4):
        sink(spark.createDataFrame(rows, ROUTING_EVENTS_SCHEMA), b)
    compact(spark, source, target, ROUTING_EVENTS_SCHEMA)
    before = read_table(spark, source, ROUTING_EVENTS_SCHEMA)
    after = read_table(spark, target, ROUTING_EVENTS_SCHEMA)
    assert after.count() == 12 and sorted(after.columns) == sorted(before.columns)
    assert after.select(before.columns).exceptAll(before).count() == 0
    assert sorted(d for d in os.listdir(target) if "=" in d) == [f"event_date=2024-01-0{d}" for d in (1, 2, 3)]

