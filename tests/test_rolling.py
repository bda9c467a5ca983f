"""Views that are carried along against views recomputed from all rows."""

import datetime as dt
import os
import random

from netwatch.operators import DNS, event_series, latest_alerts, read_table
from netwatch.schemas import DNS_ALERTS_SCHEMA, DNS_EVENTS_SCHEMA
from netwatch.streaming import ParquetBatchSink, latest_alerts_view, series_view

T = dt.datetime(2024, 1, 1)


def at(seconds):
    return T + dt.timedelta(seconds=seconds)


def write_alerts(spark, table, batch, rows, run="w"):
    """rows: (source, count, detected second)"""
    df = spark.createDataFrame([(T, at(30), s, n, "NXDOMAIN_STORM", "HIGH", at(d)) for s, n, d in rows], DNS_ALERTS_SCHEMA)
    ParquetBatchSink(table, run, mode="update", date_column="window_start")(df, batch)


def write_events(spark, table, batch, seconds):
    df = spark.createDataFrame([(None if s is None else at(s), "a", "r", "n", "A", "NOERROR", 60, 1.0, 1)
                                for s in seconds], DNS_EVENTS_SCHEMA)
    ParquetBatchSink(table, "archive", date_column="timestamp")(df, batch)


def text(df):
    return sorted(map(str, df.collect()))


def batches_read(df):
    return sorted({int(p.split("batch_id=")[1].split("/")[0]) for p in df.inputFiles() if "batch_id=" in p})


def test_latest_view_equals_the_history_and_reads_new_batches_only(spark, workdir):
    table, rng = os.path.join(workdir, "t"), random.Random(1)
    view = latest_alerts_view(table, DNS_ALERTS_SCHEMA, os.path.join(workdir, "s"), DNS)
    assert view.read(spark).collect() == [] and view.advance(spark) == 0
    for batch in range(9):
        write_alerts(spark, table, batch, [(rng.choice("abcdef"), rng.randrange(100), batch) for _ in range(1)]
                     + [("x", batch, batch)])
        whole = text(latest_alerts(read_table(spark, table, DNS_ALERTS_SCHEMA), DNS))
        assert text(view.read(spark).select(*DNS_ALERTS_SCHEMA.names)) == whole
        if batch in (3, 4, 7):
            assert view.advance(spark) == {3: 3, 4: 1, 7: 3}[batch]
            assert batches_read(view.read(spark)) == [batch]
            assert text(view.read(spark).select(*DNS_ALERTS_SCHEMA.names)) == whole
    assert view.advance(spark) == 1 and view.advance(spark) == 0


def test_a_replay_of_the_newest_batch_is_counted_once(spark, workdir):
    table = os.path.join(workdir, "t")
    view = series_view(table, DNS_EVENTS_SCHEMA, os.path.join(workdir, "s"))

    def check():
        assert text(view.read(spark)) == text(event_series(read_table(spark, table, DNS_EVENTS_SCHEMA)))

    write_events(spark, table, 0, [1, 1, 2, None])
    write_events(spark, table, 1, [2, 3])
    assert view.advance(spark) == 1          # batch 1 may still be replayed
    write_events(spark, table, 1, [2, 3])    # and is
    check()
    write_events(spark, table, 2, [1, 90_000])   # a late row and another day
    check()
    assert view.advance(spark) == 1
    write_events(spark, table, 2, [1, 90_000])
    check()
    assert batches_read(view.read(spark)) == [2]


def test_runs_have_batch_ids_of_their_own(spark, workdir):
    table = os.path.join(workdir, "t")
    view = latest_alerts_view(table, DNS_ALERTS_SCHEMA, os.path.join(workdir, "s"), DNS)
    for batch in range(3):
        write_alerts(spark, table, batch, [("a", 10 + batch, batch)])
    assert view.advance(spark) == 2
    write_alerts(spark, table, 0, [("a", 1, 50), ("b", 2, 50)], run="other")   # starts again at 0
    got = {r.source_ip: r.event_count for r in view.read(spark).collect()}
    assert got == {"a": 1, "b": 2}


def test_a_broken_advance_leaves_the_version_before(spark, workdir):
    table, state = os.path.join(workdir, "t"), os.path.join(workdir, "s")
    view = series_view(table, DNS_EVENTS_SCHEMA, state)
    for batch in range(3):
        write_events(spark, table, batch, [batch, 7])
    assert view.advance(spark) == 2
    # Rows of the next version without its covered batches: not valid.
    spark.range(1).selectExpr("timestamp_seconds(0) AS time", "99L AS event_count").write.parquet(os.path.join(state, "rows", "v2"))
    whole = text(event_series(read_table(spark, table, DNS_EVENTS_SCHEMA)))
    assert text(view.read(spark)) == whole
    write_events(spark, table, 3, [7])
    assert view.advance(spark) == 1
    assert text(view.read(spark)) == text(event_series(read_table(spark, table, DNS_EVENTS_SCHEMA)))
