"""Tables with a list of committed batches: replays, readers, compaction."""

import datetime as dt
import os
import random

import pytest

from netwatch.operators import read_table, register_tables
from netwatch.schemas import DNS_EVENTS_SCHEMA, SINK_PARTITIONS
from netwatch.session import list_paths
from netwatch.sources.manifest import commits, latest_snapshot, snapshot_versions
from netwatch.streaming import CommittedBatchSink, committed_sinks, compact_days, vacuum

T = dt.datetime(2024, 1, 1)
DAY1, DAY2, DAY3, DAY4 = (dt.date(2024, 1, d) for d in (1, 2, 3, 4))
RUN = ("archive", "append", "direct")


def frame(spark, rows):
    """rows: (name, hours since T or None)"""
    return spark.createDataFrame(
        [(None if h is None else T + dt.timedelta(hours=h), n, "r", "d", "A", "NOERROR", 60, 1.0, 1) for n, h in rows],
        DNS_EVENTS_SCHEMA)


def write(spark, table, batch, rows, writer="archive"):
    CommittedBatchSink(table, writer, date_column="timestamp")(frame(spark, rows), batch)


def names(df):
    return sorted(r.source_ip for r in df.select("source_ip").collect())


def table_names(spark, table):
    return names(read_table(spark, table, DNS_EVENTS_SCHEMA))


def files(spark, table):
    return {p.split("event_date=")[1].split("/")[0]: p.split("/version=")[1].split("/")[0]
            for p in read_table(spark, table, DNS_EVENTS_SCHEMA).inputFiles() if "/days/" in p}


def test_an_attempt_counts_once_it_is_listed(spark, workdir, monkeypatch):
    table = os.path.join(workdir, "t")
    write(spark, table, 0, [("a", 1)])
    import netwatch.streaming.committed as module

    def broken(*_):
        raise OSError("lost before the listing")

    with monkeypatch.context() as patch:
        patch.setattr(module, "create_empty", broken)
        with pytest.raises(OSError):
            write(spark, table, 1, [("b", 1)])
    assert len(list_paths(spark, os.path.join(table, "batches", "*", "*", "*", "batch_id=1", "*"))) == 1
    assert table_names(spark, table) == ["a"]
    write(spark, table, 1, [("b", 1)])
    assert table_names(spark, table) == ["a", "b"]


def test_nothing_is_read_before_the_first_listing(spark, workdir, monkeypatch):
    import netwatch.streaming.committed as module
    table = os.path.join(workdir, "t")
    assert table_names(spark, table) == []
    with monkeypatch.context() as patch:
        patch.setattr(module, "create_empty", lambda *_: None)
        write(spark, table, 0, [("a", 1)])
    assert table_names(spark, table) == []
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 0 and vacuum(spark, table) == 0


def test_a_reader_during_a_replay_sees_the_old_or_the_new_batch(spark, workdir, monkeypatch):
    import netwatch.streaming.committed as module
    table, seen, listing = os.path.join(workdir, "t"), [], module.create_empty
    write(spark, table, 0, [("a", 1), ("b", 30)])
    opened = read_table(spark, table, DNS_EVENTS_SCHEMA)

    def watched(session, path):
        seen.append(table_names(spark, table))    # the new files are whole by now
        listing(session, path)
        seen.append(table_names(spark, table))

    with monkeypatch.context() as patch:
        patch.setattr(module, "create_empty", watched)
        write(spark, table, 0, [("c", 1)])
    assert seen == [["a", "b"], ["c"]]
    assert names(opened) == ["a", "b"]            # opened before, its files are still there


def test_empty_batches(spark, workdir):
    table = os.path.join(workdir, "t")
    write(spark, table, 0, [])
    assert not list_paths(spark, os.path.join(table, "commits"))
    write(spark, table, 1, [("a", 1)])
    write(spark, table, 1, [])                    # a replay without rows replaces the attempt
    assert table_names(spark, table) == []
    write(spark, table, 2, [("b", None)])
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 0
    assert table_names(spark, table) == ["b"]
    assert latest_snapshot(spark, table).covered == {RUN: 1}


def test_finished_days_are_written_once(spark, workdir):
    table = os.path.join(workdir, "t")
    write(spark, table, 0, [("a", 1), ("b", 25)])
    write(spark, table, 1, [("c", 2), ("n", None)])
    write(spark, table, 2, [("d", 26)])           # the newest: may be replayed yet
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY2) == 3   # day 1, day 2 so far, rows without a day
    assert latest_snapshot(spark, table).days == {DAY1: [1], DAY2: [1], None: [1]}
    assert table_names(spark, table) == ["a", "b", "c", "d", "n"]
    # Nothing new: nothing read or written.
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY2) == 0
    assert snapshot_versions(spark, table) == [1]
    write(spark, table, 2, [("d2", 26)])          # the replay
    write(spark, table, 3, [("e", 50)])
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY2) == 1   # day 2 goes on
    assert latest_snapshot(spark, table).days == {DAY1: [1], DAY2: [1, 2], None: [1]}
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY3) == 1   # day 2 is over: merged
    assert latest_snapshot(spark, table).days == {DAY1: [1], DAY2: [3], None: [1]}
    assert table_names(spark, table) == ["a", "b", "c", "d2", "e", "n"]
    assert files(spark, table) == {"2024-01-01": "1", "2024-01-02": "3", "__HIVE_DEFAULT_PARTITION__": "1"}
    write(spark, table, 4, [("late", 3)])
    write(spark, table, 5, [])
    write(spark, table, 6, [("f", 51)])
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY3) == 2   # day 1 anew with the late row, day 3 begun
    assert latest_snapshot(spark, table).days == {DAY1: [4], DAY2: [3], DAY3: [4], None: [1]}
    assert table_names(spark, table) == ["a", "b", "c", "d2", "e", "f", "late", "n"]
    row = read_table(spark, table, DNS_EVENTS_SCHEMA).filter("source_ip = 'late'").first()
    assert (row.writer, row.mode, row.run, row.batch_id, row.event_date) == (*RUN, 4, DAY1)


def test_unchanged_days_are_not_read(spark, workdir):
    """Their files are destroyed; the compaction of other days does not notice."""
    table = os.path.join(workdir, "t")
    write(spark, table, 0, [("a", 1)])
    write(spark, table, 1, [("b", 25)])
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 1
    for path in list_paths(spark, os.path.join(table, "days", "version=1", "event_date=2024-01-01", "*.parquet")):
        with open(path.removeprefix("file:"), "wb") as f:
            f.write(b"no parquet")
    write(spark, table, 2, [("c", 26)])
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 1
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 0


def test_vacuum_keeps_what_readers_of_two_snapshots_need(spark, workdir):
    table = os.path.join(workdir, "t")
    for batch in range(3):
        write(spark, table, batch, [(f"a{batch}", batch)])
        write(spark, table, batch, [(f"b{batch}", batch)])
    assert vacuum(spark, table) == 2              # replaced attempts of settled batches
    before = read_table(spark, table, DNS_EVENTS_SCHEMA)
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 1
    assert vacuum(spark, table) == 0 and names(before) == ["b0", "b1", "b2"]
    write(spark, table, 3, [("c", 4)])
    after = read_table(spark, table, DNS_EVENTS_SCHEMA)
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 1
    assert vacuum(spark, table) == 3              # batches 0 and 1 and the replaced attempt of 2
    assert names(after) == table_names(spark, table) == ["b0", "b1", "b2", "c"]
    assert {b for found in commits(spark, table, {}).values() for b in found} == {2, 3}
    write(spark, table, 4, [("d", 5)])
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 1
    assert vacuum(spark, table) == 2              # batch 2 and version 1 of the day
    assert table_names(spark, table) == ["b0", "b1", "b2", "c", "d"]
    assert snapshot_versions(spark, table) == [2, 3]


def test_a_broken_compaction_changes_nothing(spark, workdir):
    table = os.path.join(workdir, "t")
    write(spark, table, 0, [("a", 1)])
    write(spark, table, 1, [("b", 2)])
    # Days without a snapshot that names them.
    frame(spark, [("x", 1)]).write.parquet(os.path.join(table, "days", "version=1", "event_date=2024-01-01"))
    assert table_names(spark, table) == ["a", "b"]
    assert compact_days(spark, table, DNS_EVENTS_SCHEMA, DAY4) == 1
    assert table_names(spark, table) == ["a", "b"] and snapshot_versions(spark, table) == [2]
    assert vacuum(spark, table) == 1 and table_names(spark, table) == ["a", "b"]


def test_any_order_of_work_keeps_every_row_once(spark, workdir):
    table, rng, expected = os.path.join(workdir, "t"), random.Random(7), {}
    last = {"w1": -1, "w2": -1}
    for step in range(14):
        writer = rng.choice(["w1", "w2"])
        replay = last[writer] >= 0 and rng.random() < 0.3
        last[writer] += not replay
        rows = [(f"{writer}-{step}-{i}", rng.choice([None, rng.randrange(96)])) for i in range(rng.randrange(4))]
        write(spark, table, last[writer], rows, writer)
        expected[writer, last[writer]] = [n for n, _ in rows]
        if rng.random() < 0.4:
            compact_days(spark, table, DNS_EVENTS_SCHEMA, rng.choice([DAY2, DAY3, DAY4]))
        if rng.random() < 0.4:
            vacuum(spark, table)
    assert snapshot_versions(spark, table)
    assert table_names(spark, table) == sorted(n for rows in expected.values() for n in rows)


def test_tables_are_registered_like_plain_ones(spark, workdir):
    sink = committed_sinks(workdir)("dns_events", "archive", cache=False, date_column="timestamp")
    sink(frame(spark, [("a", 1), ("b", 30)]), 0)
    assert "dns_events" in register_tables(spark, workdir)
    got = spark.sql("SELECT source_ip FROM dns_events WHERE event_date = DATE'2024-01-02'").collect()
    assert [r.source_ip for r in got] == ["b"]
    table = read_table(spark, os.path.join(workdir, "dns_events"), DNS_EVENTS_SCHEMA)
    assert table.columns == [*DNS_EVENTS_SCHEMA.names, *(n for n, _ in SINK_PARTITIONS)]
