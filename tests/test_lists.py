"""Joins with reference tables against brute force."""

import datetime as dt
import ipaddress
import os
import random
import re

import pytest

from netwatch.functions.prefixes import prefix_parts
from netwatch.operators import (
    as_hijack_rule,
    hijack_by_table,
    known_prefix_hijack,
    not_listed,
    within_known,
)
from netwatch.plans.catalog import QUERIES
from netwatch.sources import decode_routing, routing_wire, wire_file_stream
from netwatch.streaming import ParquetBatchSink, run_until_drained, start_joined_rule

T0 = dt.datetime(2024, 1, 1)
CLOCK = "2024-02-01 00:00:00"
ROOT = "/root/testdata/sf0.001"


def routing(spark, rows):
    """rows: (seconds, prefix, origin)"""
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), p, "ANNOUNCE", o) for s, p, o in rows],
        "event_time timestamp_ntz, prefix string, event_type string, origin_as int")


def network(text):
    if not re.fullmatch(r"(0|[1-9]\d{0,2})(\.(0|[1-9]\d{0,2})){3}/[1-3]?\d", text or ""):
        return None
    try:
        return ipaddress.ip_network(text, strict=False)
    except ValueError:
        return None


def longest(prefix, known):
    own, best = network(prefix), None
    if own is None:
        return None
    for text in sorted(k for k in known if k):
        block = network(text)
        if block is not None and own.subnet_of(block) and (best is None or block.prefixlen > network(best).prefixlen):
            best = text
    return best


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_longest_match_over_nested_prefixes(spark, broadcast_rows):
    rng = random.Random(7)

    def some(low, high):
        bits = rng.randint(low, high)
        return f"10.{rng.choice([0, 1])}.{rng.choice([0, 1, 2, 128])}.{rng.randrange(256)}/{bits}"

    known = [some(8, 32) for _ in range(120)] + ["10.0.0.0/16", "10.0.0.0/16", "10.0.0.7/16", "0.0.0.0/1", None, "",
                                                 "nonsense", "10.0.0.0", "10.0.0.256/24", "10.0.0.0/33", "::/0"]
    asked = [some(8, 32) for _ in range(300)] + ["255.0.0.0/8", "10.0.0.0/16", "bad", None, "2001:db8::/32", "10.0.0.1"]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(asked)], "__i int, prefix string")
    table = spark.createDataFrame([(k,) for k in known], "prefix string")
    got = {r["__i"]: r.known_prefix for r in within_known(rows, table, broadcast_rows).collect()}
    want = {i: longest(p, known) for i, p in enumerate(asked)}
    assert got == {i: k for i, k in want.items() if k is not None}
    assert 50 < len(got) < 306


def test_an_empty_registry_matches_nothing(spark):
    rows = spark.createDataFrame([("10.0.0.0/24",)], "prefix string")
    out = within_known(rows, spark.createDataFrame([("x",)], "prefix string"))
    assert out.columns == ["prefix", "known_prefix"] and out.collect() == []


def test_prefix_parts(spark):
    rows = ["1.2.3.4/32", "0.0.0.0/0", "255.255.255.255/8", "01.2.3.4/8", "1.2.3/8", "1.2.3.4/ 8", "a.b.c.d/8", None]
    got = [r.p for r in spark.createDataFrame([(r,) for r in rows], "t string").select(prefix_parts("t").alias("p")).collect()]
    assert [None if p is None else tuple(p) for p in got] == [
        (0x01020304, 32), (0, 0), (0xFFFFFFFF, 8), None, None, None, None, None]


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_hijacks_of_known_prefixes(spark, broadcast_rows):
    rows = [(1, "10.0.1.0/24", 666), (2, "10.0.1.0/24", 666), (70, "10.0.1.0/24", 666), (3, "10.0.1.0/24", 15169),
            (4, "10.9.1.0/24", 666), (5, "10.0.1.0/24", None), (6, "10.0.0.0/8", 666)]
    known = spark.createDataFrame([("10.0.0.0/16",), ("10.0.1.0/24",), ("10.0.1.0/25",)], "prefix string")
    got = known_prefix_hijack(routing(spark, rows), known, CLOCK, broadcast_rows=broadcast_rows)
    assert got.columns == ["window_start", "window_end", "prefix", "origin_as", "event_count", "alert_type",
                           "severity", "detected_at", "known_prefix"]
    assert sorted((r.window_start.minute, r.prefix, r.origin_as, r.event_count, r.known_prefix)
                  for r in got.collect()) == [(0, "10.0.1.0/24", 666, 2, "10.0.1.0/24"),
                                              (1, "10.0.1.0/24", 666, 1, "10.0.1.0/24")]


def test_known_prefix_plan_has_one_exchange_when_the_table_is_small(spark, capsys):
    capsys.readouterr()
    QUERIES["known_prefix_hijack"](spark, ROOT).explain("formatted")
    text = capsys.readouterr().out
    # One for the counts; the registry's own grouping is the other one.
    assert len(re.findall(r"Arguments: hashpartitioning\(window", text)) == 1
    assert len(re.findall(r"Arguments: hashpartitioning", text)) == 2
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def by_sql(spark, rows, listed):
    """What Spark's own NOT IN says."""
    rows.createOrReplaceTempView("rows_of_test")
    listed.createOrReplaceTempView("listed_of_test")
    return sorted(map(str, spark.sql("SELECT * FROM rows_of_test WHERE o NOT IN (SELECT a FROM listed_of_test)").collect()))


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
@pytest.mark.parametrize("listed", [[], [1, 2, 2], [None], [1, None], [9]])
def test_not_in_a_table_follows_sql(spark, listed, broadcast_rows):
    rows = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "o int")
    table = spark.createDataFrame([(x,) for x in listed], "a int")
    assert sorted(map(str, not_listed(rows, table, "o", broadcast_rows).collect())) == by_sql(spark, rows, table)


@pytest.mark.parametrize("listed", [[], [15169, 3356], [666]])
def test_table_equals_the_rule_with_the_same_list(spark, listed):
    rng = random.Random(2)
    rows = [(rng.randrange(200), f"10.0.{rng.randrange(4)}.0/24", rng.choice([15169, 3356, 666, 777, None]))
            for _ in range(400)]
    table = spark.createDataFrame([(x,) for x in listed], "a int")
    got = hijack_by_table(routing(spark, rows), table, CLOCK).collect()
    want = as_hijack_rule(listed).apply(routing(spark, rows), CLOCK).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and want


def test_a_changed_table_counts_from_the_next_batch(spark, workdir):
    """Two batches; between their reads the allow-list file is replaced."""
    wire, table, listed = (os.path.join(workdir, x) for x in ("wire", "table", "listed"))

    def frames(rows):
        df = spark.createDataFrame(
            [(T0 + dt.timedelta(seconds=s), "ANNOUNCE", "10.0.0.0/24", o) for s, o in rows],
            "event_time timestamp_ntz, event_type string, prefix string, origin_as int")
        full = df.selectExpr("event_time", "'r' AS router_id", "1 AS peer_as", "origin_as", "prefix", "event_type",
                             "'[]' AS as_path", "'n' AS next_hop", "0 AS med", "'[]' AS communities",
                             "cast(unix_micros(cast(event_time AS timestamp)) AS bigint) AS event_id")
        routing_wire(full).coalesce(1).write.mode("append").parquet(wire)

    def write_list(values):
        spark.createDataFrame([(v,) for v in values], "a int").coalesce(1).write.mode("overwrite").parquet(listed)

    def run():
        stream = decode_routing(wire_file_stream(spark, wire))
        query = start_joined_rule(
            stream, as_hijack_rule(()), lambda alerts: not_listed(alerts, alerts.sparkSession.read.parquet(listed), "origin_as"),
            ParquetBatchSink(table, "w", cache=False), os.path.join(workdir, "ck"), CLOCK, {"availableNow": True})
        run_until_drained([query])

    write_list([1])
    frames([(1, 1), (2, 2), (200, 1)])           # the window of 0-60 s closes
    run()
    write_list([2])
    frames([(201, 1), (202, 2), (500, 1)])       # the window of 180-240 s closes
    run()
    rows = spark.read.parquet(table).collect()
    assert sorted((r.origin_as, r.event_count) for r in rows) == [(1, 2), (2, 1)]
