"""Plan shape: the scale properties the design relies on."""

import os
import re

from netwatch.plans.catalog import QUERIES
from netwatch.operators import route_flap_rule
from netwatch.sources import decode_routing, load_table, routing_fixture, routing_wire

ROOT = "/root/testdata/sf0.001"


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def hash_exchanges(text):
    return len(re.findall(r"Arguments: hashpartitioning", text))


def scans(text):
    return len(re.findall(r"\(\d+\) Scan parquet", text))


def test_route_flap_aggregates_map_side(spark, capsys):
    text = plan(QUERIES["route_flap"](spark, ROOT), capsys)
    assert "partial_count" in text
    assert hash_exchanges(text) == 1
    # only the columns the rule needs reach the reader
    read = re.search(r"ReadSchema: (struct<[^\n]*>)", text).group(1)
    assert "props" not in read and "value" not in read


def test_bgp_alerts_is_one_scan_and_one_exchange(spark, capsys):
    text = plan(QUERIES["bgp_alerts"](spark, ROOT), capsys)
    assert scans(text) == 1
    assert hash_exchanges(text) == 1
    assert "Generate" in text and "Expand" not in text and "Union" not in text


def test_dns_alerts_counts_both_windowed_rules_in_one_exchange(spark, capsys):
    text = plan(QUERIES["dns_alerts"](spark, ROOT), capsys)
    assert hash_exchanges(text) == 1
    assert scans(text) == 2          # windowed counts + per-event tunneling


def test_recent_alerts_is_a_top_k(spark, capsys):
    text = plan(QUERIES["recent_bgp_alerts"](spark, ROOT), capsys)
    assert "TakeOrderedAndProject" in text


def test_decoded_frames_are_parsed_once(spark, capsys, workdir):
    wire_path = os.path.join(workdir, "wire")
    routing_wire(routing_fixture(load_table(spark, ROOT, "events"))).write.parquet(wire_path)
    decoded = decode_routing(spark.read.parquet(wire_path))
    text = plan(route_flap_rule().apply(decoded, "2024-02-01 00:00:00"), capsys)
    physical = text.split("\n\n")[0]
    assert "Generate" in physical
    assert len(re.findall(r"from_json\(", text)) == 1


def test_fused_routing_shuffles_no_more_than_its_rules(spark):
    """Rows that reach the exchange: one per group and task, and only for
    groups some rule counts."""
    from pyspark.sql import functions as F
    from netwatch.operators import as_hijack_rule, window_groups

    routing = routing_fixture(load_table(spark, ROOT, "events"))
    fused = window_groups(routing, [route_flap_rule(), as_hijack_rule()]).count()
    apart = [r.with_params(threshold=None).apply(routing, "2024-02-01 00:00:00").count()
             for r in (route_flap_rule(), as_hijack_rule())]
    assert fused == sum(apart)
    assert QUERIES["bgp_alerts"](spark, ROOT).filter(F.col("event_count") == 0).count() == 0


def test_no_plan_deals_rows_round_robin(spark, capsys):
    for name, query in QUERIES.items():
        if not name.startswith("stream_"):
            assert "RoundRobinPartitioning" not in plan(query(spark, ROOT), capsys), name


def test_date_filter_skips_other_days(spark, capsys, workdir):
    from pyspark.sql import functions as F
    from netwatch.operators import read_table, routing_events
    from netwatch.schemas import ROUTING_EVENTS_SCHEMA
    from netwatch.streaming import ParquetBatchSink

    rows = routing_events(routing_fixture(load_table(spark, ROOT, "events")))
    rows = rows.withColumn("timestamp", F.timestamp_add("DAY", F.col("med") % 3, F.col("timestamp")).cast("timestamp"))
    ParquetBatchSink(workdir, "archive", date_column="timestamp")(rows, 0)
    table = read_table(spark, workdir, ROUTING_EVENTS_SCHEMA)
    one = table.filter("event_date = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(event_date" in plan(one, capsys)
    assert 0 < one.count() < table.count() == rows.count()
