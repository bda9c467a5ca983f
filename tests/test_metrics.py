import datetime as dt
import json
import os
import random
import re

import pytest

from netwatch.operators import (
    MetricSet,
    count_of,
    distinct_of,
    lookup_metrics,
    mean_of,
    register_tables,
    routing_metrics,
    share_of,
)
from netwatch.functions.prefixes import unexpected_path_as
from netwatch.operators import path_anomaly_rule, route_flap_rule
from netwatch.plans.catalog import QUERIES
from netwatch.sources import load_table, lookup_fixture, lookup_wire, routing_fixture, routing_wire, wire_file_stream
from netwatch.streaming import run_until_drained, start_lookup_monitor, start_routing_monitor
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
ROOT = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(None if s is None else T0 + dt.timedelta(seconds=s), *r) for s, *r in rows],
                                 "event_time timestamp_ntz, host string, kind string, size double")


def test_measures_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(150)]), rng.choice(["a", "b", None]), rng.choice(["x", "y", None]),
             rng.choice([None, 1.5, 2.5])) for _ in range(500)]
    wanted = MetricSet("m", (count_of("n"), count_of("n_x", lambda: F.col("kind") == "x"),
                             share_of("x_share", lambda: F.col("kind") == "x"), distinct_of("kinds", "kind"),
                             mean_of("size", "size")), ("host",))
    got = {(r.window_start, r.metric_type, r.labels): r.metric_value for r in wanted.apply(frame(spark, rows)).collect()}
    want = {}
    groups = {}
    for s, host, kind, size in rows:
        if s is not None:
            groups.setdefault((T0 + dt.timedelta(seconds=s // 60 * 60), host), []).append((kind, size))
    for (start, host), found in groups.items():
        label = json.dumps({"host": host}, separators=(",", ":"))
        x = sum(k == "x" for k, _ in found)
        sizes = [v for _, v in found if v is not None]
        for name, value in (("n", len(found)), ("n_x", x), ("x_share", x / len(found)),
                            ("kinds", len({k for k, _ in found if k})), ("size", sum(sizes) / len(sizes) if sizes else None)):
            if value is not None:
                want[start, name, label] = pytest.approx(value)
    assert got == want and len({k[2] for k in got}) == 3


def test_a_measure_without_value_and_a_table_without_rows(spark):
    rows = frame(spark, [(1, "a", None, None)])
    got = MetricSet("m", (mean_of("size", "size"), distinct_of("kinds", "kind"))).apply(rows).collect()
    assert [(r.metric_type, r.metric_value, r.labels) for r in got] == [("kinds", 0.0, "{}")]
    assert routing_metrics().apply(routing_fixture(load_table(spark, ROOT, "events")).limit(0)).collect() == []


def test_distinct_counts_stay_exact_up_to_the_bound(spark):
    df = spark.range(60_000).selectExpr(f"TIMESTAMP_NTZ'{T0}' AS event_time", "cast(id AS string) AS kind")
    df = df.unionByName(df)
    got = MetricSet("m", (distinct_of("kinds", "kind"),)).apply(df).collect()
    assert [r.metric_value for r in got] == [60_000.0]


def test_all_measures_of_a_set_share_one_exchange(spark, capsys):
    for metrics, events in ((routing_metrics(), routing_fixture), (lookup_metrics(), lookup_fixture)):
        capsys.readouterr()
        metrics.apply(events(load_table(spark, ROOT, "events"))).explain("formatted")
        text = capsys.readouterr().out
        assert len(re.findall(r"Arguments: hashpartitioning", text)) == 1
        assert len(re.findall(r"\(\d+\) Scan parquet", text)) == 1
        assert "Expand" not in text and "partial_" in text


def test_monitors_fill_the_metrics_table(spark, workdir):
    events = load_table(spark, ROOT, "events")
    tables, once = os.path.join(workdir, "tables"), {"availableNow": True}
    for kind, frames, start, metrics in (
            ("bgp", routing_wire(routing_fixture(events)), start_routing_monitor, routing_metrics()),
            ("dns", lookup_wire(lookup_fixture(events)), start_lookup_monitor, lookup_metrics("10 seconds"))):
        wire = os.path.join(workdir, kind)
        frames.write.parquet(wire)
        queries = start(wire_file_stream(spark, wire), tables, os.path.join(workdir, f"ck_{kind}"), None, once,
                        metrics=metrics)
        assert metrics.name in {q.name for q in queries}
        run_until_drained(queries)
    assert "aggregated_metrics" in register_tables(spark, tables)
    found = spark.sql("SELECT metric_type, count(*) AS n, sum(metric_value) AS s FROM aggregated_metrics GROUP BY 1")
    found = {r.metric_type: (r.n, r.s) for r in found.collect()}
    assert {"bgp_updates", "bgp_distinct_prefixes", "dns_queries", "dns_nxdomain_share"} <= set(found)
    # Closed windows only, and each event once.
    batch = routing_metrics().apply(routing_fixture(events)).filter("metric_type = 'bgp_updates'")
    last = batch.agg(F.max("window_end")).first()[0]
    closed = batch.filter(F.col("window_end") < F.lit(last)).agg(F.count("*"), F.sum("metric_value")).first()
    assert found["bgp_updates"][0] >= closed[0] - 1 and found["bgp_updates"][1] <= batch.agg(F.sum("metric_value")).first()[0]


@pytest.mark.parametrize("path, typed, found", [
    ("[15169,3356]", False, []), ("[15169,60001,3356]", False, [60001]), ("[1,2,1,null]", False, [1, 2]),
    ("[]", False, []), ("oops", False, None), (None, False, None), ([15169, 64999], True, [64999]), ([], True, []),
    (None, True, None),
])
def test_unexpected_path_as(spark, path, typed, found):
    df = spark.createDataFrame([(path,)], "p array<int>" if typed else "p string")
    assert df.select(unexpected_path_as("p", [15169, 3356], typed)).first()[0] == found


def test_path_rule_on_text_and_typed_paths(spark):
    text = routing_fixture(load_table(spark, ROOT, "events"))
    typed = text.withColumn("as_path", F.from_json("as_path", "array<int>"))
    rows = path_anomaly_rule().apply(text, "2024-02-01 00:00:00")
    assert rows.count() == text.filter("event_type = 'PATH_CHANGE'").count() > 0
    assert rows.exceptAll(path_anomaly_rule(typed=True).apply(typed, "2024-02-01 00:00:00")).count() == 0
    assert {(r.alert_type, r.severity, r.event_count) for r in rows.collect()} == {("PATH_ANOMALY", "HIGH", 1)}


def test_per_event_rules_share_the_stateless_query(spark, workdir):
    wire = os.path.join(workdir, "wire")
    routing_wire(routing_fixture(load_table(spark, ROOT, "events"))).write.parquet(wire)
    queries = start_routing_monitor(wire_file_stream(spark, wire), os.path.join(workdir, "t"), os.path.join(workdir, "c"),
                                    None, {"availableNow": True}, rules=[route_flap_rule(), path_anomaly_rule()])
    assert sorted(q.name for q in queries) == ["route_flap", "routing_stateless"]
    run_until_drained(queries)
    register_tables(spark, os.path.join(workdir, "t"))
    got = spark.sql("SELECT count(*) AS n FROM current_bgp_alerts WHERE alert_type = 'PATH_ANOMALY'").first().n
    assert got == QUERIES["path_anomaly"](spark, ROOT).count()
