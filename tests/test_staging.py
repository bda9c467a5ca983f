"""One decode per source: a staged table that the monitor's queries stream from."""

import datetime as dt
import os

from netwatch.cli import parse_args
from netwatch.operators import DNS, BGP, current_alerts, read_table
from netwatch.schemas import TABLE_SCHEMAS, WIRE_SCHEMA
from netwatch.sources import (
    decode_lookups,
    load_table,
    lookup_fixture,
    lookup_wire,
    routing_fixture,
    routing_wire,
    wire_file_stream,
)
from netwatch.streaming import (
    committed_sinks,
    run_until_drained,
    staged_stream,
    start_lookup_monitor,
    start_routing_monitor,
    start_staging,
)

SMALL = "/root/testdata/sf0.001"
CLOCK = "2024-03-01 00:00:00"
ONCE = {"availableNow": True}


def alerts(spark, tables, name, kind):
    return sorted(map(str, current_alerts(read_table(spark, os.path.join(tables, name), TABLE_SCHEMAS[name]), kind).collect()))


def broken_frames(spark, topic, n=5):
    rows = [(None, f"broken {i}".encode(), topic, 0, i, dt.datetime(2024, 1, 1), 0) for i in range(n)]
    return spark.createDataFrame(rows, WIRE_SCHEMA).coalesce(1)


def decodes(query):
    return "from_json" in query._jsq.explainInternal(False)


def run(spark, start, wire, folder, staging=None, **options):
    queries = start(wire_file_stream(spark, wire), os.path.join(folder, "tables"), os.path.join(folder, "ck"), CLOCK,
                    ONCE, staging=staging, **options)
    run_until_drained(queries)
    return queries


def test_tables_are_those_of_separate_decodes(spark, workdir):
    events = load_table(spark, SMALL, "events")
    for start, frames, name, archive, rejects, kind in (
            (start_routing_monitor, routing_wire(routing_fixture(events)), "bgp_alerts", "routing_events", "routing_rejects", BGP),
            (start_lookup_monitor, lookup_wire(lookup_fixture(events)), "dns_alerts", "dns_events", "dns_rejects", DNS)):
        base = os.path.join(workdir, name)
        wire, staging = os.path.join(base, "wire"), os.path.join(base, "staged")
        frames.write.parquet(wire)
        broken_frames(spark, name).write.mode("append").parquet(wire)
        plain, staged = os.path.join(base, "plain"), os.path.join(base, "once")
        apart = run(spark, start, wire, plain)
        queries = run(spark, start, wire, staged, staging)
        assert alerts(spark, f"{staged}/tables", name, kind) == alerts(spark, f"{plain}/tables", name, kind) != []
        for table in (archive, rejects):
            one, other = (sorted(map(str, spark.read.parquet(f"{f}/tables/{table}").drop("run").collect())) for f in (plain, staged))
            assert one == other and one
        # Every frame is decoded once, by the first query; the others parse nothing.
        assert all(map(decodes, apart)) and [decodes(q) for q in queries] == [True] + [False] * len(apart)
        assert spark.read.parquet(os.path.join(staging, queries[0].name)).count() == events.count() + 5


def test_a_restart_goes_on_where_it_stopped(spark, workdir):
    frames = lookup_wire(lookup_fixture(load_table(spark, SMALL, "events")))
    wire, staging = os.path.join(workdir, "wire"), os.path.join(workdir, "staged")
    half = frames.filter("offset % 2 = 0")
    half.repartition(3).write.parquet(wire)
    run(spark, start_lookup_monitor, wire, workdir, staging, files_per_trigger=1)
    # A file that no batch committed is not a part of the staged table.
    spark.read.parquet(f"{staging}/dns_decoded").limit(7).coalesce(1).write.parquet(f"{workdir}/other")
    stray = next(f for f in os.listdir(f"{workdir}/other") if f.endswith(".parquet"))
    with open(f"{workdir}/other/{stray}", "rb") as f, open(f"{staging}/dns_decoded/stray.parquet", "wb") as g:
        g.write(f.read())
    frames.filter("offset % 2 = 1").write.mode("append").parquet(wire)
    run(spark, start_lookup_monitor, wire, workdir, staging, files_per_trigger=1)
    archived = spark.read.parquet(f"{workdir}/tables/dns_events")
    assert archived.count() == frames.count()
    assert archived.select("batch_id").distinct().count() > 2      # files_per_trigger


def test_the_staged_folder_may_be_empty_at_the_start(spark, workdir):
    wire, path = os.path.join(workdir, "wire"), os.path.join(workdir, "staged")
    frames = lookup_wire(lookup_fixture(load_table(spark, SMALL, "events")))
    frames.write.parquet(wire)
    decoded = decode_lookups(wire_file_stream(spark, wire), keep_raw=True)
    trigger = {"processingTime": "1 second"}
    reader = (staged_stream(spark, path, decoded.schema).select("source_ip").writeStream.format("parquet")
              .option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/ck_out").trigger(**trigger).start())
    try:
        reader.processAllAvailable()
        writer = start_staging(decoded, path, f"{workdir}/dns_decoded", trigger, retention="7d")
        try:
            writer.processAllAvailable()
            assert writer.name == "dns_decoded"
        finally:
            writer.stop()
        reader.processAllAvailable()
    finally:
        reader.stop()
    assert spark.read.parquet(f"{workdir}/out").count() == frames.count()


def test_staging_next_to_committed_tables(spark, workdir):
    events = load_table(spark, SMALL, "events")
    wire = os.path.join(workdir, "wire")
    lookup_wire(lookup_fixture(events)).write.parquet(wire)
    run(spark, start_lookup_monitor, wire, workdir, os.path.join(workdir, "staged"), fuse_windowed=True,
        sinks=committed_sinks(os.path.join(workdir, "tables")))
    assert read_table(spark, f"{workdir}/tables/dns_events", TABLE_SCHEMAS["dns_events"]).count() == events.count()
    assert alerts(spark, f"{workdir}/tables", "dns_alerts", DNS)


def test_arguments():
    args = parse_args(["lookups", "--wire-path", "/w", "--tables", "/t", "--staging", "/s", "--committed"])
    assert args.staging == "/s" and args.committed
    assert parse_args(["lookups", "--wire-path", "/w", "--tables", "/t"]).staging is None
