"""Command line: run the routing or the lookup monitor.

    python -m netwatch.cli routing --bootstrap kafka:29092 --tables /shared/tables
    python -m netwatch.cli lookups --wire-path /shared/raw/dns --tables /shared/tables --once

The source is a Kafka topic (``--bootstrap``; the connector must be on the
classpath) or a folder of stored wire frames (``--wire-path``: parquet
with the Kafka columns), which replays archived traffic through the same
queries. ``--once`` processes what is there and exits. Checkpoints default
to a fixed folder below the session's ``spark.checkpoint.dir`` so a restart
resumes where the last run committed.
"""

from __future__ import annotations

import argparse
import os

from netwatch.operators.rules import (
    KNOWN_ORIGIN_AS,
    EventRule,
    WindowRule,
    amplification_rule,
    as_hijack_rule,
    dns_tunneling_rule,
    nxdomain_storm_rule,
    path_anomaly_rule,
    route_flap_rule,
)
from netwatch.operators.metrics import lookup_metrics, routing_metrics
from netwatch.session import build_session, shared_root
from netwatch.sources.wire import BGP_TOPIC, DNS_TOPIC, kafka_stream, wire_file_stream
from netwatch.streaming.committed import committed_sinks
from netwatch.streaming.runner import (
    await_any,
    jdbc_sinks,
    parquet_sinks,
    run_until_drained,
    start_lookup_monitor,
    start_routing_monitor,
)
from netwatch.streaming.topics import kafka_publisher, topic_sinks


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="netwatch")
    p.add_argument("monitor", choices=["routing", "lookups"])
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap", help="Kafka bootstrap servers")
    source.add_argument("--wire-path", help="folder of stored wire frames (parquet)")
    p.add_argument("--topic", help="topic (default: the monitor's raw topic)")
    p.add_argument("--tables", help="shared folder for the output tables (parquet)")
    p.add_argument("--jdbc-url", help="write to database tables instead of --tables")
    p.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE",
                   help="connection property (user, password, driver, ...); repeatable")
    p.add_argument("--jdbc-batch-column", help="batch-id column of the tables: replays are then idempotent")
    p.add_argument("--checkpoints", help="checkpoint folder (default: below spark.checkpoint.dir)")
    p.add_argument("--trigger", default="10 seconds", help="processing-time trigger")
    p.add_argument("--once", action="store_true", help="process what is available, then exit")
    p.add_argument("--max-files-per-trigger", type=int, default=256,
                   help="file source: files per batch (bounds what one batch caches)")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int, default=10_000_000,
                   help="Kafka: records per batch (bounds a catch-up after downtime)")
    p.add_argument("--fuse-windowed", action="store_true",
                   help="count the windowed rules of the monitor in one stateful query")
    p.add_argument("--metrics", action="store_true", help="also fill the table aggregated_metrics")
    p.add_argument("--alert-topics", action="store_true",
                   help="also send alerts to the topics bgp_alerts / dns_alerts (needs --bootstrap)")
    p.add_argument("--committed", action="store_true",
                   help="parquet tables with a list of committed batches (compact_days, vacuum)")
    p.add_argument("--staging", metavar="FOLDER",
                   help="decode each frame once into a table there, from which the other queries stream")
    p.add_argument("--state-partitions", type=int, default=200,
                   help="partitions of the state stores; fixed at the first checkpoint")
    rules = p.add_argument_group("rule parameters (defaults: each rule's own)")
    rules.add_argument("--threshold", action="append", default=[], metavar="RULE=N")
    rules.add_argument("--width", action="append", default=[], metavar="RULE=DURATION")
    rules.add_argument("--slide", action="append", default=[], metavar="RULE=DURATION")
    rules.add_argument("--watermark", action="append", default=[], metavar="RULE=DURATION")
    rules.add_argument("--known-origins", help="comma-separated AS numbers that may originate any prefix")
    rules.add_argument("--path-anomalies", action="store_true",
                       help="routing: alert on paths with an unexpected AS")
    rules.add_argument("--max-name-length", type=int, default=50)
    rules.add_argument("--max-entropy", type=float, default=3.5)
    args = p.parse_args(argv)
    if args.alert_topics and not args.bootstrap:
        p.error("--alert-topics needs --bootstrap")
    if bool(args.tables) == bool(args.jdbc_url):
        p.error("name either --tables or --jdbc-url")
    if args.committed and not args.tables:
        p.error("--committed needs --tables")
    try:
        args.rules = build_rules(args)
    except (KeyError, ValueError) as error:
        p.error(f"rule parameters: {error}")
    return args


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def build_rules(args: argparse.Namespace) -> list[WindowRule | EventRule]:
    """The monitor's rules with the parameters of the command line."""
    if args.monitor == "routing":
        origins = [int(x) for x in args.known_origins.split(",")] if args.known_origins else KNOWN_ORIGIN_AS
        rules = [route_flap_rule(), as_hijack_rule(origins)]
        if args.path_anomalies:
            rules.append(path_anomaly_rule())
    else:
        rules = [nxdomain_storm_rule(), dns_tunneling_rule(args.max_name_length, args.max_entropy),
                 amplification_rule()]
    by_name = {r.name: i for i, r in enumerate(rules)}
    for field in ("threshold", "width", "slide", "watermark"):
        for name, value in _pairs(getattr(args, field)).items():
            rule = rules[by_name[name]]
            if not isinstance(rule, WindowRule):
                raise ValueError(f"{name} has no {field}")
            rules[by_name[name]] = rule.with_params(**{field: int(value) if field == "threshold" else value})
    return rules


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = build_session(app_name=f"netwatch-{args.monitor}", conf={
        "spark.sql.shuffle.partitions": str(args.state_partitions),
    })
    if args.bootstrap:
        topic = args.topic or (BGP_TOPIC if args.monitor == "routing" else DNS_TOPIC)
        wire = kafka_stream(spark, args.bootstrap, topic, args.starting_offsets, False,
                            {"maxOffsetsPerTrigger": str(args.max_offsets_per_trigger)})
    else:
        wire = wire_file_stream(spark, args.wire_path, args.max_files_per_trigger)
    checkpoints = args.checkpoints or os.path.join(shared_root(spark), "netwatch", "checkpoints",
                                                   args.monitor)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    sinks = None
    if args.jdbc_url:
        sinks = jdbc_sinks(args.jdbc_url, _pairs(args.jdbc_property), args.jdbc_batch_column)
    elif args.committed:
        sinks = committed_sinks(args.tables)
    if args.alert_topics:
        sinks = topic_sinks(kafka_publisher(args.bootstrap), sinks or parquet_sinks(args.tables))
    metrics = None
    if args.metrics:
        metrics = routing_metrics() if args.monitor == "routing" else lookup_metrics()
    start = start_routing_monitor if args.monitor == "routing" else start_lookup_monitor
    queries = start(wire, args.tables, checkpoints, None, trigger, rules=args.rules,
                    fuse_windowed=args.fuse_windowed, sinks=sinks, metrics=metrics,
                    staging=args.staging, files_per_trigger=args.max_files_per_trigger)
    if args.once:
        run_until_drained(queries)
    else:
        await_any(spark, queries)


if __name__ == "__main__":
    main()
