import json

from pyspark.sql import functions as F

from netwatch.schemas import WIRE_SCHEMA
from netwatch.sources import decode_lookups, decode_routing, split_rejects


def wire(spark, values):
    rows = [(None, None if v is None else v.encode(), "t", 0, i, None, 0)
            for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, WIRE_SCHEMA)
    return df.withColumn("timestamp", F.expr("TIMESTAMP'2024-01-01 00:00:00'"))


GOOD_BGP = {"timestamp": "2024-01-01T00:00:00+00:00", "router_id": "10.0.0.1", "peer_as": 174,
            "origin_as": 3356, "prefix": "1.1.1.0/24", "event_type": "ANNOUNCE",
            "as_path": [3356, 174], "next_hop": "192.168.0.1", "med": 5,
            "communities": ["1:2"]}


def test_routing_edge_rows(spark):
    values = [
        json.dumps(GOOD_BGP),
        "not json",
        None,
        json.dumps([GOOD_BGP, GOOD_BGP]),
        json.dumps({**GOOD_BGP, "peer_as": 99999999999}),
        json.dumps({**GOOD_BGP, "peer_as": "174"}),
        json.dumps({**GOOD_BGP, "peer_as": 1.5}),
        json.dumps({**GOOD_BGP, "extra": True}),
    ]
    rows = decode_routing(wire(spark, values)).collect()
    assert len(rows) == len(values)          # nothing is dropped
    good = rows[0]
    assert (good.peer_as, good.origin_as, good.prefix) == (174, 3356, "1.1.1.0/24")
    assert good.as_path == "[3356,174]"      # list kept as its JSON text
    assert good.event_time is not None       # broker time
    for bad in rows[1:4]:
        assert bad.prefix is None and bad.peer_as is None
    for r in rows[4:7]:
        assert r.peer_as is None and r.prefix == "1.1.1.0/24"
    assert rows[7].peer_as == 174


def test_routing_typed_lists_and_payload_time(spark):
    rows = decode_routing(wire(spark, [json.dumps(GOOD_BGP)]), typed_lists=True,
                          event_time="payload").collect()
    assert rows[0].as_path == [3356, 174] and rows[0].communities == ["1:2"]


def test_lookup_decode_enriches_and_rejects(spark):
    good = {"timestamp": "2024-01-01T00:00:01+00:00", "source_ip": "s", "queried_domain": "google.com",
            "query_type": "A", "response_code": "NOERROR", "ttl": 60, "entropy": 2.646,
            "response_time": 3.2, "is_suspicious": False}
    values = [json.dumps(good), json.dumps({**good, "timestamp": "x", "entropy": None}), "{"]
    decoded = decode_lookups(wire(spark, values), keep_raw=True)
    rows = decoded.collect()
    assert rows[0].domain_length == 10 and rows[0].entropy == 2.646
    assert rows[1].event_time is None and rows[1].entropy == 2.646   # recomputed
    assert "response_time" not in decoded.columns
    ok, rejected = split_rejects(decoded)
    assert ok.count() == 1
    rej = rejected.collect()
    assert len(rej) == 2 and {r.reject_reason for r in rej} == {"missing event_time"}
    assert rej[-1].raw_value == "{"


def test_decode_only_the_fields_a_rule_reads(spark):
    from netwatch.operators import route_flap_rule
    rule = route_flap_rule()
    out = decode_routing(wire(spark, [json.dumps(GOOD_BGP)]), fields=rule.fields)
    assert out.columns == ["prefix", "event_type", "kafka_ts", "event_time"]
    assert rule.apply(out).columns[:3] == ["window_start", "window_end", "prefix"]
    lookups = decode_lookups(wire(spark, ['{"timestamp":"2024-01-01T00:00:01+00:00",'
                                          '"source_ip":"s","response_code":"NXDOMAIN"}']),
                             fields=("source_ip", "response_code"))
    assert set(lookups.columns) == {"timestamp", "source_ip", "response_code", "event_time"}
    assert rule.with_params(predicate=lambda: F.lit(True)).fields is None
    assert rule.with_params(threshold=1).fields == rule.fields
