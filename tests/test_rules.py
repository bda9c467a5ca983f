import datetime as dt
import random

from netwatch.operators import (
    amplification_rule,
    as_hijack_rule,
    bgp_alerts,
    dns_alerts,
    dns_tunneling_rule,
    nxdomain_storm_rule,
    route_flap_rule,
    union_alerts,
    windowed_counts,
)

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
CLOCK = "2024-02-01 00:00:00"


def routing(spark, rows):
    """rows: (seconds after T0 or None, prefix, event_type, origin_as)"""
    data = [(None if s is None else T0 + dt.timedelta(seconds=s), p, e, o) for s, p, e, o in rows]
    return spark.createDataFrame(data, "event_time timestamp_ntz, prefix string, event_type string, origin_as int")


def lookups(spark, rows):
    """rows: (seconds or None, source_ip, response_code, query_type, domain_length, entropy)"""
    data = [(None if s is None else T0 + dt.timedelta(seconds=s), *rest) for s, *rest in rows]
    return spark.createDataFrame(
        data, "event_time timestamp_ntz, source_ip string, response_code string, "
              "query_type string, domain_length int, entropy double")


def test_flap_threshold_is_strict(spark):
    five = [(i, "p5", "ANNOUNCE", 1) for i in range(5)]
    six = [(i, "p6", "WITHDRAW" if i % 2 else "ANNOUNCE", 1) for i in range(6)]
    noise = [(i, "p6", "PATH_CHANGE", 1) for i in range(10)]
    out = route_flap_rule().apply(routing(spark, five + six + noise), CLOCK).collect()
    assert [(r.prefix, r.event_count, r.origin_as, r.alert_type, r.severity) for r in out] == [
        ("p6", 6, None, "ROUTE_FLAP", "HIGH")]
    assert str(out[0].window_start) == "2024-01-01 00:00:00"
    assert str(out[0].window_end) == "2024-01-01 00:01:00"
    assert str(out[0].detected_at) == CLOCK


def test_window_edge_belongs_to_next_window(spark):
    rows = [(59.999999, "p", "ANNOUNCE", 1)] + [(60, "p", "ANNOUNCE", 1)] * 6
    out = route_flap_rule().apply(routing(spark, rows), CLOCK).collect()
    assert [(str(r.window_start), r.event_count) for r in out] == [("2024-01-01 00:01:00", 6)]


def test_hijack_allow_list_and_null_origin(spark):
    rows = [(1, "p", "ANNOUNCE", 15169), (2, "p", "ANNOUNCE", 64512), (3, "p", "ANNOUNCE", 64512),
            (4, "p", "ANNOUNCE", None), (5, "p", "WITHDRAW", 64513)]
    out = as_hijack_rule().apply(routing(spark, rows), CLOCK).collect()
    assert [(r.origin_as, r.event_count, r.alert_type, r.severity) for r in out] == [
        (64512, 2, "BGP_HIJACK", "CRITICAL")]


def test_sliding_window_counts_each_row_three_times(spark):
    rows = [(15, "s", "NXDOMAIN", "A", 1, 1.0)] * 101
    out = nxdomain_storm_rule().apply(lookups(spark, rows), CLOCK).orderBy("window_start").collect()
    starts = [r.window_start.strftime("%H:%M:%S") for r in out]
    assert starts == ["23:59:50", "00:00:00", "00:00:10"]
    assert {r.event_count for r in out} == {101}


def test_amplification_strict_threshold(spark):
    rows = [(1, "a", "NOERROR", "ANY", 1, 1.0)] * 50 + [(1, "b", "NOERROR", "TXT", 1, 1.0)] * 51
    out = amplification_rule().apply(lookups(spark, rows), CLOCK).collect()
    assert {(r.source_ip, r.event_count, r.severity) for r in out} == {("b", 51, "MEDIUM")}


def test_tunneling_three_valued_logic(spark):
    rows = [
        (1, "exact", "NOERROR", "A", 50, 3.5),     # both on the bound: no
        (1, "long", "NOERROR", "A", 51, 1.0),      # yes
        (1, "nullhi", "NOERROR", "A", None, 3.6),  # NULL OR true: yes
        (1, "nulllo", "NOERROR", "A", None, 3.0),  # NULL OR false: no
        (1, "nulls", "NOERROR", "A", None, None),  # no
    ]
    out = dns_tunneling_rule().apply(lookups(spark, rows), CLOCK).collect()
    assert sorted(r.source_ip for r in out) == ["long", "nullhi"]
    r = out[0]
    assert r.window_start == r.window_end == r.detected_at
    assert r.event_count == 1 and r.alert_type == "DNS_TUNNELING"


def _random_lookups(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = [(rnd.uniform(-50, 400), f"h{rnd.randrange(4)}", rnd.choice(["NXDOMAIN", "NOERROR"]),
             rnd.choice(["A", "ANY", "TXT"]), rnd.randrange(30, 70), rnd.uniform(2, 4))
            for _ in range(n)]
    rows += [(None, "h0", "NXDOMAIN", "ANY", 60, 3.9)] * 30     # no event time
    return lookups(spark, rows)


def test_fused_dns_alerts_equal_union_of_rules(spark):
    df = _random_lookups(spark)
    storm = nxdomain_storm_rule(threshold=10)
    amp = amplification_rule(threshold=20)
    fused = dns_alerts(df, CLOCK, storm=storm, amplification=amp)
    separate = union_alerts([storm.apply(df, CLOCK), dns_tunneling_rule().apply(df, CLOCK),
                             amp.apply(df, CLOCK)])
    assert fused.count() == separate.count() > 0
    assert fused.exceptAll(separate).count() == 0


def test_fused_bgp_alerts_equal_union_of_rules(spark):
    rnd = random.Random(3)
    rows = [(rnd.uniform(0, 300), f"p{rnd.randrange(5)}",
             rnd.choice(["ANNOUNCE", "WITHDRAW", "PATH_CHANGE"]),
             rnd.choice([15169, 64512, 64513, None])) for _ in range(2000)]
    rows += [(None, "p0", "ANNOUNCE", 64512)] * 30      # no event time: in no window
    df = routing(spark, rows)
    flap, hijack = route_flap_rule(threshold=20), as_hijack_rule()
    fused = bgp_alerts(df, CLOCK, flap=flap, hijack=hijack)
    separate = union_alerts([flap.apply(df, CLOCK), hijack.apply(df, CLOCK)])
    assert fused.count() == separate.count() > 0
    assert fused.exceptAll(separate).count() == 0
    assert fused.columns == separate.columns


def test_hot_key_is_counted_whole(spark):
    # One source holds most rows; counts must still be exact.
    rows = [(i % 30, "hot", "NXDOMAIN", "A", 1, 1.0) for i in range(3000)]
    rows += [(i % 30, f"c{i % 7}", "NXDOMAIN", "A", 1, 1.0) for i in range(700)]
    df = lookups(spark, rows).repartition(8)
    out = {(r.source_ip, r.window_start.strftime("%H:%M:%S")): r.event_count
           for r in nxdomain_storm_rule(threshold=0).apply(df, CLOCK).collect()}
    assert out[("hot", "00:00:00")] == 3000
    assert out[("hot", "23:59:50")] == 2000


def test_rule_parameters(spark):
    rows = [(i, "p", "ANNOUNCE", 1) for i in range(3)]
    out = route_flap_rule(threshold=2, width="10 seconds").apply(routing(spark, rows), CLOCK)
    assert out.count() == 1
    assert route_flap_rule().with_params(threshold=9).threshold == 9


def test_processing_time_clock(spark):
    rows = [(1, "x", "NOERROR", "A", 60, 1.0)]
    out = dns_tunneling_rule().apply(lookups(spark, rows)).first()
    assert out.detected_at is not None and out.window_start == out.detected_at
    assert abs((out.detected_at - dt.datetime.now(dt.UTC).replace(tzinfo=None)).total_seconds()) < 600


def test_sliding_counts_match_brute_force(spark):
    from collections import Counter
    rnd = random.Random(11)
    # whole-second times (many on bucket edges) and fractional ones
    seconds = [rnd.choice([rnd.randrange(-40, 120), rnd.uniform(-40, 120)]) for _ in range(800)]
    keys = [rnd.choice("abc") for _ in seconds]
    expected = Counter()
    for s, k in zip(seconds, keys):
        us = round(s * 1_000_000)
        pane = (us // 10_000_000) * 10_000_000           # floor, also below zero
        for back in range(3):                            # windows of 30 s every 10 s
            expected[(pane - back * 10_000_000, k)] += 1
    df = lookups(spark, [(s, k, "NXDOMAIN", "A", 1, 1.0) for s, k in zip(seconds, keys)])
    t0_us = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    got = {}
    for r in windowed_counts(df, "event_time", ["source_ip"], "30 seconds", "10 seconds").collect():
        start = r.window_start.replace(tzinfo=dt.timezone.utc).timestamp()
        got[(round(start * 1_000_000) - t0_us, r.source_ip)] = r.event_count
        assert (r.window_end - r.window_start).total_seconds() == 30
    assert got == dict(expected)


def test_storm_threshold_is_strict(spark):
    rows = [(5, "at", "NXDOMAIN", "A", 1, 1.0)] * 100 + [(5, "over", "NXDOMAIN", "A", 1, 1.0)] * 101
    out = nxdomain_storm_rule().apply(lookups(spark, rows), CLOCK).collect()
    assert {r.source_ip for r in out} == {"over"}
    assert {r.event_count for r in out} == {101} and {r.severity for r in out} == {"HIGH"}
