import datetime as dt

from netwatch.operators import BGP, DNS, event_series, recent_alerts

T = dt.datetime(2024, 1, 1)


def test_event_series_orders_nulls_last(spark):
    df = spark.createDataFrame([(T,), (T,), (None,), (T + dt.timedelta(seconds=1),)],
                               "timestamp timestamp_ntz")
    rows = [(r.time, r.event_count) for r in event_series(df).collect()]
    assert rows == [(T, 2), (T + dt.timedelta(seconds=1), 1), (None, 1)]


def test_recent_alerts_top_n_with_ties(spark):
    rows = [(T + dt.timedelta(minutes=i), f"p{i % 3}", None if i % 2 else 7, i, "ROUTE_FLAP",
             "HIGH", T + dt.timedelta(days=1)) for i in range(30)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, prefix string, origin_as int, "
                                     "event_count long, alert_type string, severity string, "
                                     "detected_at timestamp_ntz")
    df = df.withColumn("window_end", df.window_start)
    out = recent_alerts(df, BGP, n=5).collect()
    assert [r.event_count for r in out] == [29, 28, 27, 26, 25]
    assert out[0].asDict().keys() == {"detected_at", "alert_type", "severity", "prefix",
                                      "origin_as", "event_count"}


def test_recent_dns_alerts_newest_detection_first(spark):
    rows = [(T, T, "s1", 1, "DNS_TUNNELING", "CRITICAL", T + dt.timedelta(seconds=i)) for i in range(25)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, "
                                     "source_ip string, event_count long, alert_type string, "
                                     "severity string, detected_at timestamp_ntz")
    out = recent_alerts(df, DNS).collect()
    assert len(out) == 20
    assert out[0].detected_at == T + dt.timedelta(seconds=24)
