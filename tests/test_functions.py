import math
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netwatch.functions import (
    name_length,
    parse_event_time,
    pseudonymise,
    shannon_entropy,
    utc_instant,
    utc_wall_clock,
)


def entropy_by_hand(s):
    if not s:
        return 0.0
    n = len(s)
    return round(-sum((k / n) * math.log2(k / n) for k in Counter(s).values()), 3)


def test_entropy_known_values(spark):
    df = spark.createDataFrame(
        [("google.com",), ("stackoverflow.com",), ("",), (None,), ("aaaa",), ("ab",)], "s string")
    got = [r.e for r in df.select(shannon_entropy("s").alias("e")).collect()]
    assert got == [2.646, 3.69, 0.0, 0.0, 0.0, 1.0]


def test_entropy_rounds_exact_ties_half_even(spark):
    name = "aabbcc" + "defghijklmnopqrstuvwxyz012"          # 32 chars, H = 4.8125
    df = spark.createDataFrame([(name,)], "s string")
    assert df.select(shannon_entropy("s").alias("e")).first().e == entropy_by_hand(name) == 4.812


def test_entropy_counts_code_points(spark):
    df = spark.createDataFrame([("a\U0001F600b\U0001F600",)], "s string")
    row = df.select(shannon_entropy("s").alias("e"), name_length("s").alias("n")).first()
    assert row.n == 4
    assert row.e == entropy_by_hand("a\U0001F600b\U0001F600") == 1.5


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abcdef0123456789.-xyz", max_size=80), min_size=1, max_size=40))
def test_entropy_matches_brute_force(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r.e for r in df.select(shannon_entropy("s").alias("e")).collect()]
    assert got == [entropy_by_hand(w) for w in words]


def test_pseudonymise(spark):
    df = spark.createDataFrame([("192.168.1.1",), (None,)], "ip string")
    rows = df.select(pseudonymise("ip").alias("p"),
                     pseudonymise("ip", salt="k").alias("q")).collect()
    assert rows[0].p == "c5eb5a4cc76a5cdb"
    assert rows[0].q != rows[0].p and len(rows[0].q) == 16
    assert rows[1].p is None


def test_name_length(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,)], "s string")
    assert [r.n for r in df.select(name_length("s").alias("n")).collect()] == [3, 0, None]


def test_parse_event_time_is_lenient(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:00.123456+00:00",), ("x",), (None,), ("2024-01-01T02:00:00+02:00",)],
        "s string")
    rows = df.select(utc_wall_clock(parse_event_time("s")).alias("t")).collect()
    assert str(rows[0].t) == "2024-01-01 00:00:00.123456"
    assert rows[1].t is None and rows[2].t is None
    assert str(rows[3].t) == "2024-01-01 00:00:00"


def test_utc_round_trip(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-05 06:07:08.000009' AS t")
    row = df.select(utc_wall_clock(utc_instant("t")).alias("back"),
                    F.unix_micros(utc_instant("t")).alias("us")).first()
    assert str(row.back) == "2024-03-05 06:07:08.000009"
    assert row.us == 1709618828000009
