"""Joins with reference tables: an allow-list, known prefixes.

The reference side is broadcast only after its rows were counted; beyond the
limit the same join is shuffled. On a stream the joins belong into the
micro-batch (``netwatch.streaming.start_joined_rule``): there the table is
read anew for every batch, so a change takes effect with the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch.functions.prefixes import prefix_block, prefix_parts
from netwatch.functions.time import clock_as
from netwatch.operators.rules import WindowRule, as_hijack_rule
from netwatch.operators.windows import window_column

# A row of either table is a few dozen bytes.
BROADCAST_ROWS = 100_000


def not_listed(rows: DataFrame, listed: DataFrame, column: str,
               broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` whose ``column`` is NOT IN the first column of ``listed``.

    As in SQL: a NULL value is kept by an empty list only, and a list that
    holds a NULL keeps nothing. Spark's own NOT IN is a broadcast of
    unchecked size; here the list is made distinct, counted (one small job),
    and anti-joined by equality.
    """
    values = listed.select(F.col(listed.columns[0]).alias("__listed")).distinct()
    n, nulls = values.agg(F.count(F.lit(1)), F.count_if(F.col("__listed").isNull())).first()
    if not n:
        return rows
    if nulls:
        return rows.filter(F.lit(False))
    side = F.broadcast(values) if n <= broadcast_rows else values
    return (rows.filter(F.col(column).isNotNull())
            .join(side, F.col(column) == F.col("__listed"), "left_anti"))


def hijack_by_table(routing: DataFrame, allowed: DataFrame, clock: str | Column | None = None,
                    rule: WindowRule | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``as_hijack`` with the allow-list as a table.

    The list is applied to the counted groups, whose keys hold the origin:
    the groups of a window are few next to its messages, so a list too large
    to broadcast costs a shuffle of groups, and one origin that sends a
    third of all messages is a few rows there.
    """
    counted = (rule or as_hijack_rule(())).apply(routing, clock)
    return not_listed(counted, allowed, "origin_as", broadcast_rows)


def known_blocks(known: DataFrame, column: str = "prefix") -> DataFrame:
    """__bits, __block, known_prefix: one row per block of addresses; of
    several spellings the smallest. Rows that are no IPv4 prefix are left out."""
    parts = prefix_parts(F.col(column))
    return (known.select(parts.alias("p"), F.col(column).alias("text")).filter("p IS NOT NULL")
            .groupBy(F.col("p.bits").alias("__bits"), prefix_block("p.address", "p.bits").alias("__block"))
            .agg(F.min("text").alias("known_prefix")))


def within_known(rows: DataFrame, known: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` whose ``prefix`` lies in a known prefix or is one, with
    ``known_prefix``, the longest that contains it.

    Containment as an equality: a row is asked for once per length that
    occurs among the known prefixes (33 at most) and is no longer than its
    own, as the block of that length it lies in. ``rows`` are distinct (they
    are counted groups); the longest match is a maximum per row.
    """
    table = known_blocks(known)
    lengths = [r["__bits"] for r in table.select("__bits").distinct().collect()]
    if not lengths:
        return rows.withColumn("known_prefix", F.lit(None).cast("string")).filter(F.lit(False))
    side = F.broadcast(table) if table.limit(broadcast_rows + 1).count() <= broadcast_rows else table
    asked = F.filter(F.array(*map(F.lit, sorted(lengths))), lambda bits: bits <= F.col("__p.bits"))
    blocks = F.transform(asked, lambda bits: F.struct(
        bits.alias("__bits"), prefix_block(F.col("__p.address"), bits).alias("__block")))
    cut = (rows.withColumn("__p", prefix_parts(F.col("prefix"))).filter("__p IS NOT NULL")
           .select(*rows.columns, F.inline(blocks)))
    return (cut.join(side, ["__bits", "__block"]).groupBy(*rows.columns)
            .agg(F.max_by("known_prefix", "__bits").alias("known_prefix")))


def known_prefix_hijack(routing: DataFrame, known: DataFrame, clock: str | Column | None = None,
                        rule: WindowRule | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Unknown origins announcing a known prefix or a part of one: the
    ``as_hijack`` alerts within ``known``, plus ``known_prefix``.

    Groups are counted first and matched before their window is flattened,
    so the maximum per row uses the partitioning of the count: with a
    broadcast table there is one exchange.
    """
    rule = rule or as_hijack_rule()
    rows = routing.filter(rule.predicate())
    counted = (rows.groupBy(window_column(rule.time_column, rule.width, rule.slide).alias("window"), *rule.keys)
               .agg(F.count_if(F.lit(True)).alias("event_count")))
    if rule.threshold is not None:
        counted = counted.filter(F.col("event_count") > rule.threshold)
    found = within_known(counted, known, broadcast_rows)
    detected_at = clock_as(clock, routing, rule.time_column)
    return found.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rule.keys,
        "event_count", F.lit(rule.alert_type).alias("alert_type"), F.lit(rule.severity).alias("severity"),
        detected_at.alias("detected_at"), "known_prefix")
