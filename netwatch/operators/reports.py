"""Dashboard reports over the archive and alert tables."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.operators.rules import BGP, DNS
from netwatch.schemas import TABLE_SCHEMAS, stored
from netwatch.sources.manifest import is_committed, read_committed


def event_series(events: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Events per distinct timestamp, ascending (NULL time last, as the
    dashboard database sorts it)."""
    return (events.groupBy(F.col(time_column).alias("time"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.asc_nulls_last("time")))


def recent_alerts(alerts: DataFrame, kind: str, n: int = 20) -> DataFrame:
    """The ``n`` latest alerts by detection time.

    The top-k is the feature here. All alerts of one batch share a
    detection time, so ties are broken by the newest window and then by the
    remaining columns, which makes the chosen rows a function of the data.
    The plan is a per-partition top-n and one small merge.
    """
    if kind == BGP:
        shown = ["detected_at", "alert_type", "severity", "prefix", "origin_as", "event_count"]
        order = [F.desc_nulls_first("detected_at"), F.desc_nulls_first("window_start"),
                 F.desc_nulls_first("window_end"), F.asc_nulls_last("alert_type"),
                 F.asc_nulls_last("severity"), F.asc_nulls_last("prefix"),
                 F.asc_nulls_last("origin_as"), F.desc_nulls_first("event_count")]
    else:
        shown = ["detected_at", "alert_type", "severity", "source_ip", "event_count"]
        order = [F.desc_nulls_first("detected_at"), F.desc_nulls_first("window_start"),
                 F.desc_nulls_first("window_end"), F.asc_nulls_last("alert_type"),
                 F.asc_nulls_last("severity"), F.asc_nulls_last("source_ip"),
                 F.desc_nulls_first("event_count")]
    return alerts.orderBy(*order).limit(n).select(*shown)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A sink table with its folder columns, by its declared schema. A table
    nothing was written to yet is empty; a damaged one raises. Of a table
    with a list of committed batches, those are read."""
    if is_committed(spark, path):
        return read_committed(spark, path, schema)
    try:
        return spark.read.schema(stored(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stored(schema))


def register_tables(spark: SparkSession, table_root: str) -> list[str]:
    """Temp views over the monitors' tables below ``table_root``.

    ``routing_events``, ``dns_events``, ``bgp_alerts`` and ``dns_alerts``
    hold every written row in the sink table's columns (an update-mode
    rule's repeated emissions included, as in an append-only database
    table) and ``event_date``, on which a filter skips other days' files;
    ``current_bgp_alerts`` and ``current_dns_alerts`` hold the latest row
    per alert. Dashboard SQL can then run as it is through ``spark.sql``,
    on a day without alerts too: tables not written yet are empty views.
    Returns the names registered.
    """
    from netwatch.operators.alerts import current_alerts

    names = []
    for name, schema in TABLE_SCHEMAS.items():
        table = read_table(spark, os.path.join(table_root, name), schema)
        table.select(*schema.names, "event_date").createOrReplaceTempView(name)
        names.append(name)
        if name.endswith("_alerts"):
            kind = BGP if name.startswith("bgp") else DNS
            current_alerts(table, kind).createOrReplaceTempView(f"current_{name}")
            names.append(f"current_{name}")
    return names
