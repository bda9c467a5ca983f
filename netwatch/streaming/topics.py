"""Alerts to a topic: outgoing frames with a key that survives a replay.

A batch that runs again sends its alerts again; a topic cannot take them
back. So every frame has a key made of the query, the batch and the alert:
equal for the replay of an alert, different for everything else. A reader
keeps one frame per key (``received_alerts``), or a compacted topic does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.streaming.sinks import FanOutSink, _each_nonempty, current_run

Publisher = Callable[[DataFrame], None]


def alert_frames(alerts: DataFrame, topic: str, writer: str, run: str, batch_id: int) -> DataFrame:
    """key (text, hashed), value (the alert as JSON, NULLs included), topic.

    Alerts that are equal in all columns are told apart by a number: they
    are counted and dealt out again, so no key collects them in one task.
    The detection time is part of the alert and the same in a replay, since
    Spark keeps a batch's time with its offsets.
    """
    columns = alerts.columns
    counted = alerts.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    each = counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))).alias("__nth"))
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    key = F.sha2(F.concat_ws("|", F.lit(writer), F.lit(run), F.lit(str(batch_id)), F.col("__nth"), text), 256)
    return each.select(key.cast("binary").alias("key"), text.cast("binary").alias("value"),
                       F.lit(topic).alias("topic"))


def received_alerts(frames: DataFrame, schema: StructType) -> DataFrame:
    """The alerts of a topic's frames, each sent alert once."""
    once = frames.groupBy("key").agg(F.first("value").alias("value"))
    return once.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))))


def kafka_publisher(bootstrap: str, options: Mapping[str, str] | None = None) -> Publisher:
    """Sends frames to the topics they name."""
    def publish(frames: DataFrame) -> None:
        (frames.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .options(**dict(options or {})).save())
    return publish


def folder_publisher(path: str) -> Publisher:
    """Appends frames to a parquet folder, as a topic would keep them
    (replays included)."""
    def publish(frames: DataFrame) -> None:
        frames.write.mode("append").parquet(path)
    return publish


class TopicBatchSink:
    """Publishes a batch of alerts as keyed frames. Errors fail the query."""

    def __init__(self, topic: str, writer: str, publish: Publisher, cache: bool = True):
        self.topic = topic
        self.writer = writer
        self.publish = publish
        self.cache = cache

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        run = current_run(df)
        _each_nonempty(df, lambda frame: self.publish(
            alert_frames(frame, self.topic, self.writer, run, batch_id)), self.cache)


def topic_sinks(publish: Publisher, tables: Callable) -> Callable:
    """A sink factory that sends alert tables to the topic of their name as
    well as to ``tables`` (another factory); other tables go there only."""
    def make(table: str, writer: str, cache: bool = True, **options):
        if not table.endswith("_alerts"):
            return tables(table, writer, cache=cache, **options)
        return FanOutSink({
            "table": (lambda df: df, tables(table, writer, cache=False, **options)),
            "topic": (lambda df: df, TopicBatchSink(table, writer, publish, cache=False)),
        })
    return make
