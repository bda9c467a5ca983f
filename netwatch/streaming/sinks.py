"""Micro-batch sinks for ``foreachBatch``.

``foreachBatch`` is at-least-once: after a failure the last batch runs
again with the same id. Both sinks make that replay harmless, and neither
swallows a write error: a failed write fails the query, so its offsets are
not committed and the batch is retried on restart.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.schemas import stored

log = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]


def _each_nonempty(df: DataFrame, write: Callable[[DataFrame], None],
                   cache: bool = True) -> bool:
    """Run ``write`` once on a cached batch unless it is empty.

    The batch plan (source read, decode, state) runs once, with its full
    parallelism, to fill the cache; the row count and the write read the
    cache. So a write that merges partitions (``coalesce``) never pulls the
    stateful stage into fewer tasks. ``cache=False`` is for frames derived
    from a batch the caller has cached already.
    """
    if not cache:
        if df.isEmpty():
            return False
        write(df)
        return True
    df.persist()
    try:
        if df.count() == 0:
            return False
        write(df)
        return True
    finally:
        df.unpersist()


def current_run(df: DataFrame) -> str:
    """Id of the streaming query whose batch this is, the same in every
    restart from one checkpoint; "direct" outside a stream."""
    run = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return run or "direct"


class ParquetBatchSink:
    """Appends a table as
    ``<path>/writer=<name>/mode=<output mode>/run=<query id>/batch_id=<n>/``.

    A replayed batch overwrites its own folder, so the table holds each
    batch exactly once. Batch ids start again at 0 with a new checkpoint;
    the query id, which Spark keeps in the checkpoint, tells the runs apart,
    so a new checkpoint on old tables adds to them. Several queries may feed
    one table under distinct writer names. The folder names come back as
    columns when the table is read; ``mode`` tells readers which rows an
    update-mode query may have emitted again.

    ``date_column`` adds a last level ``event_date=<day>`` so that readers
    with a time filter skip other days. Output that is small next to its
    partitions (alerts of a stateful query) is merged to files of the
    session's advisory size by ``rebalance``; there is no fixed number.
    """

    def __init__(self, path: str, writer: str, skip_empty: bool = True, cache: bool = True,
                 mode: str = "append", date_column: str | None = None, rebalance: bool = False):
        self.path = path
        self.writer = writer
        self.skip_empty = skip_empty
        self.cache = cache
        self.mode = mode
        self.date_column = date_column
        self.rebalance = rebalance

    def folder(self, batch_id: int, run: str) -> str:
        return os.path.join(self.path, f"writer={self.writer}", f"mode={self.mode}", f"run={run}",
                            f"batch_id={batch_id}")

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        target = self.folder(batch_id, current_run(df))

        def write(frame: DataFrame) -> None:
            if self.date_column:
                frame = frame.withColumn("event_date", F.to_date(self.date_column))
            if self.rebalance:
                frame = frame.hint("rebalance")
            out = frame.write.mode("overwrite")
            if self.date_column:
                out = out.partitionBy("event_date")
            out.parquet(target)

        if self.skip_empty:
            wrote = _each_nonempty(df, write, self.cache)
        else:
            write(df)
            wrote = True
        if wrote:
            log.info("batch %s of %s written to %s", batch_id, self.writer, target)


def compact(spark: SparkSession, path: str, target: str, schema: StructType) -> None:
    """Copy a sink table into ``target`` with few large files per day.

    A long-running sink leaves a folder per writer and trigger. The copy has
    the same columns, folder names included, and only ``event_date`` as a
    folder, so readers list one folder per day. Files are cut by size
    (rebalance), not by number. ``schema`` is the table's own
    (``netwatch.schemas``). The source is left as it is: point readers at
    the copy, then drop the folders of finished runs.
    """
    table = spark.read.schema(stored(schema)).option("basePath", path).parquet(path)
    table.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(target)


class JdbcBatchSink:
    """Appends a batch to a JDBC table.

    With ``batch_column`` the table has a batch-id and a ``writer`` column,
    and the sink first deletes the rows a previous attempt of the same batch
    of the same writer left, then appends: a replay does not duplicate rows.
    ``writer`` is required then, because batch ids of different queries on
    one table overlap. It is stored as ``<writer>@<query id>``: batch ids
    start again with a new checkpoint, also one at the path of an older one,
    and the query id, which Spark keeps in the checkpoint, tells the two
    apart. Delete and append are two transactions, and the delete runs
    on a driver connection: a failure in between leaves the batch missing
    until its replay. Without ``batch_column`` (the original tables have no
    such column) the sink is at-least-once. Empty batches
    cause no round trip. ``num_partitions`` bounds concurrent connections.
    ``cache=False`` inside a ``FanOutSink`` (the batch is cached there).
    """

    def __init__(self, url: str, table: str, properties: Mapping[str, str],
                 batch_column: str | None = None, writer: str | None = None,
                 num_partitions: int | None = None, cache: bool = True):
        if batch_column and not writer:
            raise ValueError("batch_column needs a writer: batch ids of several queries overlap")
        self.cache = cache
        self.url = url
        self.table = table
        self.properties = dict(properties)
        self.batch_column = batch_column
        self.writer = writer
        self.num_partitions = num_partitions

    def delete_statement(self) -> str:
        return f"DELETE FROM {self.table} WHERE {self.batch_column} = ? AND writer = ?"

    def writer_of(self, df: DataFrame) -> str:
        return f"{self.writer}@{current_run(df)}"

    def _delete_batch(self, df: DataFrame, batch_id: int, writer: str) -> None:
        jvm = df.sparkSession.sparkContext._jvm
        props = jvm.java.util.Properties()
        for key, value in self.properties.items():
            if key != "driver":
                props.setProperty(key, value)
        if "driver" in self.properties:
            jvm.java.lang.Class.forName(self.properties["driver"])
        conn = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            stmt = conn.prepareStatement(self.delete_statement())
            stmt.setLong(1, batch_id)
            stmt.setString(2, writer)
            stmt.executeUpdate()
            stmt.close()
        finally:
            conn.close()

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        writer = self.writer_of(df)

        def write(frame: DataFrame) -> None:
            if self.batch_column:
                self._delete_batch(frame, batch_id, writer)
                frame = (frame.withColumn(self.batch_column, F.lit(batch_id).cast("long"))
                         .withColumn("writer", F.lit(writer)))
            options = dict(self.properties)
            if self.num_partitions:
                options["numPartitions"] = str(self.num_partitions)
            frame.write.jdbc(url=self.url, table=self.table, mode="append", properties=options)

        _each_nonempty(df, write, self.cache)


class FanOutSink:
    """One micro-batch, several tables.

    Stateless outputs of one source (archive, per-event rules, dead
    letters) are written from a single cached batch, so the topic is read
    and decoded once instead of once per output. ``outputs`` maps a name to
    (transform, writer); each writer sees ``transform(batch)`` and should not
    cache it again (``ParquetBatchSink(cache=False)``).
    """

    def __init__(self, outputs: Mapping[str, tuple[Callable[[DataFrame], DataFrame], BatchWriter]]):
        self.outputs = dict(outputs)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if df.count() == 0:
                return
            for transform, writer in self.outputs.values():
                writer(transform(df), batch_id)
        finally:
            df.unpersist()
