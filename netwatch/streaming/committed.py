"""Sink and upkeep of tables with a list of committed batches.

``ParquetBatchSink`` overwrites the folder of a replayed batch, which a
reader may be listing at that moment. Here every attempt has a folder of its
own and counts from the moment it is listed (``netwatch.sources.manifest``).

``compact_days`` moves settled batches into one folder per day and finishes
a day once: what is read is the new batches and the days they add to.
``vacuum`` removes what neither the newest snapshot nor the one before it
needs. One caller of the two at a time; writers and readers go on.

A streaming query starts a batch after the one before it was committed, so
of each run all batches but the newest are settled: no attempt of them is
under way, and no replay follows.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.session import create_empty, list_paths, remove_dir
from netwatch.sources.manifest import (
    NULL_DAY,
    SNAPSHOT,
    Run,
    Snapshot,
    attempt_folders,
    batch_folder,
    commits,
    day_folders,
    latest_snapshot,
    read_folders,
    read_snapshot,
    snapshot_versions,
)
from netwatch.streaming.sinks import BatchWriter, current_run

log = logging.getLogger(__name__)
_DAY = re.compile(r"/event_date=([^/]*)/")
_VERSION = re.compile(r"/version=(\d+)$")


class CommittedBatchSink:
    """Appends a micro-batch as an attempt that is listed once it is whole.

    The options are those of ``ParquetBatchSink``. A failure before the
    listing leaves files that no reader sees and ``vacuum`` removes; after
    it, the replay is a further attempt that replaces the first. An empty
    batch is passed over, unless it replaces an attempt.
    """

    def __init__(self, path: str, writer: str, cache: bool = True, mode: str = "append",
                 date_column: str | None = None, rebalance: bool = False):
        self.path = path
        self.writer = writer
        self.cache = cache
        self.mode = mode
        self.date_column = date_column
        self.rebalance = rebalance

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        folder = batch_folder(self.writer, self.mode, current_run(df), batch_id)
        before = len(list_paths(spark, os.path.join(self.path, "commits", folder, "attempt=*")))
        if self.cache:
            df.persist()
        try:
            # A full count fills the cache with the plan's own parallelism.
            empty = df.count() == 0 if self.cache else df.isEmpty()
            if empty and not before:
                return
            name = f"attempt={before:06d}-{uuid.uuid4().hex}"
            self._write(df, os.path.join(self.path, "batches", folder, name))
        finally:
            if self.cache:
                df.unpersist()
        create_empty(spark, os.path.join(self.path, "commits", folder, name))
        log.info("batch %s of %s committed as %s", batch_id, self.writer, name)

    def _write(self, frame: DataFrame, target: str) -> None:
        if self.date_column:
            frame = frame.withColumn("event_date", F.to_date(self.date_column))
        if self.rebalance:
            frame = frame.hint("rebalance")
        out = frame.write
        if self.date_column:
            out = out.partitionBy("event_date")
        out.parquet(target)


def committed_sinks(table_root: str) -> Callable[..., BatchWriter]:
    """Tables with a list of committed batches, one per name below ``table_root``."""
    def make(table: str, writer: str, **options) -> BatchWriter:
        return CommittedBatchSink(os.path.join(table_root, table), writer, **options)
    return make


def _settled(found: dict[Run, dict[int, str]]) -> dict[Run, dict[int, str]]:
    return {run: {b: a for b, a in batches.items() if b < max(batches)}
            for run, batches in found.items() if len(batches) > 1}


def _days_of(frame: DataFrame) -> set[dt.date | None]:
    """Days that a frame's files lie in, by the names of their folders."""
    names = {m[1] if (m := _DAY.search(f)) else NULL_DAY for f in frame.inputFiles()}
    return {None if n == NULL_DAY else dt.date.fromisoformat(n) for n in names}


def compact_days(spark: SparkSession, path: str, schema: StructType, today: dt.date) -> int:
    """Fold settled batches into the table's days; the number of days written.

    A day before ``today`` is finished: it is written as one folder, with
    what it had before. To other days (and to rows without a day) the new
    rows are added as one more folder, which is merged once the day is
    over. Days without new rows are left as they are, and their files are
    not read. When there is nothing to do, nothing is read or written.
    Rows keep the writer, mode, run and batch they came from. Files are cut
    by size (``rebalance``), so a large day is many tasks and files.
    """
    old = latest_snapshot(spark, path)
    settled = _settled(commits(spark, path, old.covered))
    fresh = read_folders(spark, os.path.join(path, "batches"), attempt_folders(path, settled), schema)
    touched = _days_of(fresh) if settled else set()

    def finished(day: dt.date | None) -> bool:
        return day is not None and day < today

    merged = {day: versions for day, versions in old.days.items()
              if finished(day) and (day in touched or len(versions) > 1)}
    if not settled and not merged:
        return 0
    # Numbers of attempts that broke off are not used again: their files may be there.
    used = [int(_VERSION.search(p)[1]) for p in list_paths(spark, os.path.join(path, "days", "version=*"))]
    version = max([old.version, *used]) + 1
    rows = fresh.unionAll(read_folders(spark, os.path.join(path, "days"), day_folders(path, merged), schema))
    (rows.hint("rebalance", "event_date").write.partitionBy("event_date")
     .parquet(os.path.join(path, "days", f"version={version}")))
    days = {day: versions for day, versions in old.days.items() if day not in merged}
    for day in touched | set(merged):
        days[day] = [*days.get(day, []), version]
    covered = old.covered | {run: max(batches) for run, batches in settled.items()}
    (spark.createDataFrame(Snapshot(version, covered, days).rows(), SNAPSHOT).coalesce(1)
     .write.mode("overwrite").parquet(os.path.join(path, "snapshots", f"v{version}")))
    return len(touched | set(merged))


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove folders that no reader of the newest snapshot or of the one
    before it needs; how many.

    These are batches that both snapshots hold as days, replaced or never
    listed attempts of other settled batches, and versions of days that
    neither names. Readers that began before the last two compactions, or
    before the replay of a batch that has settled since, must have ended.
    """
    kept = [read_snapshot(spark, path, v) for v in snapshot_versions(spark, path)[-2:]]
    base = kept[0] if len(kept) == 2 else Snapshot()
    listed = commits(spark, path, {})
    removed = 0
    for run, batches in listed.items():
        for batch in batches:
            folder, covered = batch_folder(*run, batch), batch <= base.covered.get(run, -1)
            if batch == max(batches):
                continue
            for part in ("batches", "commits"):
                for found in list_paths(spark, os.path.join(path, part, folder, "attempt=*")):
                    if covered or not found.endswith(f"attempt={batches[batch]}"):
                        removed += part == "batches"
                        remove_dir(spark, found)
    needed = {v for s in kept for versions in s.days.values() for v in versions}
    for found in list_paths(spark, os.path.join(path, "days", "version=*")):
        version = int(_VERSION.search(found)[1])
        if kept and version <= kept[-1].version and version not in needed:
            remove_dir(spark, found)
            removed += 1
    for version in snapshot_versions(spark, path)[:-2]:
        remove_dir(spark, os.path.join(path, "snapshots", f"v{version}"))
    return removed
