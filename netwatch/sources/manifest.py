"""Tables whose batches are visible only once they are listed.

Layout below the table's folder, by ``netwatch.streaming.committed``:

    batches/writer=W/mode=M/run=R/batch_id=N/attempt=A/event_date=D/   rows
    commits/writer=W/mode=M/run=R/batch_id=N/attempt=A                 empty file
    days/version=V/event_date=D/                                       compacted rows
    snapshots/vV/                                                      what they hold

An attempt counts when its empty file exists, and the last attempt of a
batch replaces those before it. A file without contents appears as a whole
on any file system, so a reader sees the old attempt or the new one. A
snapshot says which days lie in which versions, and up to which batch of
each run they hold all rows; commits up to there are passed over.
"""

from __future__ import annotations

import datetime as dt
import os
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from netwatch.schemas import stored
from netwatch.session import list_paths

SNAPSHOT = "writer string, mode string, run string, batch_id long, event_date date, version int"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
Run = tuple[str, str, str]
_COMMIT = re.compile(r"/writer=([^/]*)/mode=([^/]*)/run=([^/]*)/batch_id=(\d+)/attempt=([^/]*)$")


@dataclass(frozen=True)
class Snapshot:
    """Compacted days and their versions; the last batch of each run in them."""

    version: int = 0
    covered: dict[Run, int] = field(default_factory=dict)
    days: dict[dt.date | None, list[int]] = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        return ([(*run, batch, None, None) for run, batch in self.covered.items()]
                + [(None, None, None, None, day, v) for day, versions in self.days.items() for v in versions])


def batch_folder(writer: str, mode: str, run: str, batch_id: int) -> str:
    return os.path.join(f"writer={writer}", f"mode={mode}", f"run={run}", f"batch_id={batch_id}")


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether the table at ``path`` has a list of its batches; it may be empty yet."""
    return bool(list_paths(spark, os.path.join(path, "{batches,commits}")))


def snapshot_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete snapshots, ascending."""
    done = list_paths(spark, os.path.join(path, "snapshots", "v*", "_SUCCESS"))
    return sorted(int(re.search(r"/v(\d+)/_SUCCESS$", p)[1]) for p in done)


def read_snapshot(spark: SparkSession, path: str, version: int) -> Snapshot:
    covered, days = {}, {}
    for r in spark.read.schema(SNAPSHOT).parquet(os.path.join(path, "snapshots", f"v{version}")).collect():
        if r.version is None:
            covered[r.writer, r.mode, r.run] = r.batch_id
        else:
            days.setdefault(r.event_date, []).append(r.version)
    return Snapshot(version, covered, {day: sorted(found) for day, found in days.items()})


def latest_snapshot(spark: SparkSession, path: str) -> Snapshot:
    versions = snapshot_versions(spark, path)
    return read_snapshot(spark, path, versions[-1]) if versions else Snapshot()


def commits(spark: SparkSession, path: str, after: dict[Run, int]) -> dict[Run, dict[int, str]]:
    """run -> batch -> its last attempt, for batches beyond ``after``."""
    out: dict[Run, dict[int, str]] = {}
    for mark in list_paths(spark, os.path.join(path, "commits", "writer=*", "mode=*", "run=*", "batch_id=*", "attempt=*")):
        writer, mode, run, batch, attempt = _COMMIT.search(mark).groups()
        key, number = (writer, mode, run), int(batch)
        if number > after.get(key, -1):
            batches = out.setdefault(key, {})
            batches[number] = max(attempt, batches.get(number, ""))
    return out


def attempt_folders(path: str, found: dict[Run, dict[int, str]]) -> list[str]:
    return [os.path.join(path, "batches", batch_folder(*run, batch), f"attempt={attempt}")
            for run, batches in found.items() for batch, attempt in batches.items()]


def day_folders(path: str, days: dict[dt.date | None, list[int]]) -> list[str]:
    return [os.path.join(path, "days", f"version={v}", f"event_date={NULL_DAY if day is None else day}")
            for day, versions in days.items() for v in versions]


def read_folders(spark: SparkSession, root: str, folders: list[str], schema: StructType) -> DataFrame:
    """The rows of some folders below ``root`` with a sink table's columns."""
    whole = stored(schema)
    if not folders:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", root).parquet(*folders).select(*whole.names)


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table's committed rows, each once, with the folder columns. A
    table without a commit is empty."""
    snapshot = latest_snapshot(spark, path)
    fresh = attempt_folders(path, commits(spark, path, snapshot.covered))
    return (read_folders(spark, os.path.join(path, "batches"), fresh, schema)
            .unionAll(read_folders(spark, os.path.join(path, "days"), day_folders(path, snapshot.days), schema)))
