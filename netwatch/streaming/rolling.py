"""Views of a growing sink table that are carried along instead of recomputed.

A view is a fold that can be merged: the latest row per alert, counts per
timestamp. Its state is kept as a table, with the batches it covers; a read
folds the state and the batches after it, and ``advance`` moves the state
on. Neither reads a batch the state covers.

Only settled batches enter the state. A streaming query starts a batch after
the one before it was committed, so of each run all batches but the newest
are final: a replay rewrites the newest alone. That keeps counts exact after
replays without a transaction over table and state.

A state is a numbered folder; the covered batches are written after it, and
their marker of success makes the version valid. The version before is kept
for readers that have opened it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.operators.rules import BGP
from netwatch.schemas import stored
from netwatch.session import list_paths, remove_dir

_BATCH = re.compile(r"writer=([^/]*)/mode=([^/]*)/run=([^/]*)/batch_id=(\d+)$")
COVERED = "writer string, mode string, run string, batch_id long"
Run = tuple[str, str, str]


@dataclass(frozen=True)
class RollingView:
    """``fold`` of ``prepare`` of all rows of the sink table at ``table``.

    ``fold`` merges: fold(fold(a) + b) equals fold(a + b). ``prepare`` gets
    the stored rows (folder columns included) and makes what ``fold`` takes;
    both have the columns of the state.
    """

    table: str
    schema: StructType
    state: str
    prepare: Callable[[DataFrame], DataFrame]
    fold: Callable[[DataFrame], DataFrame]

    def _version(self, spark: SparkSession) -> int:
        done = list_paths(spark, os.path.join(self.state, "covered", "v*", "_SUCCESS"))
        return max((int(re.search(r"/v(\d+)/_SUCCESS$", p)[1]) for p in done), default=0)

    def covered(self, spark: SparkSession) -> dict[Run, int]:
        """The newest batch of each run that the state holds."""
        version = self._version(spark)
        if not version:
            return {}
        rows = spark.read.schema(COVERED).parquet(os.path.join(self.state, "covered", f"v{version}")).collect()
        return {(r.writer, r.mode, r.run): r.batch_id for r in rows}

    def batches(self, spark: SparkSession) -> dict[Run, list[int]]:
        """The batches of each run that the state does not hold, by the
        names of their folders."""
        covered, out = self.covered(spark), {}
        for path in list_paths(spark, os.path.join(self.table, "writer=*", "mode=*", "run=*", "batch_id=*")):
            if m := _BATCH.search(path):
                run, batch = (m[1], m[2], m[3]), int(m[4])
                if batch > covered.get(run, -1):
                    out.setdefault(run, []).append(batch)
        return {run: sorted(found) for run, found in out.items()}

    def _rows(self, spark: SparkSession, batches: dict[Run, Iterable[int]]) -> DataFrame:
        paths = [os.path.join(self.table, f"writer={w}", f"mode={m}", f"run={r}", f"batch_id={b}")
                 for (w, m, r), found in batches.items() for b in found]
        reader = spark.read.schema(stored(self.schema)).option("basePath", self.table)
        rows = self.prepare(reader.parquet(*paths) if paths else spark.createDataFrame([], stored(self.schema)))
        version = self._version(spark)
        if version:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(
                os.path.join(self.state, "rows", f"v{version}")))
        return self.fold(rows)

    def read(self, spark: SparkSession) -> DataFrame:
        """The view over everything written so far."""
        return self._rows(spark, self.batches(spark))

    def advance(self, spark: SparkSession) -> int:
        """Fold the settled batches into the state; how many there were.
        Nothing is read or written when there are none. One caller at a time."""
        settled = {run: found[:-1] for run, found in self.batches(spark).items() if len(found) > 1}
        if not settled:
            return 0
        version = self._version(spark) + 1
        # What a broken attempt left under this number is written anew.
        self._rows(spark, settled).write.mode("overwrite").parquet(os.path.join(self.state, "rows", f"v{version}"))
        covered = self.covered(spark) | {run: found[-1] for run, found in settled.items()}
        (spark.createDataFrame([(*run, batch) for run, batch in covered.items()], COVERED).coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(self.state, "covered", f"v{version}")))
        for part in ("covered", "rows"):
            if version > 2:
                remove_dir(spark, os.path.join(self.state, part, f"v{version - 2}"))
        return sum(map(len, settled.values()))


def latest_alerts_view(table: str, schema: StructType, state: str, kind: str) -> RollingView:
    """The latest row per alert of an update-mode table, with the run and
    batch it came from; the same rows as ``latest_alerts`` over the history."""
    keys = ["alert_type", "window_start", "window_end"]
    keys += ["prefix", "origin_as"] if kind == BGP else ["source_ip"]
    rest = [c for c in schema.names if c not in keys] + ["run", "batch_id"]

    def fold(rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*rest), F.struct("detected_at", "run", "batch_id")).alias("newest")
        return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*schema.names, "run", "batch_id")

    return RollingView(table, schema, state, lambda rows: rows.select(*schema.names, "run", "batch_id"), fold)


def series_view(table: str, schema: StructType, state: str, time_column: str = "timestamp") -> RollingView:
    """Events per timestamp of an archive; the rows of ``event_series``,
    unordered. A late row is one more partial count of its timestamp."""
    def prepare(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(time_column).alias("time"), F.lit(1).cast("long").alias("event_count"))

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("time").agg(F.sum("event_count").alias("event_count"))

    return RollingView(table, schema, state, prepare, fold)
