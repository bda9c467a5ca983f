"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netwatch.session import fresh_dir

# Words are maximal runs of anything but ASCII white space. ``bytes.split``
# with no argument splits at exactly these six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs the re-read of its splits. The reread frame has no partitioning
    of its own: a join on it gets a plain exchange on both sides, which AQE
    may split when a key is hot.
    """
    path = fresh_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """A written table with its size checked: sent to every executor when it
    has at most ``rows`` rows (of a few hundred bytes), else as it is, for a
    shuffled join. Keeps a group that holds most rows of the other side
    from being dealt to one task."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.binary()).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word, as an unsigned array."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive items, in order of start."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
    return mix64(out)


def process_cache(kind: str, key: Any, make: Callable[[], Any]) -> Any:
    """The latest object of a kind in this worker process, made anew when the
    key changes: models and vocabularies are loaded once, not once per task.
    Holds nothing that results depend on."""
    store = sys.modules.setdefault("_netwatch_llm_cache", types.ModuleType("_netwatch_llm_cache")).__dict__
    if kind not in store or store[kind][0] != key:
        store.pop(kind, None)
        store[kind] = (key, make())
    return store[kind][1]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: Spark sends up to 10,000 rows at
    once, which as Python texts and their results would be much memory."""
    for every in batches:
        for at in range(0, every.num_rows, rows):
            yield every.slice(at, rows)


def batch(schema: pa.Schema, *columns: Any) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)
