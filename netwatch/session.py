"""Session construction and the shared working folder.

The shared folder is whatever the cluster names in ``spark.checkpoint.dir``;
streaming checkpoints, sink tables of the parity queries and lineage cuts go
below it. Only when that setting is absent (a bare local session, as in
tests) is a private temporary folder taken instead.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Many (window, key) groups in a stream: keep state off the JVM heap.
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Defaults that hold from local[8] up to a large cluster: UTC so window bounds
# and string timestamps do not depend on the machine, AQE for runtime
# coalescing and skew splitting of batch shuffles, stream state in RocksDB
# with only its changes uploaded per batch.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "netwatch",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` is left to spark-submit when None. ``shuffle_partitions`` also
    fixes the partition count of stateful streaming operators at their first
    checkpoint, so size it for the cluster before a stream starts.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``."""
    global _fallback_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if _fallback_root is None:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for "
                "checkpoints and sink tables")
        _fallback_root = tempfile.mkdtemp(prefix="netwatch-")
        spark.sparkContext.setCheckpointDir(_fallback_root)
    return _fallback_root


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unused folder below the shared root."""
    return os.path.join(shared_root(spark), "netwatch", *parts, uuid.uuid4().hex)


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system, whatever that is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing folders or files of a glob pattern, sorted."""
    path, files = _hadoop(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(path) or [])


def make_dir(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it, if need be."""
    where, files = _hadoop(spark, path)
    files.mkdirs(where)


def create_empty(spark: SparkSession, path: str) -> None:
    """Create an empty file, which appears as a whole or not at all."""
    where, files = _hadoop(spark, path)
    if not files.createNewFile(where):
        raise FileExistsError(path)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a working folder, on whatever file system it lies."""
    where, files = _hadoop(spark, path)
    files.delete(where, True)
