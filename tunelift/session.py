"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this library should carry.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_settings(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20
                     ) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of parquet on ``cores`` cores.

    Shuffle partitions start at about one per 256 MB of input (at least 2 x cores) and AQE
    coalesces them to the advisory size at run time; scan splits are 512 MB; a join side
    is broadcast only when AQE has measured it under 64 MB.
    """
    parts = max(2 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "tunelift", extra: dict | None = None) -> SparkSession:
    """A session with this library's settings.  ``master=None`` leaves the master (and
    ``shuffle_partitions=None`` the partition count) to spark-submit / the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_settings(spark)
    return spark


def apply_session_settings(spark: SparkSession) -> None:
    """Make sure that intermediates have a shared folder (idempotent)."""
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; where
    it is unset there, this raises, since executors could not read what others wrote to
    a folder of one machine.  Only a local master (tests) gets a folder of our own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.split("[")[0] == "local":
        raise ValueError(f"spark.checkpoint.dir is not set; with master {sc.master} it must "
                         "name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tunelift-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"scratch-{name}-{uuid.uuid4().hex[:12]}")


# Paths of the innermost open ``intermediates`` block of a thread, which owns and deletes them.
_blocks = threading.local()


def _owned() -> list[list[str]]:
    if not hasattr(_blocks, "stack"):
        _blocks.stack = []
    return _blocks.stack


@contextmanager
def intermediates(spark: SparkSession):
    """Own every table that ``materialize`` stores inside the block, and delete them at its
    end.  For jobs that write their results: a lazy result must not outlive the block, unless
    all that it reads was stored with ``outlives``."""
    _owned().append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in _owned().pop():
            if "scratch-bucketed-" in path:
                spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# Spark removes the shuffle files of a query at its end, not when the driver collects its garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df, name: str, outlives: bool = False):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of a table that several later plans read (and survives the loss of
    executors, unlike a local checkpoint or a cache).  Inside an ``intermediates`` block
    the copy is deleted at the end of the block (with ``outlives``: of the block around it);
    otherwise it lives as long as the session's checkpoint folder.  The shuffle files of the
    write go with its end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    owners = _owned()[:-1] if outlives else _owned()
    if owners:
        owners[-1].append(path)
    with _shuffles_removed(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _table_name(path: str) -> str:
    """Catalog name of a bucketed table: the random end of its path."""
    return f"tunelift_{path[-12:]}"


def materialize_bucketed(df, name: str, keys: Sequence[str], buckets: int | None = None, sort: bool = True):
    """Like ``materialize``, as an external table bucketed (and sorted) by ``keys``: joins and
    aggregates on exactly these keys (aggregates: on more keys, too) read it without a shuffle.

    ``buckets`` defaults to the shuffle partitions: with fewer, Spark would deal the table anew
    rather than join in few tasks.  A bucket is read by one task, which no runtime re-plan can
    split, so this is for tables whose keys are unique or pre-aggregated; tables where one key
    may hold a large share of the rows belong in ``materialize``."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"bucketed-{name}")
    if _owned():
        _owned()[-1].append(path)
    # dealt by the keys first, so that a task writes whole buckets, one file each
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    (writer.sortBy(*keys) if sort else writer).option("path", path).format("parquet").saveAsTable(_table_name(path))
    return spark.table(_table_name(path))
