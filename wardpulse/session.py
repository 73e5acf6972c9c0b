"""Spark session and shared-folder helpers.

Every job in this package takes the session it is given.  ``local_session``
exists for tests, the bench and ad-hoc runs; on a cluster the caller builds
the session and names the shared checkpoint folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


#: The JVM interprets generated methods above this size instead of compiling them; Spark
#: then does better to leave such a stage to smaller generated parts.
HUGE_METHOD_BYTES = "8000"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wardpulse") -> SparkSession:
    """A local session configured the way the jobs expect (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_BYTES)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WARDPULSE_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """State store settings for the stateful streams (fixed per checkpoint at
    its first run): RocksDB, with changelog checkpointing so a commit writes
    the batch's changes instead of a full snapshot.  A stream-stream join keeps its state
    in one store a partition instead of four, and no store looks a key up before each write
    to count its rows.  Session windows merge in each
    task before the shuffle, so a key with most of a batch's rows sends few."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    spark.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the jobs rely on; safe to call on a caller's session.

    Outputs are computed from epoch integers so the session time zone does not
    change results, but stream watermarks and date partitions read best in UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session.  Only when it is unset *and* Spark runs in local
    mode (tests, bench) is a scratch folder created and registered; a cluster
    job without a shared folder fails instead of writing machine-local files.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not path:
        jdir = sc._jsc.sc().getCheckpointDir()
        path = jdir.get() if jdir.isDefined() else None
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        path = tempfile.mkdtemp(prefix="wardpulse-ckpt-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, unique per call."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one folder of a job's own output, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def touch_path(spark: SparkSession, path: str) -> None:
    """Create one empty file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True).close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the given inputs from file-system metadata (no scan)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_shuffles(spark: SparkSession, in_bytes: int, target_mb: int = 128,
                  expansion: float = 3.0, min_partitions: int = 8,
                  max_partitions: int = 100_000) -> int:
    """Cluster sizing for one job: initial shuffle partitions from the input
    size (decoded rows are ~``expansion`` times the compressed parquet),
    capped; AQE then coalesces small partitions to ``target_mb`` and splits
    skewed ones.  Returns the partition count it set."""
    n = int(min(max(math.ceil(in_bytes * expansion / (target_mb << 20)), min_partitions),
                max_partitions))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{target_mb}m")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{target_mb}m")
    return n
