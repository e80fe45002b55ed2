"""Session construction and the shared working folder.

Intermediate tables (standard base tables, materialized form tables, model
artifacts) are written below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset (unit tests, a laptop) do we
create a private folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small final stages keep enough partitions to use every core (and are
    # written as that many files); no effect on large stages
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # the JVM never compiles methods above 8,000 bytes of code: wide parsing stages run as separate operators instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # tables bucketed by game serve joins on (game, team) as they lie
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "formmart",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session with the settings this library assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes``; fills only settings that are unset.

    AQE coalesces small shuffle partitions but never splits large ones, so the
    initial shuffle partition count is derived from the input size (about
    ``target_partition_bytes`` of input per partition).  Scan splits are capped
    at the same size.  Returns what was set.
    """
    n = max(200, -(-input_bytes // target_partition_bytes))
    wanted = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
    applied = {}
    for k, v in wanted.items():
        explicit = spark.sparkContext.getConf().get(k, None)
        if explicit is None:
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def compile_in_parts(spark: SparkSession) -> None:
    """Methods that the JVM would only interpret (above 8,000 bytes of code) run as separate operators, unless the session says otherwise."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if key not in spark.conf.getAll:
        spark.conf.set(key, _DEFAULTS[key])


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings (dots as double underscores) for the jobs started inside; those that the session states itself are kept."""
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    mine = [k for k in keys if k not in spark.conf.getAll]
    for k in mine:
        spark.conf.set(k, keys[k])
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def shuffles_deleted(spark: SparkSession):
    """Jobs that write a table inside delete their shuffle files when they end.

    Else these lie on the disks until the driver happens to collect its garbage,
    which a long run with few driver objects may not do before the disks are full.
    """
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def compact_tables(spark: SparkSession):
    """As :func:`shuffles_deleted`; Parquet files written inside are packed with zstd."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true",
                    spark__sql__parquet__compression__codec="zstd")


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, on any file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (Hadoop file system, any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables of this application.

    Uses the checkpoint folder of the running context (which the cluster sets
    through ``spark.checkpoint.dir``).  Only a local master, whose executors
    share the driver's disk, gets a private folder when none is configured; on
    a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not base and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not base:
            base = tempfile.mkdtemp(prefix="formmart-ckpt-")
        sc.setCheckpointDir(base)
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared working folder."""
    return "/".join([work_dir(spark), "formmart", *parts, uuid.uuid4().hex[:12]])
