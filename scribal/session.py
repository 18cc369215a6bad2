"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Conservative defaults for any cluster; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # object aggregates (collect_list/collect_set) stay hash-based for more
    # keys per task before falling back to sort-based aggregation
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # AQE broadcasts a join side only after measuring its shuffle output
    # below this size (dictionaries: yes; token tables: never)
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "scribal") -> SparkSession:
    """A local session for tests and benchmarks (one JVM, ``cores`` threads)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("scribal.input.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SCRIBAL_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster (``local-cluster`` included) this must already be set to
    shared storage. Only a one-process local session (tests) without the
    setting gets a private scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="scribal-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    try:  # record it for readers of the session conf; core keys may be locked
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001
        pass
    return path


def _store(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in its terms."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever store it lies."""
    fs, hadoop_path = _store(spark, path)
    return bool(fs.exists(hadoop_path))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` in full, as Spark's file sources name the files below it."""
    fs, hadoop_path = _store(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a table of this library's own, if it exists."""
    fs, hadoop_path = _store(spark, path)
    fs.delete(hadoop_path, True)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, removed when the driver's
    JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scribal-{uuid.uuid4().hex}"
    fs, hadoop_path = _store(spark, path)
    fs.deleteOnExit(hadoop_path)
    return path


def materialize(df):
    """Cut lineage at a stage boundary: write ``df`` as a Parquet table in the
    shared checkpoint folder (never a node-local one) and read it back, so
    later consumers neither recompute nor re-plan it and still read only the
    columns they use."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
