"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "countyrisk", master: str | None = None, initial_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is tested with; ``conf`` overrides win.

    The adaptive planner merges shuffle partitions but never makes more than it starts with, so
    name ``initial_partitions`` for large inputs: about the bytes of the largest shuffle over
    128 MB (for 100 TB of events some 800,000 in all, or 20,000 with 5 GB each spilling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if initial_partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of the cluster for intermediate tables.

    The folder is ``spark.checkpoint.dir`` (or the directory set on the context).
    A machine-local folder is only made up when the session itself is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _LOCAL_ROOTS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="countyrisk-"))
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


_SCOPES: list[list[str]] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the scratch root, removed when the scope it was made in or the
    driver JVM ends."""
    path = f"{scratch_root(spark)}/countyrisk/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    for scope in _SCOPES:
        scope.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside are removed at the end, also after an error. Frames over them must have
    been written by then."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not made]
        for path in made:
            drop_scratch(spark, path)
