"""Session helpers: where intermediate tables go, and how they are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark then removes the shuffle files of an execution at its end, and not when the driver happens to collect garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROW_ID = "_row_id"


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        CHECKPOINT_CONF: tempfile.mkdtemp(prefix="labelloom-"),
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("labelloom")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Session settings for a corpus of this size: shuffle partitions near 512 MB, AQE on.

    The initial partition number follows the data; AQE merges what turns out small and
    splits what turns out skewed.
    """
    partitions = max(4 * executor_cores, input_bytes // (512 << 20), 200)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
    }


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as named by the cluster.

    Where it is unset, a session on one machine (a local master, as in tests) gets a folder of its own; on a cluster
    that is an error, as executors cannot see the driver's disk.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    return _own_dir(spark.sparkContext.applicationId)


@cache
def _own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"labelloom-{application}-")


_job_paths: ContextVar[list[str] | None] = ContextVar("job_paths", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are dropped at the end, also after a failure.

    For jobs that write their result. A DataFrame must not leave the block if it reads a
    staged table.
    """
    paths: list[str] = []
    token = _job_paths.set(paths)
    try:
        yield
    finally:
        _job_paths.reset(token)
        for path in paths:
            drop(spark, path)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder. What is there is dropped when the job or else the session ends."""
    path = f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _job_paths.get()) is not None:
        paths.append(path)
    return path


_session_dirs: dict[str, str] = {}


def _session_dir(spark: SparkSession) -> str:
    """This session's part of the shared folder; the file system deletes it when the driver ends."""
    application = spark.sparkContext.applicationId
    if application not in _session_dirs:
        path = f"{shared_dir(spark)}/labelloom/{application}"
        hadoop_path, fs = _file_system(spark, path)
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
        _session_dirs[application] = path
    return _session_dirs[application]


def drop(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _file_system(spark, path)
    fs.delete(hadoop_path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs inside go when it ends."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_CONF) if before is None else spark.conf.set(CLEANUP_CONF, before)


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it.

    Unlike a cached frame the table survives the loss of executors, and unlike
    ``checkpoint()`` later passes read only the columns they touch. Once it is written, nothing reads its shuffles again.
    """
    path = path or new_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_with_row_id(df: DataFrame, name: str = "rows") -> DataFrame:
    """``stage`` plus a row identity that stays the same on every later read."""
    staged = stage(df, name)
    row_id = F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    return staged.select("*", row_id.alias(ROW_ID))


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return bool(fs.exists(hadoop_path))


def list_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Files below a path, at any depth, whose name ends with ``suffix``; hidden ones (``_`` or ``.``) don't count."""
    hadoop_path, fs = _file_system(spark, path)
    found, listing = [], fs.listFiles(hadoop_path, True)
    start = len(fs.getFileStatus(hadoop_path).getPath().toString()) + 1
    while listing.hasNext():
        name = listing.next().getPath().toString()
        if name.endswith(suffix) and not any(part[:1] in "_." for part in name[start:].split("/")):
            found.append(name)
    return sorted(found)


def read_head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first ``size`` bytes of a file."""
    hadoop_path, fs = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def is_directory(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return bool(fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory())
