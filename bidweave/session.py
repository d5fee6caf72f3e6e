"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"
#: Bytes of the log that one task reads where it sorts what it reads.
SPLIT_BYTES = 8 << 20

_local_dirs: dict[str, str] = {}
_made: list[tuple[SparkSession, str]] = []


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and local runs; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bidweave")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a folder of
    its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    on_context = spark.sparkContext.getCheckpointDir() if hasattr(spark, "_jsparkSession") else None
    if on_context:
        return on_context.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="bidweave-")
    return _local_dirs[app]


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the driver program ends."""
    path = f"{shared_dir(spark)}/bidweave/{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def remove_made() -> None:
    """Removes the paths of sessions that still run; a stopped one can remove nothing."""
    for spark, path in _made:
        if spark.sparkContext._jsc is not None:
            delete_path(spark, path)
    _made.clear()


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = hadoop_path(spark, path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below a path."""
    target = hadoop_path(spark, path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    return [status.getPath().toString() for status in found if status.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a path written by this library through the Hadoop file system."""
    target = hadoop_path(spark, path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_path(spark: SparkSession, label: str) -> Iterator[str]:
    """A new path in the shared folder, removed when the block ends."""
    path = new_shared_path(spark, label)
    try:
        yield path
    finally:
        delete_path(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later reads survive lost executors."""
    spark, schema = df.sparkSession, df.schema
    path = new_shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in splits of ``SPLIT_BYTES`` at most by queries that begin inside the block."""
    before = spark.conf.get(SPLIT_SETTING)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) <= SPLIT_BYTES:
        yield
        return
    spark.conf.set(SPLIT_SETTING, SPLIT_BYTES)
    try:
        yield
    finally:
        spark.conf.set(SPLIT_SETTING, before)
