"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are tuned for. Everything else is left to the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Of stored tables and frozen results; text columns take two thirds of what snappy leaves.
CODEC = "zstd"


def build_session(app_name: str = "ordermart", **settings: str) -> SparkSession:
    """Session with the recommended settings; keyword settings use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="ordermart-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage on reliable storage, keeping partitions and their row order."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    For results used several times where partition order does not matter: later readers
    scan only the columns they need, and a lost executor costs a re-read, not a re-run.
    """
    return _stored(df, scratch_path(df.sparkSession, name))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def frozen(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``freeze`` for the length of a ``with`` block; the files are removed behind it."""
    folder = scratch_path(df.sparkSession, name)
    try:
        yield _stored(df, folder)
    finally:
        remove_folder(df.sparkSession, folder)


def _files(spark: SparkSession, folder: str) -> tuple:
    """File system of a folder, and the folder as its path."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    files, path = _files(spark, folder)
    files.delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _files(spark, folder)
    return files.exists(path)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the folders directly below one, none where it does not exist."""
    files, path = _files(spark, folder)
    if not files.exists(path):
        return []
    return [entry.getPath().toString() for entry in files.listStatus(path) if entry.isDirectory()]


def move_files(spark: SparkSession, source: str, target: str, prefix: str = "") -> None:
    """Move the files of a folder into another, with a prefix before their names."""
    files, path = _files(spark, source)
    files.mkdirs(_files(spark, target)[1])
    for entry in files.listStatus(path):
        moved = _files(spark, f"{target}/{prefix}{entry.getPath().getName()}")[1]
        if not files.rename(entry.getPath(), moved):
            raise OSError(f"{entry.getPath()} was not moved to {moved}")


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder, 0 where it does not exist."""
    files, path = _files(spark, folder)
    return files.getContentSummary(path).getLength() if files.exists(path) else 0


def full_path(spark: SparkSession, folder: str) -> str:
    """The folder with its file system and without relative parts."""
    files, path = _files(spark, folder)
    return files.makeQualified(path).toString()
