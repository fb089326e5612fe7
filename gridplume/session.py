"""Session settings, the shared work folder, and tables that cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of a shuffle partition after coalescing, and so roughly of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_own_dirs: dict[str, str] = {}
_session_folders: dict[str, str] = {}
_folder: ContextVar[str | None] = ContextVar("work_folder", default=None)


def build_session(name: str = "gridplume", master: str | None = None, **settings: str) -> SparkSession:
    """A session with this library's settings; ``settings`` (dots as ``__``) win over them.

    On a cluster set ``spark__sql__shuffle__partitions`` to about (bytes shuffled) / 256 MB:
    adaptive execution merges partitions that turn out small but cannot start from too few.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode, where driver and executors share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="gridplume-")
    return _own_dirs[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, or in the running job's part of it."""
    folder = _folder.get()
    if folder:
        return f"{folder}/{name}-{uuid.uuid4().hex}"
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _session_folder(spark: SparkSession) -> str:
    """Where this process keeps work tables that lazy results still read; deleted when it exits."""
    app = spark.sparkContext.applicationId
    if app not in _session_folders:
        _session_folders[app] = f"{shared_dir(spark)}/gridplume/{app}-{uuid.uuid4().hex}"
        atexit.register(_delete_at_exit, spark, _session_folders[app], _own_dirs.get(app))
    return _session_folders[app]


def _delete_at_exit(spark: SparkSession, path: str, own: str | None) -> None:
    # The JVM outlives the session; where it has ended first there is nobody left to ask.
    with suppress(Exception):
        delete_path(spark, path)
    if own:
        shutil.rmtree(own, ignore_errors=True)


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """Work tables made inside are deleted at the end; whatever is read from them must be done by then."""
    path = work_path(spark, name)
    token = _folder.set(path)
    try:
        yield
    finally:
        _folder.reset(token)
        delete_path(spark, path)


def as_written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def rename_path(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder in one step; False, and nothing is changed, if ``to`` is there already."""
    return not path_exists(spark, to) and _file_system(spark, path).rename(_hadoop_path(spark, path), _hadoop_path(spark, to))


def path_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a Hadoop pattern matches, in order."""
    found = _file_system(spark, pattern).globStatus(_hadoop_path(spark, pattern))
    return sorted(f.getPath().toString() for f in found or [])


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
