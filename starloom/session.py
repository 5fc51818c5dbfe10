"""Session settings and the shared folder used to cut lineage.

Intermediate tables go to the folder the cluster names in ``spark.checkpoint.dir``.  Only a local session
without that setting gets a temporary folder; anywhere else the missing setting is an error, because an
executor-local folder would be lost with the executor.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_fallback: dict[str, str] = {}
# Shuffle files go when their query ends, instead of when the driver happens to collect its garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, tuple[int, str]] = {}  # by session: open blocks, and the setting before the first of them
_lock = Lock()
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)

# Settings a deployment should start from; none of them changes results.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from the session's own setting."""
    conf = spark.sparkContext.getConf()
    named = conf.get(_SETTING) or spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _local_fallback[app], ignore_errors=True)  # this process's own folder
    return _local_fallback[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path never used before, grouped by application so that one prefix can be expired."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/starloom/{app}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside are deleted at the end, so nothing that reads them may get out.

    The innermost block owns a table.  Threads take part if they run in a copy of the context.  Inside, shuffle files are
    removed when their query ends; a plan that runs once more makes them again.
    """
    mine: list[str] = []
    token = _passing.set(mine)
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        users, before = _cleaning.get(session, (0, spark.conf.get(_SHUFFLE_CLEANUP)))
        _cleaning[session] = users + 1, before
        spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        _passing.reset(token)
        with _lock:
            users, before = _cleaning.pop(session)
            if users > 1:
                _cleaning[session] = users - 1, before
            else:
                spark.conf.set(_SHUFFLE_CLEANUP, before)
        for path in mine:
            delete_folder(spark, path)


@contextmanager
def lasting_tables() -> Iterator[None]:
    """Tables written inside stay, also within ``passing_tables``."""
    token = _passing.set(None)
    try:
        yield
    finally:
        _passing.reset(token)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Through the session's file systems: they know every path that Spark can write."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has no lineage, so values that depend on partition layout (row positions, range boundaries)
    stay fixed when an executor is lost and its tasks run again.
    """
    path = scratch_path(df.sparkSession, label)
    mine = _passing.get()
    if mine is not None:
        mine.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
