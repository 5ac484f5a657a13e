"""Session set-up and the shared scratch folder.

Operators that must freeze a row layout write it as a Parquet table under the
folder the cluster names in ``spark.checkpoint.dir``.  Such a table survives
the loss of executors, and later passes read only the columns they need.
"""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # open windows keep one entry per value: more than a heap may hold
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables of this application, visible to every executor.

    It lies in ``spark.checkpoint.dir``, else beside the tables of the
    warehouse, and is deleted when the session's Python ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    application = spark.sparkContext.applicationId
    if application not in _cleaned:
        _cleaned.add(application)
        atexit.register(_clear_at_end, spark)
    return f"{configured.rstrip('/')}/{application}"


_cleaned: set[str] = set()


def _clear_at_end(spark: SparkSession) -> None:
    """Nothing is left to clear through a session that has been stopped."""
    if spark.sparkContext._jsc is not None:
        clear_scratch(spark)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_starting = threading.Lock()


@contextmanager
def timed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state in RocksDB if the session has Spark's default store.

    That store holds one state per key and refuses processors with several, timers
    among them.  A stream copies the settings when it starts, so those of the session
    are put back; a store that the session names itself stays.
    """
    with _starting:
        given = spark.conf.get(_PROVIDER)
        if not given.endswith(".HDFSBackedStateStoreProvider"):
            yield
            return
        spark.conf.set(_PROVIDER, SESSION_DEFAULTS[_PROVIDER])
        try:
            yield
        finally:
            spark.conf.set(_PROVIDER, given)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread writes under the scratch folder inside the block are deleted at its end."""
    outer, _scopes.paths = getattr(_scopes, "paths", None), []
    try:
        yield
    finally:
        for path in _scopes.paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _scopes.paths = outer


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if getattr(_scopes, "paths", None) is not None:
        _scopes.paths.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, which fixes its rows and cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession, label: str = "") -> None:
    """Delete this application's intermediate tables whose label starts with ``label``.

    Call it once the results that read them are stored.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return
    for entry in files.listStatus(root):
        if entry.getPath().getName().startswith(label):
            files.delete(entry.getPath(), True)
