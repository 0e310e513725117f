"""Session settings the job relies on, and the shared scratch folder.

* Dates are cut in UTC: ``to_date`` depends on the session zone, which the job pins.
* Scratch data (staged tables) lives under the cluster's checkpoint folder (``spark.checkpoint.dir``),
  which a cluster points at shared storage (a ``file:`` folder too, where it is a shared mount). Only
  when it is unset and the session is local (tests, local runs) do we pick a local folder ourselves.
* Scratch folders belong to the application and go when the driver exits; those made inside a
  ``scratch_scope`` go when the scope ends.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import SparkSession

_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)
_RUN_FOLDERS: set[str] = set()


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Pin the settings whose value changes results. Cheap; safe to call per query."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a local one only when the cluster names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is unset: point it at a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="listenkpi-ckpt-"))
    return sc.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in Spark's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through Spark's file system; nothing happens if it isn't there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def run_folder(spark: SparkSession) -> str:
    """This application's scratch folder under the checkpoint root; deleted when the driver exits."""
    folder = f"{checkpoint_root(spark).rstrip('/')}/listenkpi/{spark.sparkContext.applicationId}"
    if folder not in _RUN_FOLDERS:
        _RUN_FOLDERS.add(folder)

        def clean() -> None:
            with contextlib.suppress(Exception):  # nothing can be done about it at exit
                if spark.sparkContext._jsc is not None:  # a session stopped before should drop_scratch first
                    delete_path(spark, folder)

        atexit.register(clean)
    return folder


def drop_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch folder: before a session is stopped by hand."""
    folder = run_folder(spark)
    delete_path(spark, folder)
    _RUN_FOLDERS.discard(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path in the application's scratch folder (not created)."""
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside go when it ends: for work whose result is written before that."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in made:
            delete_path(spark, path)


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None, app: str = "listenkpi",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench. On a cluster, the cluster's own session is used."""
    parts = shuffle_partitions or (2 * int(cores) if str(cores).isdigit() else 16)
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LISTENKPI_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
