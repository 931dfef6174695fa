"""Session settings for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def local_session(cores: str = "8", app: str = "arealis", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    """A local session's folder; it goes with the process."""
    return tempfile.TemporaryDirectory(prefix="arealis-", ignore_cleanup_errors=True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session without that setting falls back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = _own_folder().name
    run = f"/{_RUN.get()}" if _RUN.get() else ""
    return f"{root.rstrip('/')}{run}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables stored in here go into one folder, which is removed at the end, also after a failure.

    For jobs that write their result: a DataFrame that was made in here and is read afterwards has lost its tables. A run within
    a run shares the outer one's folder.
    """
    if _RUN.get():
        yield scratch_dir(spark, "").rsplit("/", 1)[0]
        return
    token = _RUN.set(f"run-{uuid.uuid4().hex}")
    folder = scratch_dir(spark, "").rsplit("/", 1)[0]
    try:
        yield folder
    finally:
        _RUN.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For results several parts of a plan need: they are computed once, a lost executor does not bring their
    lineage back, and file sizes tell the optimizer which joins to broadcast.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
