"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cardlake", cores: int | str = "*", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CARDLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without one, and then gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cardlake-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the shared folder; it may be deleted once the application has ended."""
    return f"{shared_folder(spark)}/cardlake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


_OPEN: ContextVar[list[str] | None] = ContextVar("open", default=None)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts the lineage with files that outlive any executor, and the files' size lets Catalyst decide by itself
    whether a later join can broadcast the table.
    """
    path = scratch_path(df.sparkSession, name)
    if _OPEN.get() is not None:
        _OPEN.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def let_go(*staged: DataFrame) -> None:
    """Delete tables that ``stage`` wrote, or a write to a ``scratch_path``, and that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        for path in {os.path.dirname(f) for f in df.inputFiles()}:
            if f"/cardlake/{spark.sparkContext.applicationId}/" not in path:
                raise ValueError(f"{path} is no staged table")
            _delete(spark, spark.sparkContext._jvm.java.net.URI(path))  # Spark tells its files' names encoded


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are staged inside, at its end. For jobs that leave nothing but what they write elsewhere."""
    paths: list[str] = []
    token = _OPEN.set(paths)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in paths:
            _delete(spark, path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that ends inside at once, not when the driver's garbage is collected."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
