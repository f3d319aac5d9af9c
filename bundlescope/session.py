"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(name: str, cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8" if cpus == "*" else str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bundlescope-warehouse-"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    fallback = os.path.join(tempfile.gettempdir(), "bundlescope", spark.sparkContext.applicationId)
    if not os.path.isdir(fallback):
        os.makedirs(fallback)
        atexit.register(shutil.rmtree, fallback, ignore_errors=True)
    return fallback


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own under the shared folder, deleted when the program ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_delete_at_exit)
    _scratch.append(path)
    return path


def _delete(jvm, conf, paths: list[str]) -> None:
    for path in paths:
        location = jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(conf).delete(location, True)
        if path in _scratch:
            _scratch.remove(path)


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch paths that nothing reads any more; others are left alone."""
    _delete(spark._jvm, spark._jsc.hadoopConfiguration(), [p for p in paths if p in _scratch])


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is written as scratch within is deleted at the end; results must be elsewhere then."""
    before = set(_scratch)
    yield
    delete_scratch(spark, [path for path in _scratch if path not in before])


def _delete_at_exit() -> None:
    jvm, context = SparkContext._jvm, SparkContext._active_spark_context
    if jvm is not None:
        # At the end of a program a file system that is gone is no reason to complain.
        with contextlib.suppress(Exception):
            conf = context._jsc.hadoopConfiguration() if context else jvm.org.apache.hadoop.conf.Configuration()
            _delete(jvm, conf, list(_scratch))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, whatever is lost later."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
