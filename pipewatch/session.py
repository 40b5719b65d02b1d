"""Session helpers: a local session for tests and durable lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A ``local[cores]`` session with the settings the library expects."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pipewatch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PIPEWATCH_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        # A checkpoint goes as soon as nothing reads it any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Column call sites are only for error messages and slow plan building down.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif re.match(r"local(\[|$)", context.master):
        # One machine: every task sees its temporary folder.
        context.setCheckpointDir(os.path.join(tempfile.gettempdir(), "pipewatch-checkpoints"))
    else:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach"
        )


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read on from there.

    Used where a result must not be computed twice (row positions) or where an
    iteration would grow the lineage without end.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``durable`` frame that nothing reads any more.

    Spark does so by itself once the driver has collected the frame as garbage, which may be long after.
    """
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return
    written = plan.rdd().getCheckpointFile()
    if written.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(written.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this session: shared by the driver and all executors."""
    _ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tasks of jobs run in this block hand Python at most so many rows at a time.

    For rows with long texts or sets: a batch is held by the JVM and by Python, there several times.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    if 0 < before <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))
