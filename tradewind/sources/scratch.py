"""Where intermediate files go, and how lineage is cut."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder would exist on one machine only.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="tradewind-")
    remove_at_end(spark, own)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialises a frame in the shared folder, so that a lost executor never changes it."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written table, in a folder that goes when the application ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    remove_at_end(spark, folder)
    return f"{folder}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_at_end(spark: SparkSession, folder: str) -> None:
    """Makes a folder that is deleted when the application ends: a query that is still to run may read from it until then."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)            # only what exists can be marked
    fs.deleteOnExit(target)


BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's bound of Arrow batches to BATCH_BYTES, for rows that hold whole blocks."""
    bound = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_KEY))
    if bound <= 0 or bound > BATCH_BYTES:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


@contextmanager
def freed_shuffles(spark: SparkSession, seconds: float = 20):
    """Lets Spark remove the files of shuffles that nothing refers to any more, while an iterative fit goes on and at its end.
    It does so when the driver's garbage is collected, which may else not happen for half an hour."""
    ended = threading.Event()
    collect = spark._jvm.java.lang.System.gc

    def often():
        while not ended.wait(seconds):
            collect()

    thread = threading.Thread(target=often, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        collect()


AT_ONCE = 3   # a fit's small jobs leave cores idle, which two others use; more would only share the executors' memory


def at_once(spark: SparkSession, tasks: list[Callable[[], T]]) -> list[T]:
    """Runs independent tasks, each a chain of Spark jobs, up to AT_ONCE at a time; the longest should come first; their results in order."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [one.result() for one in running]                # a failure is raised
