"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
#: Independent jobs that run together.
PARALLEL_JOBS = 8

# Runtime-changeable SQL settings the operators are designed for.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode. Wide projections pass that in one fused
    # stage and then run interpreted; with this limit Spark generates them in smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A raw record is some 20 bytes of Parquet and 500 as a typed row; what a task reads must still fit its memory when
    # it is sorted, and small tables must be split for all cores.
    "spark.sql.files.maxPartitionBytes": "8m",
    # The default, a 12-byte legacy form, takes longer to write and to read.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A task that writes to two folders keeps both files open, where it would sort its rows by folder first.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[str] = []
_removing, _inside = Lock(), []


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL settings above on the caller's session, the time zone among them."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where that is unset, one inside the warehouse. A warehouse on
    the machine's own disk, which executors elsewhere do not share, is refused unless the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    scheme = jvm.org.apache.hadoop.fs.Path(warehouse).getFileSystem(settings).getUri().getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return warehouse + "/scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate data; it goes with ``release`` or the end of ``scratch``."""
    path = f"{scratch_root(spark)}/inciscope/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back; the folder goes with ``release`` or the end of ``scratch``.

    Cuts the lineage in a way that outlives executors, and gives the planner the true file size, so a small
    result is broadcast by Spark's own threshold and a big one is not.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it is done, not when the driver happens to collect its garbage.

    For a frame that is written once and not kept: run again, it would be shuffled again.
    """
    with _removing:  # threads share the setting: the first one in sets it, the last one out puts it back
        if not _inside:
            _inside.append(spark.conf.get(SHUFFLE_CLEANUP, "false"))
        _inside.append(spark)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _removing:
            _inside.pop()
            if len(_inside) == 1:
                spark.conf.set(SHUFFLE_CLEANUP, _inside.pop())


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], T]]) -> list[T]:
    """Results of independent jobs, in order, run together: small ones mostly wait for the scheduler."""
    run = inheritable_thread_target(spark)(lambda job: job())
    with ThreadPoolExecutor(max(1, min(len(jobs), PARALLEL_JOBS))) as pool:
        return list(pool.map(run, jobs))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the stored copies made since the ``since``-th; nothing may read them any more."""
    for path in _written[since:]:
        remove(spark, path)
    del _written[since:]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the stored copies made inside: they are deleted at the end, so results must be taken out before."""
    since = len(_written)
    try:
        yield
    finally:
        release(spark, since)
