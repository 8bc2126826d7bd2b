"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Applied only where the session does not say otherwise.  Hot join keys are split by
# adaptive execution even if that costs one more shuffle; batches for Python hold as many long texts as a worker has
# room for.  Shuffles start from many partitions, which adaptive execution merges up to its advisory size: so a task's share
# does not grow with the tables.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

_local_folders: dict[str, str] = {}
_collected: ContextVar[list[str] | None] = ContextVar("collected", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Fill in settings the session leaves open; never override a choice made by the cluster.

    Python workers are told where the driver has this package, so that functions of it are found from any folder.
    """
    root, paths = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "restock", shuffle_partitions: int | None = None) -> SparkSession:
    """Single-machine session for tests and the bench."""
    partitions = shuffle_partitions or (int(cores) if cores.isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
        .config("spark.sql.files.maxPartitionBytes", "4m")  # the test tables are small
        .config("spark.sql.files.openCostInBytes", "256k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="restock-")
    return _local_folders[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_folder(spark)}/restock/{name}-{uuid.uuid4().hex}"
    if (own := _collected.get()) is not None:
        own.append(path)
    return path


@contextmanager
def collected() -> Iterator[list[str]]:
    """The work paths that are handed out in the block by this thread, for ``discard``."""
    paths: list[str] = []
    token = _collected.set(paths)
    try:
        yield paths
    finally:
        _collected.reset(token)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete what was written to some work paths, once nothing is computed from it any more."""
    files = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        place = files(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def together(spark: SparkSession, *builders: Callable[[], T]) -> list[T]:
    """Run independent jobs at the same time and return their results."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(builders)) as pool:
        return [job.result() for job in [pool.submit(inherit(b)) for b in builders]]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once and read it back.

    The plan above starts from files that outlive a lost executor, and the file sizes give Catalyst the
    real size of the table: it is broadcast only if that is under ``spark.sql.autoBroadcastJoinThreshold``,
    otherwise it is sort-merge joined and hot keys are split by adaptive execution.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
