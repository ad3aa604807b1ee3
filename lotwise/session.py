"""SparkSession configuration shared by jobs, tests and the bench.

Cluster jobs get their session from the launcher; ``configure`` only sets the
semantic knobs the library depends on (UTC, AQE) and never overrides resource
settings a cluster already provides.  ``checkpoint_dir`` reads the shared
``spark.checkpoint.dir``; a scratch folder is chosen only when it is unset,
which happens in local tests.
"""
from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SEMANTIC_CONF = {
    # All timestamps are zone-less (TIMESTAMP_NTZ); pin the session zone anyway
    # so casts to/from strings and dates never shift.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition is "skewed" above 5x the median and 256 MB; AQE then splits it.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application: functions that run
    there import it, and neither a cluster's workers nor local ones started elsewhere
    have it on their path."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="lotwise-"), "lotwise"), "zip",
            os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lotwise") -> SparkSession:
    """Local session for tests and the bench (no UI, no servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SEMANTIC_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.  Only a
    local session without one gets a scratch folder: executors of a cluster couldn't read
    each other's."""
    context = spark.sparkContext
    current = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="lotwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


def stored(df: DataFrame) -> DataFrame:
    """``df`` as it is read from compressed columns in the shared folder: a fraction of a checkpoint's disk, which
    writes whole rows.  Shuffle files that nothing refers to any more are let go."""
    path = os.path.join(checkpoint_dir(df.sparkSession), f"frame-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(*jobs: Callable) -> list:
    """The results of ``jobs``, which don't need each other, in their order.  Each runs in a driver thread of its
    own: a fit is hundreds of short Spark jobs, and one fit alone leaves most executors idle."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(job)) for job in jobs]
        return [r.result() for r in running]
