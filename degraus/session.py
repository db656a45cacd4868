"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the scale behaviour depend on; everything else is left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A gated run compiles a few hundred small plans; the default of 100 entries recompiles them.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def get_session(app: str = "degraus", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; extra settings are passed as ``spark__sql__x="v"``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder the cluster names.

    A machine-local folder is used only in local mode when the cluster setting is absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="degraus-")
    return f"{base.rstrip('/')}/degraus/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    For a result that several steps read: it is computed once, its lineage ends in a table that
    outlives any executor, and later scans read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete stored results that no later step reads. Other DataFrames, and tables deleted before, are left alone."""
    for table in tables:
        path = getattr(table, "stored_at", None)
        if path is not None:
            spark = table.sparkSession
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let the driver collect what finished steps held.

    Spark deletes shuffle files and broadcasts once the driver has collected the plans they belong to. A driver with much
    memory collects seldom, so an iterative operator asks for it after a round. It takes two collections: Spark drops the
    last references to a shuffle when it cleans up what the first one has freed.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.25)
    spark.sparkContext._jvm.System.gc()


def at_once(steps: Mapping[str, Callable[[], object]], workers: int = 12) -> dict[str, object]:
    """Run independent steps from several driver threads, so that small jobs fill idle executors."""
    with ThreadPoolExecutor(workers) as pool:
        futures = {name: pool.submit(step) for name, step in steps.items()}
        return {name: future.result() for name, future in futures.items()}
