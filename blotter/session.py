"""Session helpers.

The library never builds its own session inside an operator: every operator
takes DataFrames and returns DataFrames.  These helpers exist for tests, the
bench and the command-line pipelines, and for reading the cluster's shared
checkpoint folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "blotter", driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local[N] session configured the way a cluster job would be.

    AQE stays on (runtime coalescing and skew-join splitting), the UI is off,
    the session time zone is UTC so month boundaries do not depend on the host.
    ANSI mode keeps Spark 4's default; operators use ``try_*`` where a bad
    value must become NULL instead of failing the job.
    """
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # the plans of past queries stay in the driver's heap; a pipeline runs hundreds of them
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "100")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    return sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, set as the checkpoint folder.

    ``spark.checkpoint.dir`` as the session names it; where it is unset, a folder
    of the warehouse, which Spark itself needs to be shared.  The same rule holds
    on one machine and on a cluster; no machine-local temporary folder is used.
    """
    folder = checkpoint_dir(spark) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/blotter_checkpoints")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, removed when the driver's JVM ends."""
    where = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder.

    Used between pipeline stages whose result feeds several branches, so a
    lost executor recomputes from the checkpoint rather than from the raw
    sources.  Never a local checkpoint: those die with the executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # cached while checkpointing: the count that triggers it and the write of
    # the files then compute the input once, not twice
    df = df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
