"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "flyway") -> SparkSession:
    """Local session used by tests and the bench.  A cluster submit supplies its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and read from the session.
    Only a local master may go without it (tests, bench): then a private scratch
    folder is made.  On any other master a machine-local folder would be written
    in pieces on every executor, so an unset folder is an error there.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.conf.get("spark.master", "").startswith("local[") \
                and spark.conf.get("spark.master", "") != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver "
                               "and all executors share")
        conf = tempfile.mkdtemp(prefix="flyway-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    try:   # RDD checkpoints (ALS); not available to Spark Connect clients
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)
    except Exception:  # noqa: BLE001
        pass
    return conf


def cut_lineage(df: DataFrame, name: str = "table", by: str | None = None) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back.

    One job (``Dataset.checkpoint`` would run the plan twice: once to count, once
    to write), the copy survives executor loss, and the read-back carries exact
    file sizes for AQE's join decisions.  Never ``localCheckpoint``.  ``by``: a column
    whose values get folders of their own, so that a reader of some opens no others.
    What the write shuffled goes from the disks when it ends: later jobs read the copy.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:16]}")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write if by is None else df.write.partitionBy(by)).mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    if by is not None:
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
