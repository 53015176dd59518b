"""Session helpers: a local session for tests and benches, and lineage cuts.

On a cluster the session is built by the platform; we only read its
settings.  ``spark.checkpoint.dir`` must name a shared folder there; we set
our own folder only when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    """Return the active session or build a local one tuned for this library."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the one the session names in
    ``spark.checkpoint.dir`` (a shared folder on a cluster).

    Only a local-mode session without that setting (tests, local benches)
    gets a fresh folder of its own; a cluster session without it is an error,
    because a machine-local folder would not survive an executor loss.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster session")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) in the shared checkpoint
    folder and read it back, under ``schema`` if given: cuts the lineage, survives lost
    executors, and lets the planner see the true size."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
