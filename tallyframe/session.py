"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def spark_session(app: str = "tallyframe", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with adaptive execution, skew handling and UTC timestamps."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the cluster's checkpoint folder.

    ``spark.checkpoint.dir`` wins. A local session without the setting (tests, a laptop) gets a
    scratch folder that goes with the process; a cluster session without it is an error, because executors would not share it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="tallyframe-checkpoint-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    context.setCheckpointDir(scratch)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def held_for_training(df: DataFrame) -> DataFrame:
    """Write rows an iterative fit reads many times to the checkpoint folder, spread over every core.

    Small inputs arrive in one or two partitions after adaptive coalescing and would train on one
    core; inputs with enough partitions are left as they are. Nothing stays cached: the files go when
    nothing refers to them any more.
    """
    held = checkpointed(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return held if held.rdd.getNumPartitions() >= cores else checkpointed(held.repartition(cores))
