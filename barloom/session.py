"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results. They are runtime settings, so they can be applied
# to a session somebody else created.
RESULT_SETTINGS = {
    # bar times are UTC
    "spark.sql.session.timeZone": "UTC",
    # code 0050 must stay text when it is read back from a partition path
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # rewrite only the partitions a write touches
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings that change the plan only.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # lets small shuffles keep some parallelism; large ones are sized by the advisory size
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**PLAN_SETTINGS, **RESULT_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir.

    A machine-local folder is made only for a local master, where driver and
    executors are the same process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    already_set = spark.sparkContext.getCheckpointDir()
    if already_set:
        return already_set
    # local[...] runs everything in one process; local-cluster does not
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="barloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
