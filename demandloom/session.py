"""Session settings and shared storage for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# The feature table has 174 columns, above Spark's default limit of 100 fields for generated code.
# join_by_key relies on joins that shuffle on all their keys; that is Spark's default and pinned here.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "250",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "demandloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor reach: the setting ``spark.checkpoint.dir``.

    A cluster has to set it. Only a plain local session, whose driver and
    executors are one process, may leave it unset and then uses its warehouse.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if context.master.startswith("local-cluster") or not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_demandloom"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, below one folder per application that is removed when it ends."""
    root = f"{shared_dir(spark)}/demandloom-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        system.mkdirs(folder)
        system.deleteOnExit(folder)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by writing the table to shared storage and reading it back.

    A written table survives the loss of any executor and is scanned with
    column pruning.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
