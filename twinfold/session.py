"""Session defaults and staging of intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_stage_dirs: dict[str, str] = {}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the jobs rely on; cluster sizing stays with spark-submit."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def stage_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else set on the context.

    Only a session that runs in one process and names no folder gets a temporary one;
    on a cluster a missing setting is an error, because executors on other machines
    could not read what one of them wrote.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
    app = spark.sparkContext.applicationId
    if app not in _local_stage_dirs:
        _local_stage_dirs[app] = tempfile.mkdtemp(prefix="twinfold-")
    return _local_stage_dirs[app]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors,
    and lets later steps prune columns."""
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go when the driver's JVM collects its garbage: ask for that."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
