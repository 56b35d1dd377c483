"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library's results rely on. Shuffle width is left to the cluster and AQE.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or one below the warehouse, which a cluster shares as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share; the warehouse is a local path")
    return f"{warehouse.rstrip('/')}/_tidemark"


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's part of the shared folder; nothing is created yet."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on any Hadoop file system; an absent one is no error."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written aside; tables that were read from it can no longer be read."""
    remove_path(spark, _application_dir(spark))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors, keeps column pruning and filter pushdown,
    and fixes values such as partition ids that a recomputation could change.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
