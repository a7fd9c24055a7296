"""Cutting lineage: intermediate tables are written to the shared work folder and read back.

A written parquet table survives the loss of executors, keeps column pruning and filter pushdown, and has a
known size, so Spark itself decides whether a join against it may broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a folder of the warehouse, which is shared too."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return shared.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/backsight/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a work folder through Hadoop's file system, so that long loops use bounded space."""
    if f"/backsight/{spark.sparkContext.applicationId}/" not in path:
        raise ValueError(f"not a work folder of this application: {path}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame, label: str = "table", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
