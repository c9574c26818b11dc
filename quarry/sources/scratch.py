"""Scratch locations for intermediate writes: always under the shared
checkpoint folder the cluster names (never a machine-local temp folder)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet files in the shared folder, read back; they go at the end of the application."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)
