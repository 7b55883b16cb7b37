"""Intermediate tables in the shared folder, and their removal once a later table replaces them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filelake.session import new_folder


def put(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: the table and its path."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str | None) -> None:
    """Remove a table of ``put`` that no later plan reads."""
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
