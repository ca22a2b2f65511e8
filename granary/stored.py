"""Intermediate tables that cut a plan: written once into the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a temporary folder, but only on a single machine."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {key} to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="granary-")
        spark.conf.set(key, found)
    return found.rstrip("/")


def removed(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended: the folder's owner clears it
        pass


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table that survives lost executors, and whose size Spark knows when it plans joins."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/granary/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(removed, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in tables:
        if path := _paths.pop(df, None):
            removed(df.sparkSession, path)
