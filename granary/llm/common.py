"""What the corpus operators share: reading tables and writing intermediate ones.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``: every
executor and the driver see it, so a lost executor loses no finished work.
"""

from __future__ import annotations

import atexit
import functools
import re
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space between words: the space and the controls from tab to return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@functools.cache
def _zipped() -> str:
    """The package as a zip file, for executors that can't import it."""
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="granary-code-")) / "granary.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(top.rglob("*.py")):
            out.write(source, source.relative_to(top.parent))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package, once a session."""
    if not getattr(spark.sparkContext, "_granary_shipped", False):
        spark.sparkContext.addPyFile(_zipped())
        spark.sparkContext._granary_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, a temporary one on a single machine only."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {key} to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="granary-")
        spark.conf.set(key, found)
    return found.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    except Exception:  # the session has ended: the folder's owner clears it
        pass


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _stored(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    atexit.register(_remove, spark, path)
    df = spark.read.schema(schema).parquet(path)
    _paths[df] = path
    return df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back, which cuts the lineage."""
    path = f"{shared_dir(df.sparkSession)}/granary/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return _stored(df.sparkSession, df.schema, path)


def materialize_parts(df: DataFrame, label: str, flag: Column) -> tuple[DataFrame, DataFrame]:
    """Writes df in one pass as two tables: the rows where flag is true, and the others."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/granary/{label}-{uuid.uuid4().hex}"
    df.withColumn("_flag", F.coalesce(flag, F.lit(False)).cast("int")).write.partitionBy("_flag").parquet(path)
    parts = []
    for value in (1, 0):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_flag={value}")
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)  # where no row is of the kind
        parts.append(_stored(spark, df.schema, f"{path}/_flag={value}"))
    return parts[0], parts[1]


def discard(*tables: DataFrame) -> None:
    """Deletes materialized tables that nothing reads any more."""
    for df in tables:
        path = _paths.pop(df, None)
        if path:
            _remove(df.sparkSession, path)


def in_lots(batches: Iterator[pa.RecordBatch], column: int, *, rows: int = 1000, size: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Parts of batches of at most so many rows, and characters or list items of a column, or one row.

    What a worker computes from one lot is bounded, and is also what it keeps of the system's memory later on.
    """
    for batch in batches:
        values = batch.column(column)
        length = pc.list_value_length if pa.types.is_list(values.type) else pc.utf8_length
        ends = np.cumsum(pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = min(start + rows, max(start + 1, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(start, end - start)
            start = end


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words between white space; an empty array where there is none."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))
