"""The order of rows in their files, which no setting of splits or number of tasks changes.

A row's place is its file's path and its index in the file. Parquet has the index
itself; of text files the start of a row's split and its place within the split
give the same order, as a split is read by one task from its start on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.stored import stored

#: The column that holds a row's place: a struct that sorts as the files and their rows do.
PLACE = "_place"


def read_in_order(spark: SparkSession, path: str | list[str], form: str = "parquet", schema: str | None = None, **options: object) -> DataFrame:
    """Rows of files with their place, to be used before any join, filter or shuffle changes what a task reads."""
    reader = spark.read.format(form).options(**options)
    df = (reader.schema(schema) if schema else reader).load(path)
    within = F.col("_metadata.row_index") if form == "parquet" else F.monotonically_increasing_id()
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), within.alias("row"))
    if form == "parquet":  # the index counts from the file's start, whatever the split
        place = F.struct(place["file"].alias("file"), F.lit(0).cast("long").alias("block"), place["row"].alias("row"))
    return df.select("*", place.alias(PLACE))


def first_in_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row of each key; a key's rows are reduced where they are read, so that a frequent key costs no more."""
    rest = [c for c in df.columns if c not in (*keys, PLACE)]
    first = F.min_by(F.struct(*(F.col(f"`{c}`") for c in rest), PLACE), PLACE)
    return df.groupBy(*keys).agg(first.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def head_in_order(df: DataFrame, n: int) -> DataFrame:
    """The first n rows: each task keeps its first n."""
    return df.orderBy(PLACE).limit(n)


def numbered(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """df with its rows numbered from 0 in their order; PLACE stays.

    Counts of blocks, a row for each split of a file, are summed up to give each block's first number. The rows are
    stored first, as a second reading could be split in other ways.
    """
    kept = stored(df, "ordered")
    block = [F.col(f"{PLACE}.file").alias("_file"), F.col(f"{PLACE}.block").alias("_block")]
    counts = kept.groupBy(*block).agg(F.count("*").alias("_n"), F.min(f"{PLACE}.row").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = (F.col(f"{PLACE}.file") == F.col("_file")) & (F.col(f"{PLACE}.block") == F.col("_block"))
    out = kept.join(F.broadcast(starts), same)  # a shuffle would send all rows of a block to one task
    return out.select(*df.columns, (F.col("_start") + F.col(f"{PLACE}.row") - F.col("_first")).alias(name))


def ordered_first(column: Column) -> Column:
    """The aggregate that gives a group's first known value in row order."""
    return F.min_by(column, F.when(column.isNotNull(), F.col(PLACE)))
