"""Writers: one CSV file, keyed upserts into Parquet, a workbook."""

from __future__ import annotations

import functools
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.quality import require_columns
from granary.operators.relational import upserted
from granary.sources.files import exists


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """A report as one file with a header; for tables that a person opens."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def _files(spark: SparkSession, path: str) -> tuple:
    """(a function that makes paths, the file system that path is on)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at, at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def upsert_parquet(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> None:
    """Replaces rows of the same keys and adds the others: the whole of a small table, written beside it and swapped in.

    The swap takes two renames. If a run dies between them, the next one finds the written table and ends the swap.
    Large tables are better served by ``upsert_partitions``, which writes only what changes.
    """
    at, fs = _files(spark, path)
    base = path.rstrip("/")
    staged, old = f"{base}.staged", f"{base}.old"

    def swap() -> None:
        if fs.exists(at(path)):
            fs.delete(at(old), True)
            fs.rename(at(path), at(old))
        fs.rename(at(staged), at(path))
        fs.delete(at(old), True)

    if not fs.exists(at(path)) and fs.exists(at(f"{staged}/_SUCCESS")):
        swap()
    merged = upserted(spark.read.parquet(path), new, keys) if exists(spark, path) else new
    merged.write.mode("overwrite").parquet(staged)
    swap()
    spark.catalog.refreshByPath(path)


#: Columns by which a table of hashed partitions is laid out: how many there are, and a row's own.
LAYOUT = ["_parts", "_part"]


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that upsert_partitions wrote."""
    return spark.read.parquet(path).drop(*LAYOUT)


def _latest(new: DataFrame, keys: list[str], order: str | None) -> DataFrame:
    """One row for each key, the last by order; rows with a null key are nobody's, and all stay."""
    keyed = functools.reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    if order is None:
        twice = new.filter(keyed).groupBy(*keys).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"several rows of one key, as of {[twice[0][k] for k in keys]}; name the column that orders them")
        return new
    row = F.struct(*(F.col(f"`{c}`") for c in new.columns))
    last = new.filter(keyed).groupBy(*keys).agg(F.max_by(row, order).alias("_row")).select("_row.*")
    return last.unionByName(new.filter(~keyed))


def _replace_partitions(spark: SparkSession, path: str, staged: str) -> None:
    """Puts staged partitions in place of those of the same number. Doing it again does no harm."""
    rows = spark.read.parquet(staged)
    put = rows.hint("rebalance", *LAYOUT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    put.partitionBy(*LAYOUT).parquet(path)
    at, fs = _files(spark, path)
    fs.delete(at(staged), True)
    spark.catalog.refreshByPath(path)


def upsert_partitions(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: str | None = None, parts: int = 64) -> list[int]:
    """Replaces rows of the same keys and adds the others, in the partitions that new touches alone; their numbers are returned.

    Rows are laid out by a hash of their keys in ``parts`` partitions, a number that the first call fixes. The table is
    there all the time: touched partitions are staged whole in a hidden folder of it, then put in place. A run that dies
    on the way leaves a staged copy, which the next one puts in place before it begins, so no row is lost; a run that is
    repeated changes nothing. Several new rows of a key need ``order``, whose last row counts.
    """
    at, fs = _files(spark, path)
    staged = f"{path.rstrip('/')}/_staged"
    if fs.exists(at(f"{staged}/_SUCCESS")):
        _replace_partitions(spark, path, staged)
    there = exists(spark, path) and any(s.getPath().getName().startswith("_parts=") for s in fs.listStatus(at(path)))
    if there:
        parts = spark.read.parquet(path).select("_parts").first()["_parts"]
    place = {"_parts": F.lit(parts), "_part": F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")}
    incoming = _latest(new, keys, order).withColumns(place)
    if not there:
        incoming.hint("rebalance", *LAYOUT).write.mode("overwrite").partitionBy(*LAYOUT).parquet(path)
        return sorted(r[0] for r in spark.read.parquet(path).select("_part").distinct().collect())
    touched = sorted(r[0] for r in incoming.select("_part").distinct().collect())  # at most parts
    existing = spark.read.parquet(path).filter(F.col("_part").isin(touched))
    upserted(existing, incoming, keys).write.mode("overwrite").parquet(staged)
    _replace_partitions(spark, path, staged)
    return touched


_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels"'
    ' ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml"'
    ' ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml"'
    ' ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1"'
    ' Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    ' xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="data" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1"'
    ' Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


def write_xlsx(df: DataFrame, path: str, limit: int = 1_048_575) -> None:
    """A local workbook of at most a sheet's rows; more are refused."""
    rows = df.select(*(F.col(f"`{c}`").cast("string") for c in df.columns)).limit(limit + 1).toLocalIterator()
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in _PARTS.items():
            book.writestr(name, text)
        with book.open("xl/worksheets/sheet1.xml", "w") as out:
            put = lambda values: out.write(("<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v or "")}</t></is></c>' for v in values) + "</row>").encode())
            out.write(b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
            put(df.columns)
            for n, row in enumerate(rows):
                if n == limit:
                    raise ValueError(f"more than {limit} rows")
                put(row)
            out.write(b"</sheetData></worksheet>")


def write_csv_marked(df: DataFrame, path: str, sep: str = ",") -> None:
    """As write_csv, with the byte order mark by which spreadsheet programs know the encoding."""
    first, *rest = df.columns
    write_csv(df.select(F.col(f"`{first}`").alias(f"﻿{first}"), *(F.col(f"`{c}`") for c in rest)), path, sep)


def create_table(spark: SparkSession, name: str, schema: str, partition_by: list[str] = ()) -> None:
    """An empty Parquet table, unless it is there; keys are kept unique by ``upsert_parquet``, not by the table."""
    by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{by}")


def replace_table(df: DataFrame, name: str) -> None:
    """Replaces a table's rows and columns by those of df."""
    df.write.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)


def hand_off(df: DataFrame, path: str) -> None:
    """A table for the next step of a chain, with its types; a run that fails leaves no _SUCCESS, by which take_over knows."""
    df.write.mode("overwrite").parquet(path)


def take_over(spark: SparkSession, path: str, kinds: dict[str, str] | None = None) -> DataFrame:
    """The table that hand_off left, once it is whole and has the columns that are wanted."""
    if not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        raise FileNotFoundError(f"no whole table at {path}")
    return require_columns(spark.read.parquet(path), kinds or {})
