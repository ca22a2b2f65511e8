"""Delimited text, word lists, spreadsheets and JSON documents, always with an explicit schema."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.text import to_number


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", decimal: str = ".") -> DataFrame:
    """A delimited file with a header. With a decimal comma, numbers are read as text and converted; bad ones are null."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("header", True).option("sep", sep)
    if decimal == ".":
        return reader.schema(wanted).csv(path)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    columns = [
        (to_number(F.col(f"`{f.name}`")).cast(f.dataType) if isinstance(f.dataType, T.NumericType) else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name)
        for f in wanted.fields
    ]
    return reader.schema(texts).csv(path).select(*columns)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_optional_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """An empty table where there is no file; a byte order mark before the header does no harm."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", True).csv(path)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first of several candidate places that is there."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {', '.join(paths)}")


def read_terms(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(place, term): a term a line, without quotes and trailing comma, the first of repeated ones; an error if none.

    Of several paths the first that exists is read. place is the term's order in the file.
    """
    path = path if isinstance(path, str) else first_existing(spark, path)
    lines = spark.read.text(path, wholetext=True)
    parts = F.split(F.regexp_replace("value", "^\ufeff", ""), r"\r?\n")
    terms = F.transform(parts, lambda x: F.trim(F.btrim(F.regexp_replace(F.trim(x), r"\s*,\s*$", ""), F.lit("\"'"))))
    unique = F.array_distinct(F.filter(terms, lambda x: x != ""))
    found = lines.select(F.posexplode(unique).alias("place", "term"))
    if found.isEmpty():
        raise ValueError(f"no terms in {path}")
    return found


def _cell_column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes) -> Iterator[list[str | None]]:
    """The rows of a workbook's first sheet, as text."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        tag = lambda e: e.tag.rpartition("}")[2]
        names = book.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in item.iter() if tag(t) == "t") for item in root]
        sheet = min(n for n in names if n.startswith("xl/worksheets/") and n.endswith(".xml"))
        for row in (e for e in ElementTree.fromstring(book.read(sheet)).iter() if tag(e) == "row"):
            out: list[str | None] = []
            for k, cell in enumerate(c for c in row if tag(c) == "c"):
                at = _cell_column(cell.get("r")) if cell.get("r") else k
                out += [None] * (at + 1 - len(out))
                text = "".join(t.text or "" for t in cell.iter() if tag(t) in ("v", "t"))
                out[at] = (shared[int(text)] if cell.get("t") == "s" else text) if text else None
            yield out


def read_xlsx(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of every workbook under path, as trimmed text; header matched without case and spaces.

    A file is read by one task, a sheet's rows stream from it.
    """
    plain = lambda s: re.sub(r"\s+", "", s or "").lower()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = sheet_rows(data)
                header = [plain(h) for h in next(rows, [])]
                at = [header.index(plain(c)) if plain(c) in header else None for c in columns]
                table = [[(r[i] if i is not None and i < len(r) else None) for i in at] for r in rows if any(r)]
                cells = [pa.array([r[k] for r in table], pa.string()) for k in range(len(columns))]
                yield pa.RecordBatch.from_arrays(cells, columns)

    files = spark.read.format("binaryFile").load(path).select("content")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    out = files.mapInArrow(run, schema)
    return out.select(*(F.trim(F.col(f"`{c}`")).alias(c) for c in columns))


HOURLY = "hourly struct<time: array<string>, temperature_2m: array<double>, relative_humidity_2m: array<double>, wind_speed_10m: array<double>>"


def hourly_rows(responses: DataFrame, body: str = "body") -> DataFrame:
    """Rows of an hourly forecast from its parallel arrays; the other columns stay."""
    parsed = responses.withColumn("_h", F.from_json(body, HOURLY)["hourly"])
    zipped = F.arrays_zip("_h.time", "_h.temperature_2m", "_h.relative_humidity_2m", "_h.wind_speed_10m")
    each = parsed.withColumn("_z", F.explode(zipped)).drop(body, "_h")
    return each.select(
        *(c for c in each.columns if c != "_z"), F.col("_z.time").alias("datetime"), F.col("_z.temperature_2m").alias("temperature"),
        F.col("_z.relative_humidity_2m").alias("humidity"), F.col("_z.wind_speed_10m").alias("wind_speed"),
    )


def binding_rows(responses: DataFrame, variables: list[str], body: str = "body") -> DataFrame:
    """Rows of graph query results, a column for each variable; unbound ones are null."""
    inner = ", ".join(f"`{v}`: struct<value: string>" for v in variables)
    schema = f"results struct<bindings: array<struct<{inner}>>>"
    each = responses.select(F.explode(F.from_json(body, schema)["results"]["bindings"]).alias("b"))
    return each.select(*(F.col(f"b.`{v}`.value").alias(v) for v in variables))


def search_rows(responses: DataFrame, fields: list[str], body: str = "body") -> DataFrame:
    """Documents of a search response; of a field that is a list its first value."""
    docs = F.explode(F.from_json(F.get_json_object(body, "$.response.docs"), "array<map<string, string>>"))
    value = lambda v: F.coalesce(F.from_json(v, "array<string>")[0], v)
    first = lambda f: F.when(F.col("d")[f].startswith("["), value(F.col("d")[f])).otherwise(F.col("d")[f])
    return responses.select(docs.alias("d")).select(*(first(f).alias(f) for f in fields))
