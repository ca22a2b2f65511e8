"""Workbooks as a Spark data source: ``spark.read.format("workbook")`` after ``register(spark)``.

A sheet, or a range of its rows, is a partition; a task streams its part of the
sheet's XML and keeps no more of it than a row. Paths may be of any file system
that pyarrow opens; a path may be a folder, whose workbooks are all read.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from granary.sources.files import _cell_column


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


def workbooks(path: str) -> list[str]:
    """The workbook at path, or those in the folder, by name; open documents' lock files are left out."""
    fs, inner = _opened(path)
    if fs.get_file_info(inner).type != pafs.FileType.Directory:
        return [path]
    prefix = path.rstrip("/").removesuffix(inner.rstrip("/"))
    names = [f.path for f in fs.get_file_info(pafs.FileSelector(inner)) if f.base_name.lower().endswith(".xlsx") and not f.base_name.startswith("~")]
    return [f"{prefix}{n}" for n in sorted(names)]


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _elements(book: zipfile.ZipFile, part: str, name: str) -> Iterator[ElementTree.Element]:
    """The elements of a name, each given up again once it has been used."""
    with book.open(part) as data:
        path = []
        for event, e in ElementTree.iterparse(data, ("start", "end")):
            if event == "start":
                path.append(e)
                continue
            path.pop()
            if _tag(e) == name:
                yield e
                if path:
                    path[-1].remove(e)


class Workbook:
    """An open workbook: its sheets in their order, and a sheet's rows."""

    def __init__(self, path: str) -> None:
        fs, inner = _opened(path)
        self.book = zipfile.ZipFile(fs.open_input_file(inner))
        self.shared: list[str] | None = None

    def __enter__(self) -> Workbook:
        return self

    def __exit__(self, *_: object) -> None:
        self.book.close()

    def sheets(self) -> dict[str, str]:
        """The part that holds each named sheet."""
        links = {}
        if "xl/_rels/workbook.xml.rels" in self.book.namelist():
            root = ElementTree.fromstring(self.book.read("xl/_rels/workbook.xml.rels"))
            links = {e.get("Id"): e.get("Target", "") for e in root}
        out = {}
        for e in ElementTree.fromstring(self.book.read("xl/workbook.xml")).iter():
            if _tag(e) == "sheet":
                own = next((v for k, v in e.attrib.items() if k.endswith("}id")), None)
                target = links.get(own, f"worksheets/sheet{e.get('sheetId')}.xml")
                out[e.get("name", "")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        return out

    def height(self, part: str) -> int | None:
        """The last row's number, where the sheet says it before its data."""
        with self.book.open(part) as data:
            head = data.read(65536).decode("utf-8", "replace")
        found = re.search(r"<(?:\w+:)?dimension[^>]*ref=\"[A-Z]+\d+:[A-Z]+(\d+)\"", head)
        return int(found[1]) if found else None

    def _strings(self) -> list[str]:
        if self.shared is None:
            there = "xl/sharedStrings.xml" in self.book.namelist()
            own = _elements(self.book, "xl/sharedStrings.xml", "si") if there else ()
            self.shared = [_plain_text(e) for e in own]
        return self.shared

    def _value(self, cell: ElementTree.Element) -> str | None:
        kind = cell.get("t")
        if kind == "inlineStr":
            return _plain_text(cell) or None
        text = next((e.text for e in cell if _tag(e) == "v"), None)
        if not text or kind == "e":
            return None
        if kind == "s":
            return self._strings()[int(text)] or None
        return {"0": "false", "1": "true"}.get(text, text) if kind == "b" else text

    def rows(self, part: str, first: int = 1, last: int | None = None) -> Iterator[list[str | None]]:
        """Rows by their numbers; those in between that the sheet leaves out are left out."""
        number = 0
        for row in _elements(self.book, part, "row"):
            number = int(row.get("r") or number + 1)
            if number < first:
                continue
            if last is not None and number > last:
                return
            out: list[str | None] = []
            for cell in (c for c in row if _tag(c) == "c"):
                at = _cell_column(cell.get("r")) if cell.get("r") else len(out)
                out += [None] * (at + 1 - len(out))
                out[at] = self._value(cell)
            yield out


def _plain_text(element: ElementTree.Element) -> str:
    """Text of an item without its phonetic notes."""
    out, todo = [], [element]
    while todo:
        e = todo.pop()
        if _tag(e) == "t":
            out.append(e.text or "")
        elif _tag(e) != "rPh":
            todo += reversed(list(e))
    return "".join(out)


def column_names(header: list[str | None]) -> list[str]:
    """Trimmed names; ones that are missing are named by their place, ones that repeat, whatever their case, get a number."""
    out: list[str] = []
    seen: set[str] = set()
    for k, h in enumerate(header):
        plain = (h or "").strip() or f"column_{k + 1}"
        name, n = plain, 1
        while name.lower() in seen:
            n += 1
            name = f"{plain}_{n}"
        seen.add(name.lower())
        out.append(name)
    return out


@dataclass
class Part(InputPartition):
    path: str
    sheet: str
    first: int
    last: int | None


class WorkbookSource(DataSource):
    """Options: path; sheet, a name or "*" for all (the first one); header, "true" or "false"; rows, those of a partition.

    Columns are text, named by the header of the first workbook's sheet, or by a given schema, which may choose some.
    Rows without any value are left out; columns that a sheet lacks are null.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        for path in workbooks(self.options["path"]):
            with Workbook(path) as book:
                part = next(iter(_chosen(book, self.options.get("sheet")).values()))
                header = next(book.rows(part), [])
            names = column_names(header if _has_header(self.options) else [None] * len(header))
            return StructType([StructField(n, StringType()) for n in names])
        raise FileNotFoundError(f"no workbook in {self.options['path']}")

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(schema, dict(self.options))


def _has_header(options: dict[str, str]) -> bool:
    return options.get("header", "true").lower() != "false"


def _chosen(book: Workbook, sheet: str | None) -> dict[str, str]:
    every = book.sheets()
    if sheet == "*":
        return every
    name = next(iter(every), None) if sheet is None else sheet
    if name not in every:
        raise ValueError(f"no sheet {sheet!r}; there are {', '.join(every)}")
    return {name: every[name]}


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        if any(not isinstance(f.dataType, StringType) for f in schema):
            raise ValueError("columns of a workbook are text; cast them after reading")
        self.names, self.options = schema.names, options

    def partitions(self) -> list[Part]:
        out, size = [], int(self.options.get("rows", 50_000))
        for path in workbooks(self.options["path"]):
            with Workbook(path) as book:
                for sheet, part in _chosen(book, self.options.get("sheet")).items():
                    begin, height = 2 if _has_header(self.options) else 1, book.height(part)
                    starts = range(begin, max(height or 0, begin) + 1, size)
                    # The last range is open, as a sheet may hold more rows than it says.
                    out += [Part(path, sheet, s, s + size - 1 if s != starts[-1] else None) for s in starts]
        return out

    def read(self, partition: Part) -> Iterator[tuple]:
        with Workbook(partition.path) as book:
            part = book.sheets()[partition.sheet]
            header = next(book.rows(part), [])
            names = column_names(header if _has_header(self.options) else [None] * len(header))
            at = [names.index(n) if n in names else None for n in self.names]
            for row in book.rows(part, partition.first, partition.last):
                if any(v is not None for v in row):
                    yield tuple(row[k] if k is not None and k < len(row) else None for k in at)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)
