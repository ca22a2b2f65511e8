import zipfile

import pytest
from pyspark.sql import functions as F

from granary.sources import remote, sinks, workbook

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def cells(row, number, shared):
    out = []
    for k, v in enumerate(row):
        at = f"{chr(65 + k)}{number}"
        if v is None:
            continue
        if isinstance(v, bool):
            out.append(f'<c r="{at}" t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, str):
            shared.append(v)
            out.append(f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>')
        else:
            out.append(f'<c r="{at}"><v>{v}</v></c>')
    return "".join(out)


def write_book(path, sheets, dimension=True):
    """A workbook whose sheets' parts are named out of order, as programs may do."""
    shared = []
    with zipfile.ZipFile(path, "w") as book:
        links, listed = "", ""
        for k, (name, rows) in enumerate(sheets.items()):
            part = f"worksheets/sheet{len(sheets) - k}.xml"
            data = "".join(f'<row r="{n}">{cells(r, n, shared)}</row>' for n, r in enumerate(rows, 1) if r is not None)
            size = f'<dimension ref="A1:{chr(64 + max(len(r or ()) for r in rows))}{len(rows)}"/>' if dimension and len(rows) > 1 else ""
            book.writestr(f"xl/{part}", f"<worksheet {MAIN}>{size}<sheetData>{data}</sheetData></worksheet>")
            links += f'<Relationship Id="r{k}" Target="{part}"/>'
            listed += f'<sheet name="{name}" sheetId="{k + 7}" r:id="r{k}"/>'
        book.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        items = "".join(f"<si><r><t>{s}</t></r><rPh><t>no</t></rPh></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{items}</sst>")


@pytest.fixture
def shop(spark, tmp_path):
    workbook.register(spark)
    web = [["sku", None, "Total", "total", "sku ", "shown"], ["13127-1", 5, 1.5, 2, None, True], [None, None, None, None, None, None], None, ["bon-cadeau", None, None, 7, "x", False]]
    write_book(tmp_path / "web.xlsx", {"sales": web, "other": [["sku"], ["a"], ["b"]]})
    return str(tmp_path / "web.xlsx")


def read(spark, path, **options):
    return spark.read.format("workbook").options(**options).load(path)


@pytest.mark.parametrize("rows", [1, 2, 100])
def test_clashing_and_missing_headers_whatever_the_ranges(spark, shop, rows):
    df = read(spark, shop, rows=rows)
    assert df.columns == ["sku", "column_2", "Total", "total_2", "sku_2", "shown"]
    assert sorted(map(tuple, df.collect())) == [("13127-1", "5", "1.5", "2", None, "true"), ("bon-cadeau", None, None, "7", "x", "false")]
    assert df.rdd.getNumPartitions() == {1: 4, 2: 2, 100: 1}[rows]


def test_sheets_schemas_and_folders(spark, shop, tmp_path):
    assert sorted(r[0] for r in read(spark, shop, sheet="other").collect()) == ["a", "b"]
    every = spark.read.format("workbook").schema("sku string, nothing string").option("sheet", "*").load(shop)
    assert sorted(r["sku"] for r in every.collect()) == ["13127-1", "a", "b", "bon-cadeau"] and every.filter("nothing IS NOT NULL").isEmpty()
    assert read(spark, shop, sheet="other", header="false").columns == ["column_1"] and read(spark, shop, sheet="other", header="false").count() == 3
    with pytest.raises(Exception, match="no sheet"):
        read(spark, shop, sheet="none").collect()
    write_book(tmp_path / "more.xlsx", {"s": [["sku"], *([f"m{k}"] for k in range(30))]}, dimension=False)
    (tmp_path / "~$web.xlsx").write_bytes(b"lock")
    both = spark.read.format("workbook").schema("sku string").option("rows", 7).load(f"file://{tmp_path}")
    assert both.count() == 32


def test_what_the_sink_writes_is_read(spark, tmp_path):
    workbook.register(spark)
    df = spark.range(100).select(F.col("id").cast("string").alias("product id"), F.concat(F.lit("é & <"), "id").alias("name"))
    sinks.write_xlsx(df, str(tmp_path / "b.xlsx"))
    got = read(spark, str(tmp_path / "b.xlsx"))
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def answer(total, start, size, bare=()):
    rows = "".join(f"<srw:record><srw:recordData><m>{k}</m></srw:recordData></srw:record>" for k in range(start, min(start + size, total + 1)) if k not in bare)
    return f'<srw:r xmlns:srw="s"><srw:numberOfRecords>{total}</srw:numberOfRecords>{rows}</srw:r>'


def test_pages_are_asked_for_in_two_phases(spark, tmp_path):
    totals = {"a": 23, "b": 10, "c": 0, "d": 11, "e": 21}

    def transport(request):
        key, start = request["query"], int(request["startRecord"])
        with open(tmp_path / "asked", "a") as f:
            f.write(f"{key} {start}\n")
        if key == "d" and start == 11 and (tmp_path / "asked").read_text().count("d 11\n") < 3:
            raise OSError("busy")  # mended by the second policy
        if key == "e" and start == 11:
            raise OSError("down")
        if key == "f":
            raise remote.NotThere
        return answer(totals[key], start, 10)

    keys = spark.createDataFrame([(k,) for k in "aabcdef"] + [(None,)], "k string")
    fast, slow = remote.Policy(retries=0, pause=0.0, tasks=4), remote.Policy(retries=2, pause=0.0, tasks=1)
    pages = remote.ask_for_pages(keys, "k", lambda r: {"query": r["k"], "startRecord": str(r["start"])}, transport, [fast, slow], size=10)
    got = {(r["k"], r["start"]): r["error"] is None for r in pages.collect()}
    assert got == {("a", 1): True, ("a", 11): True, ("a", 21): True, ("b", 1): True, ("c", 1): True, ("d", 1): True, ("d", 11): True, ("e", 1): True, ("e", 11): False, ("e", 21): True}
    asked = (tmp_path / "asked").read_text().split("\n")
    pages.count()
    assert (tmp_path / "asked").read_text().split("\n") == asked and asked.count("a 1") == 1 and asked.count("f 1") == 1
    rows = {r["k"]: r for r in remote.page_totals(pages, "k").collect()}
    assert {k: (r["n_records"], r["n_received"], r["n_failed"], r["complete"]) for k, r in rows.items()} == {
        "a": (23, 23, 0, True), "b": (10, 10, 0, True), "c": (0, 0, 0, True), "d": (11, 11, 0, True), "e": (21, 11, 1, False)
    }


def test_a_missing_record_gives_no_row(spark):
    def transport(request):
        if request["id"] == "404":
            raise remote.NotThere
        if request["id"] == "500":
            raise OSError("down")
        return f"<r>{request['id']}</r>"

    ids = spark.createDataFrame([("1",), ("404",), ("500",)], "id string")
    found = remote.ask_with_repair(ids, lambda r: {"id": r["id"]}, transport, [remote.Policy(retries=0, pause=0.0, tasks=2)])
    assert sorted(map(tuple, found.collect())) == [("1", "<r>1</r>", None), ("500", None, "OSError: down")]
