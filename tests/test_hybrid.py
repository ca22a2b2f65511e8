import pytest
from pyspark.sql import functions as F

from granary.operators.hybrid import computed, hybrid_documents, indexed_values, tag_index, text_year
from granary.sources.records import parsed_records


def field(tag, *subfields):
    return f'<datafield tag="{tag}">' + "".join(f'<subfield code="{c}">{v}</subfield>' for c, v in subfields) + "</datafield>"


def record(*fields):
    return f"<record>{''.join(fields)}</record>"


GOOD = field("010", ("a", "978-2-07-036002-4"))


def documents(spark, *rows, terms=("nice", "menton")):
    df = spark.createDataFrame(rows, "id int, xml string, year int")
    return hybrid_documents(df, "xml", list(terms), "year").orderBy("id", "isbn").collect()


def test_index_of_a_record(spark):
    xml = record(field("200", ("a", " one "), ("a", "two"), ("e", " ")), field("700", ("a", "x")), field("200", ("a", "three")), "<datafield tag='300'/>")
    df = computed(parsed_records(spark.createDataFrame([(xml,)], "x string"), "x"), index=tag_index())
    assert df.select("index").first()[0] == {"200": {"a": ["one", "two", "three"]}, "700": {"a": ["x"]}}
    assert df.select(indexed_values(["700", "200", "9"], ["e", "a"])).first()[0] == ["x", "one", "two", "three"]


def test_fields_reasons_and_years(spark):
    xml = record(
        GOOD, field("010", ("a", "2070360024")), field("010", ("a", "2070360025")), field("200", ("a", "La vie à Nice"), ("e", "essai")),
        field("701", ("a", "Martin"), ("b", "Anne"), ("3", "PPN 02763852x.")), field("712", ("c", "Lyon"), ("a", "Atelier"), ("b", "Nord"), ("3", "1234")),
        field("210", ("a", "Paris"), ("c", "B"), ("d", "[19999]")), field("214", ("c", "A"), ("d", "cop. 1987, 1990")), field("610", ("a", "MENTON"), ("3", "nice")),
    )
    one, two = documents(spark, (1, xml, None), (2, xml, 2001))
    assert one.asDict() == {
        "id": 1, "creator_ids": "02763852X", "isbn": "9782070360024", "title": "La vie à Nice | essai", "creators": "Atelier Nord Lyon | Martin Anne",
        "publisher": "A | B", "year": 1987, "subjects": "MENTON", "places": "Paris", "reasons": "title | subject",
    }
    assert two["year"] == 2001


@pytest.mark.parametrize(
    "xml",
    [
        None, "", "no xml", record(), record(GOOD), record(GOOD, field("200", ("a", "nicely"))), record(field("200", ("a", "Nice"))),
        record(field("010", ("a", "123")), field("200", ("a", "Nice"))), record(GOOD, field("200", ("a", "Nice")), field("338", ("b", " Cr "))),
        record(GOOD, field("610", ("3", "nice"))), record(GOOD, field("700", ("a", "nice"))),
    ],
)
def test_records_left_out(spark, xml):
    assert documents(spark, (1, xml, 2000)) == []


def test_other_numbers_each_have_a_row_and_empty_cells_stay_empty(spark):
    xml = record(GOOD, field("010", ("a", "2253004227")), field("214", ("a", "Nice")))
    rows = documents(spark, (1, xml, None))
    assert [r["isbn"] for r in rows] == ["9782070360024", "9782253004226"]
    assert (rows[0]["title"], rows[0]["year"], rows[0]["reasons"]) == ("", None, "place_of_publication")


def test_years_in_texts(spark):
    df = spark.createDataFrame([(["x", "a1987b", "1990"],), (["12345", "2100"],), ([],)], "d array<string>")
    assert [r[0] for r in df.select(text_year(F.col("d"))).collect()] == [1987, None, None]
