import math

import pytest
from pyspark.sql import functions as F

from granary.functions import identifiers, isbn, special, text


def values(spark, expression, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_isbn_checks(spark):
    assert values(spark, isbn.is_isbn10, ["0306406152", "0306406153", "080442957X", "X306406152", "", "123"]) == [True, False, True, False, False, False]
    assert values(spark, isbn.is_isbn13, ["9780306406157", "9780306406158", "979"]) == [True, False, False]


def test_isbn_modes(spark):
    raw = ["2-7283-0949-3 (br.)", "978-0-306-40615-7", "0306406153", "979-10-90636-07-1", None, "no number", "0-306-40615-2"]
    assert values(spark, isbn.normalize_isbn, raw) == ["9782728309498", "9780306406157", None, "9791090636071", None, None, "9780306406157"]
    assert values(spark, lambda c: isbn.normalize_isbn(c, "lenient"), ["0306406153", "123"]) == ["9780306406157", None]
    assert values(spark, lambda c: isbn.normalize_isbn(c, "strict"), ["2-7283-0949-3 1999"]) == [None]
    with pytest.raises(ValueError):
        isbn.normalize_isbn(F.lit("x"), "odd")


def test_isbn_round_trip(spark):
    assert values(spark, lambda c: isbn.isbn13_to_10(isbn.isbn10_to_13(c)), ["0306406152", "080442957X"]) == ["0306406152", "080442957X"]
    assert values(spark, isbn.isbn13_to_10, ["9791090636071"]) == [None]
    assert values(spark, isbn.search_forms, ["9780306406157", "9791090636071"]) == [["9780306406157", "0306406152"], ["9791090636071"]]


def test_identifiers(spark):
    assert values(spark, identifiers.normalize_ppn, ["12345678", "123456789.0", "02676336x", "nan", None]) == ["012345678", "123456789", "02676336X", None, None]
    assert values(spark, lambda c: identifiers.normalize_ppn(c, "exact"), ["1234567890", "12345678"]) == [None, "012345678"]
    assert values(spark, lambda c: identifiers.normalize_ppn(c, "search"), ["see 02676336X.", "12"]) == ["02676336X", None]
    assert values(spark, identifiers.normalize_gnd, ["https://d-nb.info/gnd/118540238", "(DE-588)118540238", "GND: 4-5", None]) == ["118540238", "118540238", "4-5", None]
    assert values(spark, identifiers.normalize_bnf, ["cb11907966z", "11907966.0"]) == ["11907966z", "11907966"]
    assert values(spark, identifiers.ark_of, ["http://x.org/ark:/12148/cb119#a", "none"]) == ["ark:/12148/cb119", None]
    assert values(spark, identifiers.last_segment, ["http://x.org/027/id", "x"]) == ["id", None]


def test_texts(spark):
    assert values(spark, text.fold, ["Œuvre d’Été À", " Größe\n", "e\u0301te\u0301 ø", "\u1e9b\u0323 Ǖ ά й"]) == ["oeuvre d'ete a", "große", "ete ø", "ſ u α и"]
    assert values(spark, text.first_year, ["[c1998], 2003", "12345", "cop. 2150", None]) == [2003, None, 2150, None]
    assert values(spark, text.trim_punctuation, ["Title /", "a ; ", "b"]) == ["Title", "a", "b"]
    assert values(spark, lambda c: text.merge_cells(c, F.lit("b | c")), ["a|b", None, " "]) == ["a | b | c", "b | c", "b | c"]
    assert values(spark, lambda c: text.contains_any(c, ["gy", "genève"], ("gy",)), ["à Gy.", "energy", "Genève"]) == [True, False, False]
    assert values(spark, lambda c: text.name_parts(c)[1], ["Doe, Jane, 1900", "Doe"]) == ["Jane", None]
    assert values(spark, lambda c: text.full_name(F.lit("Doe"), c), ["Jane", ""]) == ["Doe, Jane", "Doe"]
    assert values(spark, lambda c: text.to_number(c), ["1,5", "x", "2"]) == [1.5, None, 2.0]
    assert values(spark, lambda c: text.with_thousands(c.cast("double")), ["1234567.9"]) == ["1 234 567"]


def test_tails():
    assert special.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert special.chi_square_tail(9.487729036781154, 4) == pytest.approx(0.05)
    assert special.f_tail(4.964602743730711, 1, 10) == pytest.approx(0.05)
    assert special.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05)
    assert special.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert math.isclose(special.upper_gamma(0.5, 1e-9) + 2 * math.sqrt(1e-9 / math.pi), 1, rel_tol=1e-6)


def test_composed_names(spark):
    rows = [("Martin", "Anne", "A. B.", "II", "saint", "1900-1950"), (None, None, None, None, "saint", "1900"), (" ", "Anne", None, "", None, None), (None,) * 6]
    df = spark.createDataFrame(rows, "a string, b string, g string, d string, c string, f string")
    name = text.composed_name(F.col("a"), F.col("b"), expansion=F.col("g"), numeral=F.col("d"), qualifier=F.col("c"), dates=F.col("f"))
    assert [r[0] for r in df.select(name).collect()] == ["Martin, Anne A. B. II (saint) (1900-1950)", "saint (1900)", "Anne", None]
