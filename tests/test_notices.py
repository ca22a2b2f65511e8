from granary.operators.notices import electronic_checks, media_checks, notice_fields, without_carrier

from tests.test_hybrid import field, record


def control(ppn, *fields):
    return f'<record><controlfield tag="001">{ppn}</controlfield>{"".join(fields)}</record>'


def test_fields_of_notices(spark):
    number = field("010", ("a", "2-07-036002-4 (br.)"), ("a", "2070360024"))
    rows = [
        (1, control("123", number, field("200", ("a", "Un titre /"), ("a", "Un titre"), ("e", "suite :"), ("e", "fin")), field("701", ("b", "Anne")), field("210", ("a", "Nice"), ("c", "A ;"), ("c", "B"), ("d", "[198-]"), ("d", "1987")))),
        (2, control("124", field("010", ("a", "123")), field("200", ("a", "x")))),
        (3, control("125", number, field("200", ("e", "only other")), field("700", ("a", "One"), ("b", "A")), field("701", ("a", "Two")), field("214", ("d", "1990")), field("210", ("a", "Nice")))),
        (4, None), (5, "no xml"), (6, control("126", number)),
    ]
    got = {r["id"]: r.asDict() for r in notice_fields(spark.createDataFrame(rows, "id int, xml string"), "xml").drop("xml").collect()}
    assert got[1] == {"id": 1, "ppn": "123", "numbers": ["9782070360024"], "title": "Un titre : suite ; fin", "year": 1987, "creator": "Anne", "place": "Nice", "publisher": "A - B"}
    assert got[2]["numbers"] == [] and got[2]["title"] is None and got[2]["ppn"] == "124"
    assert (got[3]["title"], got[3]["creator"], got[3]["place"], got[3]["year"]) == ("only other", "One, A", None, 1990)
    assert got[4]["ppn"] is None and not got[4]["numbers"] and not got[5]["numbers"]
    assert got[6] == {"id": 6, "ppn": "126", "numbers": ["9782070360024"], "title": None, "year": None, "creator": None, "place": None, "publisher": None}


def answer(*records):
    return '<s:r xmlns:s="a" xmlns:m="b" xmlns:d="c"><s:records>' + "".join(f"<s:record>{r}</s:record>" for r in records) + "</s:records></s:r>"


def marc(ark, *codes):
    inner = "".join(f'<m:datafield tag="182"><m:subfield code="c">{c}</m:subfield></m:datafield>' for c in codes)
    return f'<s:recordData><m:record id="{ark}"><m:leader>x</m:leader>{inner}</m:record></s:recordData><s:recordIdentifier>{ark}</s:recordIdentifier>'


def test_media_checks_keep_what_cannot_be_checked(spark):
    bare = "<s:recordData><d:diagnostic><d:uri>u</d:uri></d:diagnostic></s:recordData><s:recordIdentifier>ark:/12148/cb3#x</s:recordIdentifier>"
    pages = [(answer(marc("ark:/12148/cb1", "n", " C"), marc("cb2", "n"), bare),), (answer(marc("cb2", "c")),), (answer(),), (None,), ("none",)]
    checks = media_checks(spark.createDataFrame(pages, "body string"), "body")
    assert sorted(map(tuple, checks.collect())) == [("cb1", True, False), ("cb2", True, False), ("cb3", False, True)]
    notices = spark.createDataFrame([("cb1",), ("cb3",), ("cb9",), (None,)], "ark string")
    assert sorted(map(str, (r[0] for r in without_carrier(notices, checks, "ark", "id", "computer").collect()))) == ["None", "cb3", "cb9"]


def test_electronic_checks(spark):
    rows = [(record(field("003@", ("0", "12345678x")), field("012V", ("c", "nc")), field("012V", ("c", " CEB "))),), (record(field("003@", ("0", "5")), field("012V", ("a", "ceb"))),), (record(field("012V", ("c", "ceb"))),), (None,)]
    assert sorted(map(tuple, electronic_checks(spark.createDataFrame(rows, "xml string"), "xml").collect())) == [("000000005", False), ("12345678X", True)]
