"""Identifiers, texts and records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from granary.functions import identifiers, isbn, text
from granary.functions.once import computed, once
from granary.operators.hybrid import hybrid_documents
from granary.plans.catalog import dealt, query, table
from granary.sources.records import envelope, field_values, local_works, parsed_records

_BODY = "lpad(p_partkey::VARCHAR, 9, '0')"
_SUM10 = " + ".join(f"CAST(substr(b, {i + 1}, 1) AS INT) * {10 - i}" for i in range(9))
_SUM13 = " + ".join(f"CAST(substr('978' || b, {i + 1}, 1) AS INT) * {1 + 2 * (i % 2)}" for i in range(12))
_NUMBERS = f"""(SELECT p_partkey, b, CASE (11 - ({_SUM10}) % 11) % 11 WHEN 10 THEN 'X' ELSE CAST((11 - ({_SUM10}) % 11) % 11 AS VARCHAR) END AS c10,
    CAST((10 - ({_SUM13}) % 10) % 10 AS VARCHAR) AS c13 FROM (SELECT p_partkey, {_BODY} AS b FROM part))"""


def _ten(spark, sf_dir):
    """Parts with an ISBN made of their key; every seventh has a wrong check."""
    nine = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    weighted = F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(0), lambda s, i: s + F.substr(nine, i, F.lit(1)).cast("int") * (11 - i))
    shifted = once((11 - weighted % 11) % 11, lambda check: F.when(F.col("p_partkey") % 7 == 0, (check + 1) % 11).otherwise(check))
    made = once(shifted, lambda k: F.concat(nine, F.when(k == 10, "X").otherwise(k.cast("string"))))
    return dealt(spark, sf_dir, "part").select("p_partkey", made.alias("code"))


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN '978' || b || c13 END AS isbn FROM {_NUMBERS}")
def isbn_normalise(spark, sf_dir):
    raw = F.concat(F.left("code", F.lit(1)), F.lit("-"), F.substring("code", 2, 20), F.lit(" (br.)"))
    return _ten(spark, sf_dir).select("p_partkey", isbn.normalize_isbn(raw).alias("isbn"))


@query(f"SELECT p_partkey, b || c10 AS isbn10 FROM {_NUMBERS} WHERE p_partkey % 7 <> 0")
def isbn13_to_10(spark, sf_dir):
    code = isbn.isbn10_to_13(F.col("code"))
    return computed(_ten(spark, sf_dir), isbn10=isbn.isbn13_to_10(code)).filter("isbn10 IS NOT NULL").select("p_partkey", "isbn10")


@query("SELECT count(*) AS n, count(*) FILTER (p_partkey % 7 = 0) AS n_invalid FROM part")
def isbn_invalid_rate(spark, sf_dir):
    return _ten(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(~isbn.is_isbn10(F.col("code"))).alias("n_invalid"))


@query("SELECT p_partkey, lpad((p_partkey * 37)::VARCHAR, 9, '0') AS ppn FROM part")
def ppn_normalise(spark, sf_dir):
    raw = F.concat((F.col("p_partkey") * 37).cast("string"), F.lit(".0"))
    return table(spark, sf_dir, "part").select("p_partkey", identifiers.normalize_ppn(raw).alias("ppn"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN (p_partkey + 118500000)::VARCHAR END AS gnd FROM part")
def gnd_normalise(spark, sf_dir):
    number = (F.col("p_partkey") + 118500000).cast("string")
    raw = (
        F.when(F.col("p_partkey") % 5 == 0, F.lit("NaN"))
        .when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("https://d-nb.info/gnd/"), number))
        .when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("(DE-588)"), number))
        .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit(" gnd:"), number))
        .otherwise(number)
    )
    return table(spark, sf_dir, "part").select("p_partkey", identifiers.normalize_gnd(raw).alias("gnd"))


@query("SELECT o_orderkey, year(o_orderdate) AS year FROM orders")
def year_extract(spark, sf_dir):
    raw = F.concat(F.lit("[c"), F.date_format("o_orderdate", "yyyy"), F.lit("], 30"))
    years = F.concat(F.lit("cop. "), F.date_format("o_orderdate", "yyyy"), F.lit(" | 2150"))
    both = F.when(F.col("o_orderkey") % 2 == 0, raw.substr(3, 20)).otherwise(years)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.first_year(both).cast("long").alias("year"))


_FOLDED = """strip_accents(replace(replace(replace(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'œ', 'oe'), 'æ', 'ae'), '’', chr(39)))"""


@query(f"SELECT doc_id, {_FOLDED} AS folded FROM documents")
def text_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@query("SELECT p_partkey, p_name || CASE p_partkey % 3 WHEN 0 THEN '' ELSE ' x' END AS title FROM part")
def isbd_clean(spark, sf_dir):
    raw = F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, " /").when(F.col("p_partkey") % 3 == 1, " x ;").otherwise(" x"))
    return table(spark, sf_dir, "part").select("p_partkey", text.trim_punctuation(raw).alias("title"))


_TERMS = ["heon", "erst", "gy"]


@query("SELECT doc_id FROM documents WHERE " + " OR ".join(f"contains({_FOLDED}, '{t}')" for t in _TERMS))
def keyword_detect_substring(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(text.contains_any(F.col("text"), _TERMS)).select("doc_id")


@query(
    "SELECT doc_id FROM documents WHERE "
    + " OR ".join(f"regexp_matches({_FOLDED}, '(^|[^a-z]){t}([^a-z]|$)')" for t in _TERMS)
)
def keyword_detect_bounded(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(text.contains_any(F.col("text"), _TERMS, True)).select("doc_id")


@query("SELECT source, string_agg(DISTINCT lang, ' | ' ORDER BY lang) AS langs FROM documents GROUP BY 1")
def concat_reasons_sorted(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(text.sorted_distinct(F.col("lang")).alias("langs"))


@query(
    """SELECT p_partkey, p_brand AS value FROM part UNION ALL SELECT p_partkey, p_type FROM part"""
)
def explode_pipe_list(spark, sf_dir):
    cell = F.concat("p_brand", F.lit(" |"), "p_type", F.lit("| | "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(text.split_cell(cell)).alias("value"))


@query("SELECT p_partkey, p_brand || ' | ' || p_type || ' | ' || p_name AS cell FROM part")
def merge_pipe_lists(spark, sf_dir):
    merged = text.merge_cells(F.concat("p_brand", F.lit(" | "), "p_type"), F.concat("p_type", F.lit("|"), "p_name"), F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", merged.alias("cell"))


@query("SELECT p_partkey, p_name AS title, p_brand || ', ' || p_type AS author, p_size::VARCHAR AS isbn FROM part WHERE p_size % 2 = 0")
def xml_field_extract(spark, sf_dir):
    def datafield(tag: str, **codes: Column | str) -> list[Column]:
        inner = [F.concat(F.lit(f'<subfield code="{k}">'), v, F.lit("</subfield>")) for k, v in codes.items()]
        return [F.lit(f'<datafield tag="{tag}">'), *inner, F.lit("</datafield>")]

    carrier = F.when(F.col("p_size") % 2 == 0, "nc").otherwise(" CR ")
    parts = [
        F.lit('<record><controlfield tag="001">'), F.col("p_partkey").cast("string"), F.lit("</controlfield>"),
        *datafield("020", a=F.col("p_size").cast("string")), *datafield("100", a=F.concat("p_brand", F.lit(", "), "p_type")),
        *datafield("245", a=F.concat("p_name", F.lit(" /"))), *datafield("338", b=carrier), F.lit("</record>"),
    ]
    raw = dealt(spark, sf_dir, "part").select("p_partkey", F.concat(*parts).alias("xml"))
    fields = parsed_records(raw, "xml")
    electronic = F.exists(field_values("338", "b"), lambda x: F.lower(F.trim(x)) == "cr")
    return fields.filter(~electronic).select(
        "p_partkey",
        text.trim_punctuation(F.get(field_values("245", "a"), F.lit(0))).alias("title"),
        F.get(field_values("100", "a"), F.lit(0)).alias("author"),
        F.explode(field_values("020", "a")).alias("isbn"),
    )


@query(r"""SELECT p_partkey, '\(' || p_name || '\) \\' || p_brand || '\?' AS term, p_brand || '\"' || p_name AS literal FROM part""")
def escaped_terms(spark, sf_dir):
    term = F.concat(F.lit("("), "p_name", F.lit(") \\"), "p_brand", F.lit("?"))
    literal = F.concat("p_brand", F.lit('"'), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", text.escaped_term(term).alias("term"), text.escaped_literal(literal).alias("literal"))


# Summer time: from the last Sunday of March to that of October, at 1 o'clock universal time.
_SUMMER = """ts >= make_date(year(ts), 3, 31) - CAST(dayofweek(make_date(year(ts), 3, 31)) AS INTEGER) + INTERVAL 1 HOUR
    AND ts < make_date(year(ts), 10, 31) - CAST(dayofweek(make_date(year(ts), 10, 31)) AS INTEGER) + INTERVAL 1 HOUR"""


@query(
    f"""SELECT event_id, CASE WHEN {_SUMMER} THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00'
    ELSE strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || '+01:00' END AS local FROM
    (SELECT event_id, ts + INTERVAL 1 HOUR * (event_id % 9000) AS ts FROM events)"""
)
def local_times(spark, sf_dir):
    later = F.expr("ts + make_interval(0, 0, 0, 0, cast(event_id % 9000 as int), 0, 0)")
    return table(spark, sf_dir, "events").select("event_id", text.local_iso_time(later).alias("local"))


@query(
    """SELECT p_partkey, p_partkey::VARCHAR AS id, p_name AS title, p_brand AS place, p_type AS subject,
    array_to_string(list_filter([CASE WHEN contains(lower(p_name), 'a') THEN 'title' END, CASE WHEN contains(lower(p_brand), '#1')
    THEN 'place_of_publication' END, CASE WHEN contains(lower(p_type), 'promo') THEN 'subject' END], lambda x: x IS NOT NULL), ' | ') AS reasons
    FROM part WHERE contains(lower(p_name), 'a') OR contains(lower(p_brand), '#1') OR contains(lower(p_type), 'promo')"""
)
def local_records(spark, sf_dir):
    def field(tag: str, *subfields: tuple[str, Column | str]) -> list[Column]:
        inner = [F.concat(F.lit(f'<subfield code="{k}">'), v, F.lit("</subfield>")) for k, v in subfields]
        return [F.lit(f'<datafield tag="{tag}">'), *inner, F.lit("</datafield>")]

    parts = [
        F.lit('<record><controlfield tag="001">'), F.col("p_partkey").cast("string"), F.lit("</controlfield>"),
        *field("010", ("a", F.lit("978-2"))), *field("200", ("a", F.col("p_name"))), *field("214", ("a", F.col("p_brand"))),
        *field("606", ("3", F.lit("promo a #1")), ("a", F.col("p_type")), ("2", F.lit("rameau"))), F.lit("</record>"),
    ]
    raw = dealt(spark, sf_dir, "part").select("p_partkey", F.concat(*parts).alias("xml"))
    found = local_works(parsed_records(raw, "xml"), {"title": ["a"], "place_of_publication": ["#1"], "subject": ["promo"]})
    joined = lambda c: F.array_join(c, " | ")
    return found.select(
        "p_partkey", "id", joined("titles").alias("title"), joined("places").alias("place"),
        joined("subjects").alias("subject"), joined("reasons").alias("reasons"),
    )


@query(
    """SELECT p_partkey // 50 AS answer, count(*) AS n_records, count(*) FILTER (p_partkey % 5 = 0) AS n_unchecked,
    string_agg(p_partkey::VARCHAR, ' | ' ORDER BY p_partkey) AS ids FROM part GROUP BY 1"""
)
def search_envelopes(spark, sf_dir):
    data = F.when(F.col("p_partkey") % 5 == 0, F.lit("<diag:diagnostic><uri>1/131</uri></diag:diagnostic>")).otherwise(
        F.lit('<mxc:record><mxc:controlfield tag="001">1</mxc:controlfield></mxc:record>')
    )
    record = F.concat(
        F.lit("<srw:record><srw:recordData>"), data, F.lit("</srw:recordData><srw:recordIdentifier> "),
        F.col("p_partkey").cast("string"), F.lit(" </srw:recordIdentifier></srw:record>"),
    )
    page = F.floor(F.col("p_partkey") / 50).alias("answer")  # of at most 50 records
    pages = table(spark, sf_dir, "part").groupBy(page).agg(F.count("*").alias("n"), F.collect_list(record).alias("r"))
    names = 'xmlns:srw="http://www.loc.gov/zing/srw/" xmlns:mxc="info:x" xmlns:diag="info:d"'
    xml = F.concat(
        F.lit(f"<srw:searchRetrieveResponse {names}><srw:numberOfRecords>"), F.col("n").cast("string"),
        F.lit("</srw:numberOfRecords><srw:records>"), F.array_join("r", ""), F.lit("</srw:records></srw:searchRetrieveResponse>"),
    )
    found = envelope(pages.select("answer", xml.alias("xml")), "xml")
    ids = F.array_join(F.transform(F.array_sort(F.transform("ids", lambda x: x.cast("long"))), lambda x: x.cast("string")), " | ")
    return found.select("answer", "n_records", F.size("unchecked").cast("long").alias("n_unchecked"), ids.alias("ids"))


_OTHER13 = " + ".join(f"CAST(substr('978' || lpad((p_partkey + 500000)::VARCHAR, 9, '0'), {i + 1}, 1) AS INT) * {1 + 2 * (i % 2)}" for i in range(12))


@query(
    f"""WITH n AS (SELECT p.*, '978' || b || c13 AS first, '978' || lpad((p.p_partkey + 500000)::VARCHAR, 9, '0') || ((10 - ({_OTHER13.replace("p_partkey", "p.p_partkey")}) % 10) % 10) AS second
        FROM {_NUMBERS} JOIN part p USING (p_partkey)),
    r AS (SELECT *, list_filter([CASE WHEN regexp_matches(p_name, '(^| )(red|hot|promo|large)( |$)') THEN 'title' END,
        CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'subject' END, CASE WHEN p_partkey % 11 = 0 THEN 'place_of_publication' END], lambda x: x IS NOT NULL) AS why FROM n)
    SELECT p_partkey, lpad(p_partkey::VARCHAR, 8, '0') || 'X' AS creator_ids,
        unnest(CASE WHEN p_partkey % 4 = 0 THEN [first, second] ELSE [first] END) AS isbn,
        array_to_string(list_sort([p_name, p_brand]), ' | ') AS title, 'Atelier Lyon' || ' | ' || p_brand || ' Ana' AS creators, p_type || ' press' AS publisher,
        CASE WHEN p_partkey % 2 = 0 THEN 1900 + p_size WHEN p_partkey % 5 <> 0 THEN 1950 + p_size END AS year,
        array_to_string(list_sort([p_type, 'x']), ' | ') AS subjects, CASE WHEN p_partkey % 11 = 0 THEN 'hot' ELSE 'hotel' END AS places, array_to_string(why, ' | ') AS reasons
    FROM r WHERE len(why) > 0 AND p_partkey % 7 <> 0"""
)
def hybrid_record_index(spark, sf_dir):
    """Records of all parts: some online, with numbers that fail their check, repeated, or written with hyphens."""
    def field(tag: str, *subfields: tuple[str, Column | str]) -> list[Column]:
        inner = [F.concat(F.lit(f'<subfield code="{k}">'), v if isinstance(v, Column) else F.lit(v), F.lit("</subfield>")) for k, v in subfields]
        return [F.lit(f'<datafield tag="{tag}">'), *inner, F.lit("</datafield>")]

    c, key = F.col, F.col("p_partkey")
    number = isbn.isbn13_from_nine(F.lpad(key.cast("string"), 9, "0"))
    other = F.when(key % 4 == 0, isbn.isbn13_from_nine(F.lpad((key + 500000).cast("string"), 9, "0"))).otherwise(number)
    date = F.when(key % 5 == 0, F.lit("[s. d.] 19500")).otherwise(F.concat(F.lit("impr. "), (c("p_size") + 1950).cast("string")))
    parts = [
        F.lit("<record>"), *field("010", ("a", F.concat(F.lit("ISBN "), other))), *field("010", ("a", "9780000000001"), ("a", F.concat(F.left(number, F.lit(3)), F.lit("-"), F.substring(number, 4, 10)))),
        *field("200", ("a", c("p_name")), ("e", F.concat(F.lit(" "), c("p_brand"))), ("f", "red hot")), *field("214", ("a", F.when(key % 11 == 0, "hot").otherwise("hotel")), ("c", F.concat("p_type", F.lit(" press"))), ("d", "s. d."), ("d", date)),
        *field("606", ("a", c("p_type")), ("x", "x"), ("2", "promo"), ("3", "large")), *field("338", ("b", F.when(key % 7 == 0, " CR ").otherwise("nc"))),
        *field("700", ("b", "Ana"), ("a", c("p_brand")), ("3", F.concat(F.lpad(key.cast("string"), 8, "0"), F.lit("x")))), *field("711", ("c", "Lyon"), ("a", "Atelier"), ("3", "none")), F.lit("</record>"),
    ]
    year = F.when(key % 2 == 0, c("p_size") + 1900)
    raw = dealt(spark, sf_dir, "part").select("p_partkey", F.concat(*parts).alias("xml"), year.alias("known"))
    return hybrid_documents(raw, "xml", ["red", "hot", "promo", "large"], "known")
