"""Identifiers in all their modes, filters on graph statements, JSON answers and annotated snapshots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions import identifiers, isbn, text
from granary.operators.notices import electronic_checks, media_checks, notice_fields, without_carrier
from granary.operators.snapshots import indicators, refreshed
from granary.operators.windows import in_lots_of
from granary.plans.catalog import dealt, query, table
from granary.plans.texts import _NUMBERS, _ten
from granary.sources.files import binding_rows, hourly_rows, search_rows


@query("SELECT p_partkey, p_type, p_size FROM part")
def dropped_columns(spark, sf_dir):
    return table(spark, sf_dir, "part").drop("p_name", "p_brand", "p_retailprice", "never_there")


@query(
    f"""SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN '978' || b || c13 END AS strict, '978' || b || c13 AS lenient,
    CASE WHEN p_partkey % 7 <> 0 THEN '978' || b || c13 || ' | ' || b || c10 ELSE '' END AS forms FROM {_NUMBERS}"""
)
def isbn_modes(spark, sf_dir):
    raw = F.concat(F.lit(" "), F.left("code", F.lit(4)), F.lit("-"), F.substring("code", 5, 20))
    strict = isbn.normalize_isbn(raw, "strict")
    forms = F.array_join(F.coalesce(isbn.search_forms(strict), F.array()), " | ")
    return _ten(spark, sf_dir).select("p_partkey", strict.alias("strict"), isbn.normalize_isbn(raw, "lenient").alias("lenient"), forms.alias("forms"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 3 <> 1 THEN lpad(p_partkey::VARCHAR, 8, '0') || 'X' END AS exact,
    CASE WHEN p_partkey % 3 <> 1 THEN lpad(p_partkey::VARCHAR, 8, '0') || 'X' ELSE '12345678' || p_partkey % 10 END AS search,
    p_partkey || 'k' AS bnf, 'ark:/12148/cb' || p_partkey AS ark, p_partkey::VARCHAR AS last FROM part"""
)
def identifier_modes(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    number = F.concat(F.lpad(key, 8, "0"), F.lit("x"))
    raw = F.when(F.col("p_partkey") % 3 == 0, number).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("no 1 of 12345678"), F.col("p_partkey") % 10, F.lit(", 2"))).otherwise(F.concat(F.lit(" "), number))
    link = F.concat(F.lit("http://data.example.org/ark:/12148/cb"), key, F.lit("#about"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", identifiers.normalize_ppn(raw, "exact").alias("exact"), identifiers.normalize_ppn(raw, "search").alias("search"),
        identifiers.normalize_bnf(F.concat(F.lit("cb"), key, F.lit("k"))).alias("bnf"), identifiers.ark_of(link).alias("ark"),
        identifiers.last_segment(F.concat(F.lit("http://data.example.org/gnd/"), key, F.lit("#about"))).alias("last"),
    )


@query(
    """SELECT p_partkey, p_name AS label, p_brand AS place FROM part WHERE p_partkey % 2 = 0 AND regexp_matches(lower(p_brand), '(^|[^a-z])brand#1([^0-9]|$)|#2[0-9]$') AND p_partkey % 3 <> 0"""
)
def graph_filters(spark, sf_dir):
    """Statements (document, property, value, whether it is a literal, its language): documents of one catalogue, by a pattern
    in one literal, with the French one of their labels."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    base = F.when(key % 2 == 0, "http://www.one.example/").otherwise("http://www.two.example/")
    said = lambda p, value, literal, lang: F.struct(F.lit(p).alias("p"), value.alias("o"), literal.alias("literal"), F.lit(lang).alias("lang"))
    yes = F.lit(True)
    each = F.explode(
        F.array(said("label", F.upper("p_name"), yes, "en"), said("label", F.col("p_name"), yes, "fr"), said("place", F.col("p_brand"), key % 3 != 0, None))
    )
    triples = part.select("p_partkey", F.concat(base, key).alias("s"), each.alias("t")).select("p_partkey", "s", "t.*")
    own = triples.filter(F.col("s").startswith("http://www.one.example/"))
    places = own.filter((F.col("p") == "place") & F.col("literal") & F.col("o").rlike(r"(?i)(^|[^A-Za-zÀ-ÿ])brand#1([^0-9]|$)|#2[0-9]$"))
    labels = own.filter((F.col("p") == "label") & (F.col("lang") == "fr"))
    return places.select("p_partkey", F.col("o").alias("place")).join(labels.select("p_partkey", F.col("o").alias("label")), "p_partkey")


@query(
    """SELECT n_nationkey::VARCHAR AS nation, CASE WHEN n_nationkey % 3 <> 0 THEN n_name END AS name, n_name AS first_title, NULL::VARCHAR AS missing FROM nation"""
)
def json_answers(spark, sf_dir):
    """Bindings of a graph's answer, with unbound variables, joined to a search's documents whose fields are lists or single values."""
    nations = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("string")
    value = lambda c: F.struct(F.lit("literal").alias("type"), c.alias("value"))
    binding = F.to_json(F.struct(value(key).alias("nation"), F.when(F.col("n_nationkey") % 3 != 0, value(F.col("n_name"))).alias("name")))
    graph = nations.groupBy("n_regionkey").agg(F.concat(F.lit('{"results": {"bindings": ['), F.array_join(F.collect_list(binding), ","), F.lit("]}}")).alias("body"))
    title = F.when(F.col("n_nationkey") % 2 == 0, F.to_json(F.array("n_name", F.lit("other")))).otherwise(F.concat(F.lit('"'), "n_name", F.lit('"')))
    doc = F.concat(F.lit('{"id": "'), key, F.lit('", "title": '), title, F.lit("}"))
    found = nations.groupBy("n_regionkey").agg(F.concat(F.lit('{"response": {"docs": ['), F.array_join(F.collect_list(doc), ","), F.lit("]}}")).alias("body"))
    rows, docs = binding_rows(graph, ["nation", "name", "missing"]), search_rows(found, ["id", "title"])
    return rows.join(docs, rows.nation == docs.id).select("nation", "name", F.col("title").alias("first_title"), "missing")


@query("SELECT user_id::VARCHAR AS station, strftime(ts, '%Y-%m-%dT%H:%M') AS datetime, max(value) AS temperature, count(*)::DOUBLE AS humidity, min(value) AS wind_speed FROM events WHERE user_id % 20 = event_id % 20 GROUP BY 1, 2")
def hourly_arrays(spark, sf_dir):
    """Forecasts of parallel arrays, one answer for each station."""
    events = table(spark, sf_dir, "events").filter("user_id % 20 = event_id % 20")
    hours = events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("t")).agg(F.max("value").alias("a"), F.count("*").alias("b"), F.min("value").alias("c"))
    arrays = hours.groupBy(F.col("user_id").cast("string").alias("station")).agg(F.sort_array(F.collect_list(F.struct("t", "a", "b", "c"))).alias("h"))
    body = F.to_json(F.struct(F.struct(F.col("h.t").alias("time"), F.col("h.a").alias("temperature_2m"), F.col("h.b").alias("relative_humidity_2m"), F.col("h.c").alias("wind_speed_10m")).alias("hourly")))
    return hourly_rows(arrays.select("station", body.alias("body")))


_OLD = "(SELECT o_orderkey AS id, o_orderdate AS changed, 'note ' || o_orderkey AS note FROM orders WHERE o_orderkey % 10 < 8)"
_STATUS = f"""(SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS changed,
    CASE WHEN o_orderkey % 6 = 0 THEN 'own' ELSE p.note END AS note, CASE WHEN p.id IS NULL THEN 'new' WHEN o_orderkey % 4 = 0 THEN 'modified' ELSE 'unchanged' END AS status,
    o_orderstatus = 'F' AS a, o_orderpriority LIKE '1%' AS b FROM orders LEFT JOIN {_OLD} p ON p.id = o_orderkey WHERE o_orderkey % 10 > 2)"""


def _refreshed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    both = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("changed"), "o_orderstatus", "o_orderpriority")
    old = both.filter("id % 10 < 8").select("id", "changed", F.concat(F.lit("note "), "id").alias("note"))
    later = F.when(F.col("id") % 4 == 0, F.col("changed") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("changed"))
    new = both.filter("id % 10 > 2").withColumns({"changed": later, "note": F.when(F.col("id") % 6 == 0, "own").otherwise(" ")})
    places = {"here": F.when(F.col("o_orderstatus") == "F", "x"), "there": F.when(F.col("o_orderpriority").startswith("1"), "y").otherwise("")}
    return refreshed(old, new.withColumns(places), "id", "changed", ["note"])


@query(f"SELECT id, note, status FROM {_STATUS}")
def carried_annotations(spark, sf_dir):
    return _refreshed(spark, sf_dir).select("id", F.when(F.trim("note") != "", F.col("note")).alias("note"), "status")


@query(f"SELECT count(*) AS n_rows, count(*) FILTER (status = 'new') AS n_new, count(*) FILTER (status = 'modified') AS n_modified, max(changed) AS latest, count(*) FILTER (a <> b) AS n_apart FROM {_STATUS}")
def snapshot_indicators(spark, sf_dir):
    return indicators(_refreshed(spark, sf_dir), "changed", "here", "there")


def _field(tag: str, *subfields: tuple[str, Column | str]) -> list[Column]:
    inner = [F.concat(F.lit(f'<subfield code="{k}">'), v if isinstance(v, Column) else F.lit(v), F.lit("</subfield>")) for k, v in subfields]
    return [F.lit(f'<datafield tag="{tag}">'), *inner, F.lit("</datafield>")]


@query(
    f"""SELECT p_partkey, p_partkey::VARCHAR AS ppn, CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN '978' || b || c13 || ' | 9780306406157' ELSE '978' || b || c13 END AS numbers,
    CASE WHEN p_partkey % 7 <> 0 THEN p_name || CASE WHEN p_partkey % 2 = 0 THEN ' ; ' || p_brand ELSE '' END || ' : ' || p_type END AS title,
    CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 5 = 0 THEN 'Else' ELSE p_brand || ', Ana' END END AS creator,
    CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 'Lyon - Paris' ELSE 'Nice' END END AS place,
    CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 3 = 0 THEN p_type END END AS publisher, CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 1950 + p_size ELSE 1987 END END AS year
    FROM part JOIN {_NUMBERS} USING (p_partkey)"""
)
def author_search_notices(spark, sf_dir):
    key, c = F.col("p_partkey"), F.col
    first = F.concat(F.lit("978"), F.lpad(key.cast("string"), 9, "0"))
    number = F.when(key % 7 == 0, F.concat(F.lit("ISBN "), key)).otherwise(isbn.isbn13_from_nine(F.lpad(key.cast("string"), 9, "0")))
    second = F.when((key % 3 == 0) & (key % 7 != 0), "0-306-40615-2").otherwise(first)
    some = lambda when, *parts: [F.when(when, F.concat(*parts)).otherwise(F.lit(""))]
    parts = [
        F.lit('<record><controlfield tag="001">'), key.cast("string"), F.lit("</controlfield>"), *_field("010", ("a", number)), *_field("010", ("a", second), ("a", number)),
        F.lit('<datafield tag="200"><subfield code="a">'), c("p_name"), F.lit(" /</subfield>"), *some(key % 2 == 0, F.lit('<subfield code="a">'), c("p_brand"), F.lit("</subfield>")),
        F.lit('<subfield code="e"> '), c("p_type"), F.lit(" :</subfield></datafield>"), *_field("200", ("a", "second")),
        *some(key % 5 != 0, *_field("700", ("a", c("p_brand")), ("b", "Ana,")), *_field("700", ("a", "Third"))), *_field("701", ("a", "Else")),
        *some(key % 3 == 0, *_field("214", ("a", "Lyon ;"), ("a", "Paris"), ("c", c("p_type")), ("d", "s. d."), ("d", F.concat(F.lit("cop. "), (c("p_size") + 1950).cast("string")))), *_field("214", ("a", "Lyon"))),
        *_field("210", ("a", "Nice"), ("d", "1987-1990")), F.lit("</record>"),
    ]
    raw = dealt(spark, sf_dir, "part").select("p_partkey", F.concat(*parts).alias("xml"))
    found = notice_fields(raw, "xml")
    return found.select("p_partkey", "ppn", F.array_join("numbers", " | ").alias("numbers"), "title", "creator", "place", "publisher", "year")


@query("SELECT p_partkey, 'cb' || p_partkey AS ark FROM part WHERE NOT (p_partkey % 5 <> 0 AND p_partkey % 3 = 0)")
def computer_media_dropped(spark, sf_dir):
    """Notices against answers of at most 50 records, some of which hold a diagnostic in place of a record."""
    key = F.col("p_partkey")
    ark = F.concat(F.lit("ark:/12148/cb"), key)
    marc = F.concat(F.lit('<mxc:record id="'), ark, F.lit('"><mxc:leader>x</mxc:leader><mxc:datafield tag="182"><mxc:subfield code="6">z</mxc:subfield><mxc:subfield code="c">'),
                    F.when(key % 3 == 0, " C ").otherwise("n"), F.lit("</mxc:subfield></mxc:datafield></mxc:record>"))
    data = F.when(key % 5 == 0, F.lit("<diag:diagnostic><diag:uri>1/131</diag:uri></diag:diagnostic>")).otherwise(marc)
    record = F.concat(F.lit("<srw:record><srw:recordData>"), data, F.lit("</srw:recordData><srw:recordIdentifier>"), ark, F.lit("#x</srw:recordIdentifier></srw:record>"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("cb"), key).alias("ark"), record.alias("record"))
    pages = part.groupBy(F.floor(key / 50).alias("page")).agg(F.array_join(F.collect_list("record"), "").alias("r"))
    names = 'xmlns:srw="http://www.loc.gov/zing/srw/" xmlns:mxc="info:x" xmlns:diag="info:d"'
    answers = pages.select(F.concat(F.lit(f"<srw:searchRetrieveResponse {names}><srw:records>"), "r", F.lit("</srw:records></srw:searchRetrieveResponse>")).alias("body"))
    return without_carrier(part.select("p_partkey", "ark"), media_checks(answers, "body"), "ark", "id", "computer")


@query("SELECT p_partkey, lpad(p_partkey::VARCHAR, 9, '0') AS ppn FROM part WHERE p_partkey % 4 <> 1")
def electronic_dropped(spark, sf_dir):
    """Notices against internal records, which are there for two of three."""
    key = F.col("p_partkey")
    part = dealt(spark, sf_dir, "part").select("p_partkey", F.lpad(key.cast("string"), 9, "0").alias("ppn"))
    carrier = F.when(key % 4 == 1, "CEB ").otherwise("nc")
    raw = part.filter("p_partkey % 3 <> 2 OR p_partkey % 4 = 1").select(F.concat(F.lit("<record>"), *_field("003@", ("0", key.cast("string"))), *_field("012V", ("a", "ceb"), ("c", carrier)), F.lit("</record>")).alias("xml"))
    return without_carrier(part, electronic_checks(raw, "xml"), "ppn", "ppn", "electronic")


@query("SELECT c_custkey, (row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1) // 150 AS lot FROM customer")
def lots_of_keys(spark, sf_dir):
    return in_lots_of(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), 150, "c_nationkey", ["c_custkey"]).drop("c_nationkey")


@query("SELECT event_id, CASE WHEN value > 50 THEN 0 ELSE value END AS value, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, CASE WHEN event_type LIKE 'c%' THEN '' ELSE event_type END AS event_type FROM events")
def filled_nulls(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    holes = events.select(
        "event_id", F.when(~(F.col("value") > 50), F.col("value")).alias("value"), F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("user_id"),
        F.when(~F.col("event_type").like("c%"), F.col("event_type")).alias("event_type"),
    )
    return holes.fillna(0).fillna("")


@query(
    """SELECT p_partkey, p_brand || CASE WHEN p_partkey % 2 = 0 THEN ', Ana Maria' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN ' IV' ELSE '' END
    || CASE WHEN p_partkey % 5 = 0 THEN ' (' || p_type || ')' ELSE '' END || ' (' || (1900 + p_size) || '-)' AS name FROM part"""
)
def composed_names(spark, sf_dir):
    key, some = F.col("p_partkey"), lambda when, v: F.when(when, v)
    name = text.composed_name(
        F.col("p_brand"), some(key % 2 == 0, F.lit(" Ana  Maria")), expansion=F.lit(" "), numeral=some(key % 3 == 0, F.lit("IV")),
        qualifier=some(key % 5 == 0, F.col("p_type")), dates=F.concat((F.col("p_size") + 1900).cast("string"), F.lit("-")),
    )
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
