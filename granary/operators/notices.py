"""Notices of union catalogues: one row of fields for each, and checks of what carries the work.

A carrier's check comes from another service than the notice, keyed by its number;
what could not be checked stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.identifiers import normalize_ppn
from granary.functions.isbn import normalize_isbn
from granary.functions.once import computed
from granary.functions.text import first_year, trim_punctuation
from granary.sources.records import control_value, field_values, parsed_records


def _fields(tag: str, record: str = "record") -> Column:
    return F.filter(F.coalesce(F.col(f"{record}.datafield"), F.array()), lambda f: f["_tag"] == tag)


def _values(field: Column, code: str) -> Column:
    """The cleaned values of a field's subfields with a code."""
    own = F.filter(F.coalesce(field["subfield"], F.array()), lambda s: s["_code"] == code)
    return F.filter(F.transform(own, lambda s: trim_punctuation(s["_VALUE"])), lambda v: v != "")


def _first_of(tags: list[str]) -> Column:
    """The fields of the first tag that has any."""
    out = F.array()
    for tag in reversed(tags):
        own = _fields(tag)
        out = own if tag == tags[-1] else F.when(F.size(own) > 0, own).otherwise(out)
    return out


def _joined(values: Column, sep: str) -> Column:
    return F.nullif(F.array_join(F.array_distinct(values), sep), F.lit(""))


def notice_fields(df: DataFrame, xml: str) -> DataFrame:
    """Adds ppn, numbers, title, year, creator, place and publisher of each record.

    Numbers pass their check, each once, in the record's order; without one the other fields are null. The title is the
    first title field's proper titles, then its other parts behind a colon; the creator is the first person of 700, or
    else of 701; place, publisher and year are those of 214, or else of 210. Values lose the sign that ends them.
    """
    numbers = F.array_compact(F.transform(field_values("010", "a"), lambda v: normalize_isbn(v, "strict")))
    parsed = computed(parsed_records(df, xml), ppn=F.trim(control_value("001")), numbers=F.array_distinct(numbers), _title=F.get(_fields("200"), F.lit(0)),
                      _creator=F.get(_first_of(["700", "701"]), F.lit(0)), _published=_first_of(["214", "210"]))
    proper, other = (_joined(_values(F.col("_title"), c), " ; ") for c in "ae")
    name, given = (F.get(_values(F.col("_creator"), c), F.lit(0)) for c in "ab")
    published = lambda c: F.flatten(F.transform("_published", lambda f: _values(f, c)))
    dates = F.flatten(F.transform("_published", lambda f: F.transform(F.filter(F.coalesce(f["subfield"], F.array()), lambda s: s["_code"] == "d"), lambda s: s["_VALUE"])))
    years = F.filter(F.transform(dates, lambda d: first_year(d)), lambda y: y.isNotNull())
    made = {
        "title": F.concat_ws(" : ", proper, other), "year": F.get(years, F.lit(0)), "creator": F.concat_ws(", ", name, given),
        "place": _joined(published("a"), " - "), "publisher": _joined(published("c"), " - "),
    }
    known = F.size("numbers") > 0
    full = computed(parsed, **{k: F.when(known, F.nullif(v, F.lit("")) if k in ("title", "creator") else v) for k, v in made.items()})
    return full.drop("record", "_title", "_creator", "_published")


#: What a search answer holds of each record, whatever its name spaces.
_ANSWER = (
    "records struct<record: array<struct<recordIdentifier: string, recordData: struct<diagnostic: struct<uri: string>, record: struct<_id: string, leader: string,"
    " controlfield: array<struct<_tag: string>>, datafield: array<struct<_tag: string, subfield: array<struct<_code: string, _VALUE: string>>>>>>>>>"
)


def ark_number(raw: Column) -> Column:
    """The number in an archival resource key, with or without what is around it."""
    bare = F.trim(F.substring_index(F.substring_index(raw, "ark:/12148/", -1), "#", 1))
    return F.when(bare != "", bare)


def media_checks(answers: DataFrame, body: str) -> DataFrame:
    """(id, computer, unchecked) of the records in search answers: computer where 182$c is c; unchecked, and so not computer,
    where a diagnostic stands in place of the record. Of several answers for an id one that says computer counts."""
    parsed = answers.select(F.from_xml(F.col(body), _ANSWER, {"mode": "PERMISSIVE", "ignoreNamespace": "true"}).alias("a"))
    each = parsed.select(F.explode("a.records.record").alias("r")).select("r.recordIdentifier", "r.recordData.diagnostic", F.col("r.recordData.record").alias("marc"))
    there = F.col("marc").isNotNull() & (F.col("marc.leader").isNotNull() | F.col("marc.controlfield").isNotNull() | F.col("marc.datafield").isNotNull())
    fields = F.filter(F.coalesce("marc.datafield", F.array()), lambda f: f["_tag"] == "182")
    codes = F.flatten(F.transform(fields, lambda f: F.filter(F.coalesce(f["subfield"], F.array()), lambda s: s["_code"] == "c")))
    computer = F.exists(codes, lambda s: F.lower(F.trim(s["_VALUE"])) == "c")
    rows = each.select(
        F.when(there, ark_number(F.col("marc._id"))).when(F.col("diagnostic").isNotNull(), ark_number(F.col("recordIdentifier"))).alias("id"),
        (there & computer).alias("computer"), (~there).alias("unchecked"),
    )
    return rows.filter("id IS NOT NULL").groupBy("id").agg(F.bool_or("computer").alias("computer"), F.bool_and("unchecked").alias("unchecked"))


def electronic_checks(df: DataFrame, xml: str) -> DataFrame:
    """(ppn, electronic) of internal records: the number in 003@$0, and whether a carrier in 012V$c is ceb."""
    record = computed(
        parsed_records(df.select(xml), xml),
        ppn=normalize_ppn(F.get(field_values("003@", "0"), F.lit(0))),
        electronic=F.exists(field_values("012V", "c"), lambda v: F.lower(F.trim(v)) == "ceb"),
    )
    return record.filter("ppn IS NOT NULL").groupBy("ppn").agg(F.bool_or("electronic").alias("electronic"))


def without_carrier(notices: DataFrame, checks: DataFrame, key: str, check_key: str, flag: str) -> DataFrame:
    """notices that a check has not found to be of the carrier; those without a key, or without a check, stay."""
    bad = checks.filter(F.coalesce(flag, F.lit(False))).select(F.col(check_key).alias("_bad"))
    return notices.join(bad, F.col(key) == F.col("_bad"), "left_anti")
