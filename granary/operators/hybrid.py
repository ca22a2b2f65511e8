"""Documents from records that a graph has found: fields from the record's XML, the year from the graph where it knows one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.isbn import normalize_isbn
from granary.functions.once import computed, once
from granary.functions.text import SEPARATOR, contains_any
from granary.sources.records import parsed_records

#: Fields and subfields of titles that are searched for a term, and of subjects.
TITLE_FIELDS = "200 500 501 503 510 512 513 514 515 516 517 518 520 530 531 532 540 541 545".split()
TITLE_CODES = list("aehi")
SUBJECT_FIELDS = [str(k) for k in range(600, 700)]
SUBJECT_CODES = list("abcdfghjklmnopqrstuvxyz")
#: Of a person's and of a body's field, the subfields that make up its name.
NAME_CODES = {("700", "701", "702"): list("ab"), ("710", "711", "712"): list("abc")}
#: An authority number, and a year from 1000 to 2099, each by itself.
AUTHORITY = r"(?i)(?<![0-9A-Z])([0-9]{8}[0-9X])(?![0-9A-Z])"
YEAR = r"(?<!\d)(1[0-9]{3}|20[0-9]{2})(?!\d)"


def tag_index(record: str = "record") -> Column:
    """A map from tag to a map from code to the values in record order, trimmed, empty ones left out.

    Made once for a record as a column of its own; looking up a field then reads no other field.
    """
    fields = F.filter(F.coalesce(F.col(f"{record}.datafield"), F.array()), lambda f: f["_tag"].isNotNull() & f["subfield"].isNotNull())
    one = lambda f: F.transform(f["subfield"], lambda s: F.struct(f["_tag"].alias("tag"), s["_code"].alias("code"), F.trim(s["_VALUE"]).alias("value")))
    known = F.filter(F.flatten(F.transform(fields, one)), lambda e: e["code"].isNotNull() & (e["value"] != ""))

    def by(entries: Column, key: str, inner) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e[key]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: inner(F.filter(entries, lambda e: e[key] == k))))

    whole = lambda entries: by(entries, "tag", lambda own: by(own, "code", lambda same: F.transform(same, lambda e: e["value"])))
    return once(known, whole)  # so that the fields are gone through once


def indexed_values(tags: list[str], codes: list[str], index: str = "index") -> Column:
    """All values of the codes of the tags, by tag, then code, then record order; an empty array where there are none.

    Only tags and codes that the record has are looked up, in the order of the lists.
    """
    none = F.array().cast("array<string>")
    there = lambda known, names: F.array_intersect(F.array(*map(F.lit, names)), F.coalesce(F.map_keys(known), none))
    of_codes = lambda own: F.flatten(F.transform(there(own, codes), lambda c: F.element_at(own, c)))
    return F.flatten(F.transform(there(F.col(index), tags), lambda t: once(F.element_at(F.col(index), t), of_codes)))


def _joined(values: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), SEPARATOR)


def creators(record: str = "record") -> tuple[Column, Column]:
    """(names, authority numbers) of persons and bodies, an array each; a name is its parts with a space between."""
    fields = F.filter(F.coalesce(F.col(f"{record}.datafield"), F.array()), lambda f: f["_tag"].isin(*(t for tags in NAME_CODES for t in tags)))
    values = lambda f, code: F.filter(F.transform(F.filter(f["subfield"], lambda s: s["_code"] == code), lambda s: F.trim(s["_VALUE"])), lambda v: v != "")

    def name(f: Column) -> Column:
        out = F.lit("")
        for tags, codes in NAME_CODES.items():
            out = F.when(f["_tag"].isin(*tags), F.array_join(F.flatten(F.array(*(values(f, c) for c in codes))), " ")).otherwise(out)
        return out

    numbers = F.transform(F.flatten(F.transform(fields, lambda f: values(f, "3"))), lambda v: F.upper(F.regexp_extract(v, AUTHORITY, 1)))
    known = lambda array: F.filter(array, lambda v: v != "")
    return known(F.transform(fields, name)), known(numbers)


def text_year(dates: Column) -> Column:
    """The first year that one of several texts holds."""
    years = F.transform(dates, lambda d: F.regexp_extract(d, YEAR, 1))
    return F.get(F.filter(years, lambda y: y != ""), F.lit(0)).cast("int")


def hybrid_documents(df: DataFrame, xml: str, terms: list[str], known_year: str | None = None) -> DataFrame:
    """A row for each document and each of its numbers, sorted: the other columns of df, then creator_ids, isbn, title,
    creators, publisher, year, subjects, places and reasons.

    A record is left out where its text is no XML, its carrier is online (338$b is cr), none of its numbers passes its
    check, or neither its titles, its subjects nor its places of publication hold a term that stands by itself. The year
    in known_year goes before one read from a date of publication. Cells of several values are sorted.
    """
    others = [c for c in df.columns if c not in (xml, known_year)]
    parsed = computed(parsed_records(df, xml), index=tag_index())
    named, numbered = creators()
    fields = computed(
        parsed,
        _online=F.exists(indexed_values(["338"], ["b"]), lambda v: F.lower(v) == "cr"),
        _numbers=indexed_values(["010"], ["a"]),
        _titles=indexed_values(TITLE_FIELDS, TITLE_CODES), _subjects=indexed_values(SUBJECT_FIELDS, SUBJECT_CODES),
        _places=indexed_values(["210", "214"], ["a"]), _dates=indexed_values(["210", "214"], ["d"]),
        title=_joined(indexed_values(["200"], TITLE_CODES)), publisher=_joined(indexed_values(["210", "214"], ["c"])),
        creators=_joined(named), creator_ids=_joined(numbered),
    )
    holds = lambda c: F.exists(c, lambda v: F.coalesce(contains_any(v, terms, True), F.lit(False)))
    reasons = [F.when(holds(c), F.lit(name)) for name, c in (("title", "_titles"), ("subject", "_subjects"), ("place_of_publication", "_places"))]
    numbers = F.array_compact(F.transform("_numbers", lambda v: normalize_isbn(v, "strict")))
    kept = computed(fields.filter(~F.col("_online")), _isbn=F.array_sort(F.array_distinct(numbers)), _reasons=F.array_compact(F.array(*reasons)))
    year = F.coalesce(F.col(known_year).cast("int"), text_year(F.col("_dates"))) if known_year else text_year(F.col("_dates"))
    return kept.filter(F.size("_reasons") > 0).select(
        *others, "creator_ids", F.explode("_isbn").alias("isbn"), "title", "creators", "publisher", year.alias("year"),
        _joined(F.col("_subjects")).alias("subjects"), _joined(F.col("_places")).alias("places"), F.array_join("_reasons", SEPARATOR).alias("reasons"),
    )
