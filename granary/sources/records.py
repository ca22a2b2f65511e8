"""Bibliographic XML records: control fields, and data fields with coded subfields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.once import computed
from granary.functions.text import contains_any

_SUBFIELDS = "array<struct<_code: string, _VALUE: string>>"
SCHEMA = (
    "controlfield array<struct<_tag: string, _VALUE: string>>,"
    f" datafield array<struct<_tag: string, _ind1: string, _ind2: string, subfield: {_SUBFIELDS}>>"
)


def parsed_records(df: DataFrame, column: str) -> DataFrame:
    """Adds a struct record, parsed once from the XML text; null for what is no XML."""
    return df.withColumn("record", F.from_xml(F.col(column), SCHEMA, {"mode": "PERMISSIVE"}))


def control_value(tag: str, record: str = "record") -> Column:
    found = F.filter(F.col(f"{record}.controlfield"), lambda f: f["_tag"] == tag)
    return F.get(found, F.lit(0))["_VALUE"]


def field_values(tags: str | list[str], code: str | list[str], record: str = "record") -> Column:
    """All values of the subfields with a code, in record order; an empty array where there are none."""
    tags, codes = [tags] if isinstance(tags, str) else tags, [code] if isinstance(code, str) else code
    fields = F.filter(F.coalesce(F.col(f"{record}.datafield"), F.array()), lambda f: f["_tag"].isin(*tags))
    values = F.flatten(F.transform(fields, lambda f: F.filter(f["subfield"], lambda s: s["_code"].isin(*codes))))
    return F.transform(values, lambda s: s["_VALUE"])


def first_value(tags: list[str], code: str, record: str = "record") -> Column:
    """The first value of the first tag that has one."""
    return F.coalesce(*(F.get(field_values(t, code, record), F.lit(0)) for t in tags))


#: The fields and subfields of a record that hold its own and related titles.
TITLE_TAGS = (
    "200 423 424 425 430 431 432 433 434 435 436 437 440 441 442 443 444 445 446 447 451 452 453 454 455 456 461 462 463 464"
    " 470 481 482 488 500 501 503 510 511 512 513 514 515 516 517 518 520 530 531 532 540 541 545"
).split()
TITLE_CODES = ["a", "e", "h", "i", "t"]
#: Subject fields; their codes 2 and 3 name the vocabulary and the authority.
SUBJECT_TAGS = [str(k) for k in range(600, 610)]


def subject_values(record: str = "record") -> Column:
    fields = F.filter(F.coalesce(F.col(f"{record}.datafield"), F.array()), lambda f: f["_tag"].isin(*SUBJECT_TAGS))
    values = F.flatten(F.transform(fields, lambda f: F.filter(f["subfield"], lambda s: ~s["_code"].isin("2", "3"))))
    return F.transform(values, lambda s: s["_VALUE"])


def local_works(df: DataFrame, terms: dict[str, list[str]]) -> DataFrame:
    """Records with an id, a number (010$a) and a reason: a title, place or subject that holds one of its terms.

    terms has a list for title, place_of_publication or subject. Adds id, numbers, titles, places, subjects,
    persons (ids of 700-702$3) and reasons.
    """
    found = computed(
        df,
        id=F.trim(control_value("001")), numbers=field_values("010", "a"), titles=field_values(TITLE_TAGS, TITLE_CODES),
        places=field_values(["210", "214"], "a"), subjects=subject_values(), persons=field_values(["700", "701", "702"], "3"),
    )
    columns = {"title": "titles", "place_of_publication": "places", "subject": "subjects"}

    def reason(name: str, own: list[str]) -> Column:
        return F.when(F.exists(columns[name], lambda x: F.coalesce(contains_any(x, own), F.lit(False))), F.lit(name))

    out = computed(found.filter((F.col("id") != "") & (F.size("numbers") > 0)), reasons=F.array_compact(F.array(*(reason(k, own) for k, own in terms.items()))))
    return out.filter(F.size("reasons") > 0)


def _any(*names: str) -> str:
    return " or ".join(f"local-name()='{n}'" for n in names)


def envelope(df: DataFrame, column: str) -> DataFrame:
    """Adds what a search answer says of itself, whatever its name spaces: n_records (null if it does not say), ids, and
    unchecked, those of its ids that come with a diagnostic in place of a record.

    complete is false where the answer holds fewer ids than it counts, so that further pages must be asked for.
    """
    held = "//*[local-name()='record'][*[local-name()='recordData']]"
    marc = _any("leader", "controlfield", "datafield")
    bare = f"//*[local-name()='record'][*[local-name()='recordData'][.//*[local-name()='diagnostic'] and not(.//*[{marc}])]]"
    identifier = "/*[local-name()='recordIdentifier']/text()"
    trimmed = lambda path: F.filter(F.transform(F.xpath(column, F.lit(path)), lambda x: F.trim(x)), lambda x: x != "")
    count = F.xpath_string(column, F.lit("//*[local-name()='numberOfRecords']")).try_cast("long")
    out = df.withColumns({"n_records": count, "ids": trimmed(held + identifier), "unchecked": trimmed(bare + identifier)})
    return out.withColumn("complete", F.size("ids") >= F.col("n_records"))
