"""Text clean-up, keyword predicates and multi-valued cells as Column expressions."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = " | "
_SPACE = " \t\n\x0b\x0c\r"


@functools.cache
def _folding() -> tuple[str, str]:
    """Letters, and what canonical decomposition leaves of them without marks; then the marks, which have no counterpart."""
    letters, plain, marks = [], [], []
    for k in (*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)):
        c = chr(k)
        if unicodedata.category(c) == "Mn":
            marks.append(c)
        elif unicodedata.decomposition(c):
            bases = [x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn"]
            if len(bases) == 1 and bases != [c]:
                letters.append(c)
                plain += bases
    return "".join(letters + marks), "".join(plain)


def fold(text: Column) -> Column:
    """Lower case without outer space and accents (decomposed, marks dropped), ligatures spelled out, plain apostrophes.

    Letters that do not decompose, such as a sharp s or a barred o, stay.
    """
    out = F.btrim(F.lower(text), F.lit(_SPACE))
    ascii_only = F.octet_length(out) == F.char_length(out)
    other = out
    for a, b in (("œ", "oe"), ("æ", "ae"), ("’", "'")):
        other = F.replace(other, F.lit(a), F.lit(b))
    return F.when(ascii_only, out).otherwise(F.translate(other, *_folding()))


def trim_punctuation(text: Column) -> Column:
    """Drops the separator that a catalogue description ends with."""
    return F.trim(F.regexp_replace(F.trim(text), r"\s*[/:;,]\s*$", ""))


def contains_any(text: Column, terms: list[str], bounded: tuple[str, ...] | bool = ()) -> Column:
    """Whether folded text holds a term; terms in bounded (or all, if True) only between non-letters."""
    whole = set(terms) if bounded is True else set(bounded or ())
    parts = [rf"(?<![a-z]){re.escape(t)}(?![a-z])" if t in whole else re.escape(t) for t in terms]
    return fold(text).rlike("|".join(parts))


def first_year(text: Column, latest: str = "2[01]") -> Column:
    """The first year from 1000 to 2199 that stands by itself, as an integer. The pattern is a fixed value."""
    return F.regexp_extract(text, rf"\b(1[0-9]{{3}}|{latest}[0-9]{{2}})\b", 1).try_cast("int")


def leading_year(date: Column) -> Column:
    found = F.left(F.trim(date), F.lit(4))
    return F.when(found.rlike("^[0-9]{4}$"), found)


def split_cell(cell: Column) -> Column:
    """The distinct values of a multi-valued cell, in their order."""
    parts = F.transform(F.split(F.coalesce(cell, F.lit("")), r"\|"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def merge_cells(*cells: Column) -> Column:
    merged = F.array_distinct(F.concat(*(split_cell(c) for c in cells)))
    return F.when(F.size(merged) > 0, F.array_join(merged, SEPARATOR))


def sorted_distinct(column: Column) -> Column:
    """Aggregate: the distinct trimmed values that are not empty, sorted and joined."""
    value = F.trim(column)
    return F.array_join(F.array_sort(F.collect_set(F.when(value != "", value))), SEPARATOR)


def name_parts(full: Column) -> tuple[Column, Column]:
    """Family and given name of "Family, Given[, ...]"; nulls without a comma."""
    parts = F.split(full, ",")
    known = F.size(parts) >= 2
    return F.when(known, F.trim(parts[0])), F.when(known, F.trim(F.get(parts, F.lit(1))))


def full_name(family: Column, given: Column, dates: Column | None = None) -> Column:
    """ "Family, Given (dates)" from the parts that are there."""
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    name = F.concat_ws(", ", blank(family), blank(given))
    return name if dates is None else F.concat_ws(" ", name, F.concat(F.lit("("), blank(dates), F.lit(")")))


def composed_name(family: Column, given: Column, *, expansion: Column, numeral: Column, qualifier: Column, dates: Column) -> Column:
    """ "Family, Given Expansion IV (qualifier) (dates)" from the parts that are there; a part that comes first stands bare.

    White space within and around parts is single; null where there is no part.
    """
    known = lambda c: F.nullif(F.btrim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))
    base = F.nullif(F.concat_ws(", ", known(family), known(given)), F.lit(""))
    bracketed = lambda c: F.concat(F.lit("("), known(c), F.lit(")"))
    bare = F.array_compact(F.array(base, *map(known, (expansion, numeral, qualifier, dates))))
    dressed = F.array_compact(F.array(base, known(expansion), known(numeral), bracketed(qualifier), bracketed(dates)))
    return F.nullif(F.concat_ws(" ", F.get(bare, F.lit(0)), F.slice(dressed, 2, 4)), F.lit(""))


def with_thousands(number: Column) -> Column:
    """Integer part with a space between thousands."""
    return F.replace(F.format_number(number.cast("long"), 0), F.lit(","), F.lit(" "))


def to_number(text: Column) -> Column:
    """A double, or null for what is no number; a decimal comma is read too."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


#: Fixed value: the characters that a search engine's query syntax keeps for itself.
_RESERVED = r"""([+\-!(){}\[\]^"~*?:\\/])"""


def escaped_term(text: Column) -> Column:
    """A term with a backslash before each character that search queries reserve."""
    return F.regexp_replace(text, _RESERVED, r"\\$1")


def escaped_literal(text: Column) -> Column:
    """A text as the inside of a quoted literal of a graph query."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def local_iso_time(instant: Column, zone: str = "Europe/Paris") -> Column:
    """An instant as ISO text of a zone's clock, with its offset in whole minutes."""
    universal = F.to_utc_timestamp(instant, F.current_timezone())
    there = F.from_utc_timestamp(universal, zone)
    minutes = ((F.unix_timestamp(there) - F.unix_timestamp(universal)) / 60).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.format_string("%s%02d:%02d", sign, F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)
    return F.concat(F.date_format(there, "yyyy-MM-dd'T'HH:mm:ss"), offset)
