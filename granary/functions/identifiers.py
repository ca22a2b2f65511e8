"""Identifiers of library catalogues as Column expressions: always text, null where there is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MISSING = ["", "nan", "none", "null", "<na>"]


def strip_float_suffix(raw: Column) -> Column:
    """Numbers read as text lose the .0 that a spreadsheet adds; words for nothing become null."""
    text = F.regexp_replace(F.trim(raw.cast("string")), r"\.0$", "")
    return F.when(~F.lower(text).isin(_MISSING), text)


def normalize_ppn(raw: Column, mode: str = "pad") -> Column:
    """A record number of nine places.

    ``pad`` fills up to nine with zeros; ``exact`` also wants eight digits and a
    digit or X; ``search`` takes the first such token of the text.
    """
    text = F.upper(strip_float_suffix(raw))
    if mode == "search":
        found = F.regexp_extract(text, r"(?<![0-9A-Z])([0-9]{8}[0-9X])(?![0-9A-Z])", 1)
        clean = F.regexp_replace(text, "[^0-9X]", "")
        return F.when(found != "", found).when(clean.rlike("^[0-9]{8}[0-9X]$"), clean)
    clean = F.regexp_replace(text, "[^0-9X]", "")
    padded = F.when(clean == "", None).when(F.length(clean) < 9, F.lpad(clean, 9, "0")).otherwise(clean)
    if mode == "exact":
        return F.when(padded.rlike("^[0-9]{8}[0-9X]$"), padded)
    if mode != "pad":
        raise ValueError(f"mode {mode!r} is none of pad, exact, search")
    return padded


def normalize_gnd(raw: Column) -> Column:
    """The bare number of an authority record, from a link or with a prefix."""
    tail = F.element_at(F.split(strip_float_suffix(raw), "/"), -1)
    bare = F.trim(F.regexp_replace(tail, r"(?i)^\s*(\(DE-588\)|GND:)\s*", ""))
    return F.when(bare != "", bare)


def normalize_bnf(raw: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(strip_float_suffix(raw), "[^0-9A-Za-z]", ""), "(?i)^cb", "")
    return F.when(bare != "", bare)


def ark_of(uri: Column) -> Column:
    found = F.regexp_extract(uri, r"(ark:/[0-9]+/[0-9a-z]+)", 1)
    return F.when(found != "", found)


def last_segment(uri: Column, pattern: str = "[^/#?]+") -> Column:
    """What stands after the last slash of a link, without fragment or query."""
    found = F.regexp_extract(uri, rf"/({pattern})(?:[#?].*)?$", 1)
    return F.when(found != "", found)
