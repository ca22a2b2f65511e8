"""ISBN checks and conversions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.once import once


def _weighted(code: Column, weights: list[int]) -> Column:
    """The weighted sum of the digits, X as 10; the code is evaluated once, into an array of characters."""
    terms = F.zip_with(
        F.split(code, ""),
        F.array(*map(F.lit, weights)),
        lambda c, w: F.coalesce(F.when(c == "X", 10).otherwise(c.try_cast("int")), F.lit(0)) * F.coalesce(w, F.lit(0)),
    )
    return F.aggregate(terms, F.lit(0), lambda s, x: s + x)


def is_isbn10(code: Column) -> Column:
    """Nine digits and a digit or X, whose weighted sum is a multiple of 11."""
    return once(code, lambda c: F.when(c.rlike("^[0-9]{9}[0-9X]$"), _weighted(c, list(range(10, 0, -1))) % 11 == 0).otherwise(False))


def is_isbn13(code: Column) -> Column:
    """13 digits whose sum with weights 1 and 3 is a multiple of 10."""
    return once(code, lambda c: F.when(c.rlike("^[0-9]{13}$"), _weighted(c, [1, 3] * 6 + [1]) % 10 == 0).otherwise(False))


def isbn13_from_nine(nine: Column) -> Column:
    """The 978 number of an ISBN's nine digits without check."""
    return once(F.concat(F.lit("978"), nine), lambda body: F.concat(body, ((10 - _weighted(body, [1, 3] * 6) % 10) % 10).cast("string")))


def isbn10_to_13(code: Column) -> Column:
    return once(code, lambda c: F.when(is_isbn10(c), isbn13_from_nine(F.left(c, F.lit(9)))))


def isbn13_to_10(code: Column) -> Column:
    """Only 978 numbers have a ten-digit form; null for the rest."""

    def ten(nine: Column) -> Column:
        check = (11 - _weighted(nine, list(range(10, 1, -1))) % 11) % 11
        return F.concat(nine, once(check, lambda k: F.when(k == 10, "X").otherwise(k.cast("string"))))

    return once(code, lambda c: F.when(c.startswith("978") & is_isbn13(c), once(F.substring(c, 4, 9), ten)))


def normalize_isbn(raw: Column, mode: str = "prefix") -> Column:
    """The 13-digit form, or null.

    ``strict`` takes all digits and X; ``prefix`` only the leading run of digits,
    X, hyphens and spaces, where there is one; ``lenient`` checks no digit.
    """
    if mode not in ("strict", "prefix", "lenient"):
        raise ValueError(f"mode {mode!r} is none of strict, prefix, lenient")
    text = F.upper(raw)
    if mode == "prefix":
        lead = lambda t: F.regexp_extract(t, r"^\s*([0-9X][0-9X\-\s]{8,30})", 1)
        text = once(text, lambda t: once(lead(t), lambda run: F.when(run != "", run).otherwise(t)))

    def of(code: Column) -> Column:
        nine = isbn13_from_nine(F.left(code, F.lit(9)))
        if mode == "lenient":
            return F.when(code.rlike("^[0-9]{13}$"), code).when(code.rlike("^[0-9]{9}[0-9X]$"), nine)
        return F.when(is_isbn13(code), code).when(is_isbn10(code), nine)

    return once(F.regexp_replace(text, "[^0-9X]", ""), of)


def search_forms(code13: Column) -> Column:
    """The forms under which a catalogue may list a number."""
    return once(code13, lambda c: F.array_compact(F.array(c, isbn13_to_10(c))))
