"""Checks before a load: counters in one row, and a gate that raises on them."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A table failed its checks."""


def gate_counts(df: DataFrame, keys: list[str], required: list[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """One row: n_rows, n_missing, n_repeated, n_out_of_range. Nulls are never out of range."""
    any_of = lambda tests: functools.reduce(Column.__or__, tests, F.lit(False))
    missing = any_of([F.col(c).isNull() for c in required])
    outside = any_of([(F.col(c) < a) | (F.col(c) > b) for c, (a, b) in ranges.items()])
    own = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(missing).alias("m"), F.count_if(outside).alias("o"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return own.agg(
        zero(F.col("n")).alias("n_rows"), zero(F.col("m")).alias("n_missing"),
        zero(F.col("n") - 1).alias("n_repeated"), zero(F.col("o")).alias("n_out_of_range"),
    )


def check(df: DataFrame, keys: list[str], required: list[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """df, if it passes; a QualityError that names the counters otherwise."""
    row = gate_counts(df, keys, required, ranges).first().asDict()
    faults = {k: v for k, v in row.items() if k != "n_rows" and v}
    if faults:
        raise QualityError(f"{faults} in {row['n_rows']} rows")
    return df


def require_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """df, if it has columns of these names and Spark types; a QualityError that names all that are missing or of another kind."""
    there = dict(df.dtypes)
    wrong = [f"{c} is missing" if c not in there else f"{c} is {there[c]}, not {kind}" for c, kind in kinds.items() if there.get(c) != kind]
    if wrong:
        raise QualityError("; ".join(wrong))
    return df


def require_absent(df: DataFrame, forbidden: DataFrame, key: str, examples: int = 5) -> DataFrame:
    """df, if none of its keys is among the forbidden ones; a QualityError with some of them otherwise. Null is no key."""
    left = df.select(key).filter(F.col(key).isNotNull()).join(forbidden.select(key), key, "left_semi")
    found = [r[0] for r in left.limit(examples).collect()]
    if found:
        raise QualityError(f"keys that must not be left: {', '.join(map(str, found))}")
    return df
