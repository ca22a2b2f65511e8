"""Values that are read more than once but that Spark computes once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), in which value is computed a single time however often it is read.

    A column is no variable: each mention would be computed anew, and nested ones multiply.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later filters and selections read as they are: an explode of one row, which Spark sees no way through.

    Otherwise the optimizer would copy a costly expression to each place that reads it.
    """
    made = F.explode(F.array(F.struct(*(v.alias(k) for k, v in columns.items()))))
    return df.select("*", made.alias("_made")).select(*df.columns, "_made.*")
