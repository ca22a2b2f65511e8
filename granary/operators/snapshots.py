"""What changed between two versions of a table that people annotate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.relational import filled_if_blank


def refreshed(old: DataFrame, new: DataFrame, key: str, version: str, annotations: Sequence[str]) -> DataFrame:
    """The rows of new with what was noted on them in old, and a status: new, modified or unchanged by their version.

    A note in new goes before one in old. Where old has a key several times, its latest version counts. Rows without a
    key are new. Other columns come from new; a column that new lacks is taken from old.
    """
    seen = F.struct(F.lit(True).alias("there"), F.col(version).alias("version"), *(F.col(c).alias(f"n{k}") for k, c in enumerate(annotations)))
    before = old.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max_by(seen, F.coalesce(F.unix_micros(F.col(version).cast("timestamp")), F.lit(-(2**62)))).alias("_old"))
    both = new.join(before, F.col(key) == F.col("_key"), "left")
    status = F.when(F.col("_old.there").isNull(), "new").when(F.col("_old.version").eqNullSafe(F.col(version)), "unchanged").otherwise("modified")
    notes = {c: filled_if_blank(F.col(c), F.col(f"_old.n{k}")) if c in new.columns else F.col(f"_old.n{k}") for k, c in enumerate(annotations)}
    return both.withColumns({**notes, "status": status}).drop("_key", "_old")


def indicators(rows: DataFrame, version: str, here: str, there: str) -> DataFrame:
    """One row of what a refresh reports: n_rows, n_new, n_modified, latest version, and n_apart, the rows that are held at
    one of two places and not at the other."""
    held = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("status") == "new").alias("n_new"), F.count_if(F.col("status") == "modified").alias("n_modified"),
        F.max(version).alias("latest"), F.count_if(held(here) != held(there)).alias("n_apart"),
    )
