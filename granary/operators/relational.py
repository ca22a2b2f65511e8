"""Cleaning, joining and deduplicating as DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def scaled(df: DataFrame, factor: float, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c) * factor for c in columns})


def clamped(column: Column, low: float | None = None, high: float | None = None) -> Column:
    """Nulls stay null."""
    out = column
    if low is not None:
        out = F.when(column < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(column > high, F.lit(high)).otherwise(out)
    return out


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """A number over zero is 0, zero over zero is null."""
    return F.when(bottom == 0, F.when(top != 0, F.lit(0.0))).otherwise(top / F.nullif(bottom, F.lit(0)))


def filled_if_blank(column: Column, other: Column) -> Column:
    return F.coalesce(F.when(F.trim(column) != "", column), other)


def profile(df: DataFrame) -> DataFrame:
    """A row for each column: values that are not null, distinct ones, share of nulls; one pass."""
    columns = df.columns
    stats = [F.struct(F.count(F.col(c)).alias("present"), F.count_distinct(F.col(c)).alias("distinct")).alias(c) for c in columns]
    row = df.agg(F.count("*").alias("_n"), *stats)
    each = F.explode(
        F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"{c}.present"), F.col(f"{c}.distinct")) for c in columns))
    )
    return row.select("_n", each.alias("s")).select(
        "s.column", "s.present", "s.distinct", F.when(F.col("_n") > 0, 1 - F.col("s.present") / F.col("_n")).alias("null_share")
    )


def marked_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join with a column _merge: both or left_only."""
    marked = right.withColumn("_found", F.lit(True))
    joined = left.join(marked, keys, "left")
    return joined.withColumn("_merge", F.when(F.col("_found"), "both").otherwise("left_only")).drop("_found")


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key by order, which should be total."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def fused(sources: dict[str, DataFrame], name: str = "source") -> DataFrame:
    """Rows of all sources, tagged by name, columns united, exact repeats dropped."""
    out = None
    for tag, df in sources.items():
        own = df.withColumn(name, F.lit(tag))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sources")
    return out.distinct()


def deduplicated_if_known(df: DataFrame, known: str, keys: Sequence[str], preferred: Column, *order: Column) -> DataFrame:
    """Rows whose ``known`` is empty all stay; of the rest one for each key, preferred ones first."""
    has = F.coalesce(F.trim(F.col(known)) != "", F.lit(False))
    rest = first_per_key(df.filter(has), keys, F.when(preferred, 0).otherwise(1), *order)
    return rest.unionByName(df.filter(~has))


def absent_from(searched: DataFrame, present: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Rows whose key was searched, not found, and not lost to an error; rows without a key drop out."""
    seen = present.select(key).unionByName(failed.select(key)).distinct()
    return searched.filter(F.col(key).isNotNull()).join(seen, key, "left_anti")


def matched_if_unique(wanted: DataFrame, known: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Adds id_column where exactly one id of known has the keys, and a status: FOUND, AMBIGUOUS or NOT_FOUND."""
    ids = known.groupBy(*keys).agg(F.count_distinct(id_column).alias("_n"), F.min(id_column).alias("_id"))
    n = F.coalesce("_n", F.lit(0))
    return wanted.join(ids, keys, "left").select(
        *wanted.columns,
        F.when(n == 1, F.col("_id")).alias(id_column),
        F.when(n == 1, "FOUND").when(n > 1, "AMBIGUOUS").otherwise("NOT_FOUND").alias("status"),
    )


def compared_snapshots(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Every key with a status: new, removed, modified or unchanged by its version."""
    a, b = old.select(key, F.col(version).alias("_old")), new.select(key, F.col(version).alias("_new"))
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), key, "full")
    status = (
        F.when(F.col("_a").isNull(), "new")
        .when(F.col("_b").isNull(), "removed")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("modified")
    )
    return both.select(key, status.alias("status"))


def upserted(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing with the rows of new in place of those with the same keys."""
    return existing.join(new, keys, "left_anti").unionByName(new)


def renamed(df: DataFrame, variants: dict[str, str]) -> DataFrame:
    """Columns under their canonical names; where several spellings of one are there, the first value that is known."""
    out: dict[str, list[Column]] = {}
    for c in df.columns:
        out.setdefault(variants.get(c, c), []).append(F.col(f"`{c}`"))
    own_first = lambda name, cols: sorted(cols, key=lambda c: str(c) != str(F.col(f"`{name}`")))
    return df.select(*(F.coalesce(*own_first(name, cols)).alias(name) for name, cols in out.items()))


def harmonized(df: DataFrame, kinds: dict[str, str], trimmed: Sequence[str] = ()) -> DataFrame:
    """Columns that are there cast to kinds; whole numbers are read from text with decimals too, what is no number is null."""
    out = {}
    for name, kind in kinds.items():
        if name in df.columns:
            c = F.col(name)
            c = c.cast("string").try_cast("double").cast("long") if kind == "long" else c.try_cast(kind)
            out[name] = F.trim(c) if name in trimmed else c
    return df.withColumns(out) if out else df


def ordered_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The columns of ``first`` that are there, in that order, then the others in theirs."""
    return df.select(*[c for c in first if c in df.columns], *[c for c in df.columns if c not in first])


def with_defaults(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """df with a constant column for each name that it lacks."""
    return df.withColumns({k: F.lit(v) for k, v in values.items() if k not in df.columns})


def mapped(column: Column, labels: dict[object, object], otherwise: Column | None = None) -> Column:
    """The label of each value; ``otherwise`` (null) for a value without one."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), column)
    return found if otherwise is None else F.coalesce(found, otherwise)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def first_seen_joined(df: DataFrame, keys: list[str], value: str, order: str, sep: str = " | ") -> DataFrame:
    """For each key its distinct values in the order in which they come first, joined.

    A value's first place is found before values are gathered, so that a key gathers each value once.
    """
    seen = df.filter(F.trim(value) != "").groupBy(*keys, F.trim(value).alias("_v")).agg(F.min(order).alias("_o"))
    places = F.array_sort(F.collect_list(F.struct("_o", "_v")))
    return seen.groupBy(*keys).agg(F.array_join(F.transform(places, lambda x: x["_v"]), sep).alias(value))


def labels_of_extremes(df: DataFrame, label: str, values: Sequence[str]) -> DataFrame:
    """One row: for each of values the labels of its greatest and least rows, the smallest label of equal ones."""
    both = []
    for v in values:
        known = lambda rank, v=v: F.when(F.col(v).isNotNull(), F.struct(rank, F.col(label)))
        both += [F.min(known(-F.col(v)))[label].alias(f"{v}_most"), F.min(known(F.col(v)))[label].alias(f"{v}_least")]
    return df.agg(*both)
