"""Record fusion: identifiers with sets of reasons, links over place hierarchies, decisions and their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import SEPARATOR, sorted_distinct
from granary.stored import dropped, stored


def merged_by_id(df: DataFrame, id_column: str, sets: list[str], firsts: list[str], order: str) -> DataFrame:
    """One row for each id: sorted distinct values of ``sets`` joined, and of ``firsts`` the first known one by order."""
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in firsts]
    return df.groupBy(id_column).agg(*(sorted_distinct(F.col(c)).alias(c) for c in sets), *first)


def united_relations(relations: dict[str, DataFrame], name: str, parts: int | None = None) -> DataFrame:
    """Distinct rows of several link tables, each tagged with its relation.

    With parts, rows are dealt to so many tasks by what they hold before any is compared, so that a task keeps its share
    alone; else Spark compares them where they are read, and once more by compressed bytes.
    """
    out = None
    for tag, df in relations.items():
        own = df.withColumn(name, F.lit(tag))
        out = own if out is None else out.unionByName(own)
    return (out.repartition(parts, *out.columns) if parts else out).distinct()


def wide_values(df: DataFrame, id_column: str, kind: str, value: str, kinds: list[str]) -> DataFrame:
    """A column for each kind with its distinct values sorted and joined; null where there are none."""
    joined = F.array_join(F.array_sort(F.collect_set(value)), SEPARATOR)
    wide = df.groupBy(id_column).pivot(kind, kinds).agg(joined)
    return wide.select(id_column, *(F.nullif(F.col(k), F.lit("")).alias(k) for k in kinds))


def place_closure(parents: DataFrame, root: int, depth: int = 60) -> DataFrame:
    """(place) for root and everything below it in (place, parent), by repeated joins until nothing is new.

    The frontier alone is joined in each round. It and what is found are stored, so that a round neither runs those
    before it again nor unites all of them; the tables before are deleted. A hierarchy of more than ``depth`` levels
    raises an error.
    """
    frontier = parents.sparkSession.createDataFrame([(root,)], "place long")
    found = stored(frontier, "places")
    for _ in range(depth):
        above = frontier.withColumnRenamed("place", "parent")
        below = parents.join(above, "parent", "left_semi").select("place").distinct()
        last, frontier = frontier, stored(below.join(found, "place", "left_anti"), "frontier")
        if frontier.isEmpty():
            dropped(last, frontier)
            return found
        found, before = stored(found.unionByName(frontier), "places"), found
        dropped(last, before)
    raise RuntimeError(f"more than {depth} levels below {root}")


def record_class(search: Column, reasons: Column) -> Column:
    """Author by default; local works; legal deposit for local works published here."""
    local = F.coalesce(search == "local", F.lit(False))
    here = F.coalesce(F.lower(reasons).contains("place_of_publication"), F.lit(False))
    return F.when(local & here, "legal deposit").when(local, "local").otherwise("author")


def split_decisions(decided: DataFrame, key: str, decision: str) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, distinct keys decided against): an exclusion history grows by the second."""
    no = F.coalesce(F.lower(F.trim(F.col(decision))).isin("no", "non"), F.lit(False))
    return decided.filter(~no), decided.filter(no & F.col(key).isNotNull()).select(key).distinct()


def without_excluded(df: DataFrame, history: DataFrame, key: Column, history_key: str) -> DataFrame:
    """Rows whose effective key is not in history; rows without a key stay."""
    marked = df.withColumn("_key", key)
    return marked.join(history.select(F.col(history_key).alias("_key")).distinct(), "_key", "left_anti").drop("_key")


def pairs_of(df: DataFrame, people: str, numbers: str) -> DataFrame:
    """A row for each person and number of a record; records without a person keep one row with null."""
    each = df.withColumn(people, F.explode_outer(people))
    return each.withColumn(numbers, F.explode(numbers))
