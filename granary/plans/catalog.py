"""Registered queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function (spark, sf_dir) -> DataFrame under its own name, with its SQL."""

    def put(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(df: DataFrame, rows: int) -> int:
    """How many tasks a table needs if each takes so many rows; of a file's table Spark counts the footers."""
    return max(1, -(-df.count() // rows))


def dealt(spark: SparkSession, sf_dir: str, name: str, rows: int = 20_000) -> DataFrame:
    """A table for much work on each row: so many rows a task at most, or so, whatever the bytes of its files.

    Spark cuts files by bytes, and not within a row group, so that a small file of many rows would be a task or two.
    """
    df = table(spark, sf_dir, name)
    parts = tasks_for(df, rows)
    return df.repartition(parts) if parts > 1 else df


def _load() -> None:
    from granary.plans import bibliography, catalogues, cleaning, ingest, reports, sales, texts  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
