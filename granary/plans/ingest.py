"""Rows in the order of their files: numbers, first ones of each key, and the first ones of all."""

from __future__ import annotations

from granary.plans.catalog import query
from granary.sources.ingest import PLACE, first_in_order, head_in_order, numbered, read_in_order

_NUMBERED = "(SELECT *, row_number() OVER () - 1 AS ordinal FROM lineitem)"


def _lines(spark, sf_dir, *columns):
    return read_in_order(spark, f"{sf_dir}/lineitem.parquet").select(*columns, PLACE)


@query(f"SELECT ordinal, l_orderkey, l_linenumber FROM {_NUMBERED}")
def ingest_ordinal(spark, sf_dir):
    return numbered(_lines(spark, sf_dir, "l_orderkey", "l_linenumber")).select("ordinal", "l_orderkey", "l_linenumber")


@query(f"SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM {_NUMBERED} QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY ordinal) = 1")
def first_line_of_part(spark, sf_dir):
    return first_in_order(_lines(spark, sf_dir, "l_partkey", "l_orderkey", "l_linenumber", "l_quantity"), ["l_partkey"]).drop(PLACE)


@query(f"SELECT l_orderkey, l_linenumber FROM {_NUMBERED} ORDER BY ordinal LIMIT 100")
def first_lines(spark, sf_dir):
    return head_in_order(_lines(spark, sf_dir, "l_orderkey", "l_linenumber"), 100).drop(PLACE)
