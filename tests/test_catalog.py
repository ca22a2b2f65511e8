import math
import os

import duckdb
import pandas as pd
import pytest

from granary.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "isoformat"):
        return str(pd.Timestamp(value))
    return str(value) if isinstance(value, str) else round(float(value), 6) + 0.0


def rows(df):
    df = df[sorted(df.columns)]
    return sorted([tuple(map(plain, r)) for r in df.itertuples(index=False, name=None)], key=repr)


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SF_DIR):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    expected = db.execute(catalog.oracle_sql()[name]).df()
    got = catalog.queries()[name](spark, SF_DIR).toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


@needs_data
@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, SF_DIR).count() > 0


@needs_data
def test_scans_read_only_what_they_need(spark):
    plan = catalog.queries()["filter_predicates"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan or "PushedFilters" in plan
    assert "l_extendedprice" not in plan
