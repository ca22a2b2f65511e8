import pytest
from pyspark.sql import functions as F

from granary.functions import isbn
from granary.functions.once import computed, once
from granary.plans.catalog import dealt, queries


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_value_read_often_is_computed_once(spark):
    df = spark.createDataFrame([("9780306406157",), (None,), ("x",)], "c string")
    assert [r[0] for r in df.select(once(F.upper("c"), lambda v: F.concat(v, v))).collect()] == ["97803064061579780306406157", None, "XX"]
    assert plan(df.select(once(F.upper("c"), lambda v: F.concat(v, v)).alias("y"))).count("upper(") == 1


@pytest.mark.parametrize("made", [isbn.is_isbn10, isbn.is_isbn13, isbn.isbn10_to_13, isbn.isbn13_to_10, isbn.search_forms, isbn.normalize_isbn])
def test_numbers_read_their_code_once(spark, made):
    df = spark.createDataFrame([("2-07-036002-4",)], "c string")
    assert plan(df.select(made(F.reverse("c")).alias("y"))).count("reverse(") == 1


def _copies(spark, tmp_path, n):
    part = spark.range(n).select(F.col("id").alias("p_partkey"), F.concat(F.lit("red "), "id").alias("p_name"), F.lit("Brand#12").alias("p_brand"), F.lit("PROMO").alias("p_type"), F.lit(3).alias("p_size"))
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_rows_of_a_small_file_are_dealt(spark, tmp_path):
    path = _copies(spark, tmp_path, 1000)
    df = dealt(spark, path, "part", 300)
    sizes = [len(p) for p in df.rdd.glom().collect()]
    assert len(sizes) == 4 and max(sizes) <= 300 and sum(sizes) == 1000
    assert dealt(spark, path, "part", 1000).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("name", ["hybrid_record_index", "local_records", "author_search_notices", "isbn13_to_10", "isbn_modes"])
def test_work_on_a_row_comes_after_dealing(spark, tmp_path, name):
    """No filter takes the costly columns below the exchange, back to the tasks that read the file."""
    df = queries()[name](spark, _copies(spark, tmp_path, 20_001))
    below = plan(df).split("Repartition 2", 1)[1]
    assert "from_xml" not in below and "xmltostructs" not in below.lower() and "transform(" not in below and "aggregate(" not in below
    assert plan(df).lower().count("xmltostructs") <= 1 and plan(df).count("from_xml") <= 1


def test_computed_columns_keep_filters_above(spark):
    df = computed(spark.range(3), v=F.col("id") * 2).filter("v > 1 AND v < 4")
    assert [tuple(r) for r in df.collect()] == [(1, 2)] and plan(df).count("* 2") == 1
