from pyspark.sql import functions as F

from granary.operators import quantiles
from granary.operators.quantiles import exact_quantiles


def test_rounds_sort_no_rows(spark):
    """Bounds that ride along with each row in an aggregate would make Spark sort all rows; so would sketches of many groups."""
    known = spark.range(3000).select((F.col("id") % 3).alias("_k0"), F.col("id").cast("double").alias("_v"))
    ranks = spark.range(3).selectExpr("id AS _k0", "500L AS _rank", "0L AS _before", "1000L AS _inside", "cast(null AS double) AS _low", "cast(null AS double) AS _high", "cast(null AS double) AS _found")
    found = quantiles._narrowed(known, ranks, ["_k0"])
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    for r in found.collect():
        assert r["_rank"] == 500 and r["_before"] <= 500 < r["_before"] + r["_inside"] < 1000


def test_many_large_groups(spark):
    df = spark.range(40_000).select((F.col("id") % 200).alias("g"), (F.hash("id") % 1000).cast("double").alias("v"))
    got = {r["g"]: r["q"] for r in exact_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"], "q", few=50).collect()}
    expected = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.9]).alias("q")).collect()}
    assert got == expected
