"""What a task holds must not grow with the table."""

from pyspark.sql import functions as F

from granary.operators import fits, records
from granary.operators.rank_matrix import rank_correlations
from granary.plans import catalog, reports
from granary.sources.ingest import numbered, read_in_order


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbered_rows_of_one_file_are_not_sent_to_one_task(spark, tmp_path):
    spark.range(50).coalesce(1).write.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = numbered(read_in_order(spark, f"{tmp_path}/t"))
        assert "SortMergeJoin" not in executed(out) and out.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_united_rows_are_dealt_before_they_are_compared(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("a"), F.lit(None).cast("long").alias("b"))
    out = records.united_relations({"x": df, "y": df}, "r", 7)
    below = executed(out).split("REPARTITION_BY_NUM", 1)[1]  # of the plan before it runs
    assert "HashAggregate" not in below
    assert out.rdd.getNumPartitions() == 7 and out.count() == 20
    assert records.united_relations({"x": df, "y": df}, "r").count() == 20


def test_orders_are_not_collected_by_month(spark):
    found = catalog.queries()["monthly_revenue_by_category"](spark, "/root/testdata/sf0.001")
    plan = executed(found)
    assert "REPARTITION_BY_NUM" in plan and "distinct" not in plan.lower()


def test_points_and_profiles_are_computed_once(spark, monkeypatch):
    kept, reads = [], spark.sparkContext.accumulator(0)
    for module in (fits, reports):
        monkeypatch.setattr(module, "stored", lambda df, label, own=module.stored: kept.append(label) or own(df, label))

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    df = spark.range(101).select(F.col("id").cast("double").alias("x"), (2 * F.col("id") + F.col("id") % 3).cast("double").alias("y"))
    fits.huber_line(df.mapInPandas(seen, df.schema), "x", "y", rounds=3, tolerance=0.0)
    assert kept == ["points"] and reads.value == 101
    catalog.queries()["target_nations"](spark, "/root/testdata/sf0.001")
    assert kept == ["points", "profiles"]


def test_equal_rows_are_counted_before_they_are_taken_apart(spark, monkeypatch):
    plans = []
    from granary.operators import rank_matrix

    monkeypatch.setattr(rank_matrix, "stored", lambda df, label, own=rank_matrix.stored: plans.append(executed(df)) or own(df, label))
    df = spark.range(60).select((F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"))
    row = rank_correlations(df, ["a", "b"]).first()
    assert row["n"] == 60 and "HashAggregate" in plans[0].split("Generate", 1)[1]
