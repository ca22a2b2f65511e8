import os
import random

import pytest
from pyspark.sql import functions as F

from granary.sources import sinks

SCHEMA = "city string, at int, v int"


def files(path):
    """Time stamps of data files by partition."""
    out = {}
    for top, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet") and "_staged" not in top:
                out.setdefault(os.path.basename(top), {})[n] = os.stat(os.path.join(top, n)).st_mtime_ns
    return out


def rows(spark, path):
    return sorted(map(tuple, sinks.read_partitions(spark, path).collect()), key=repr)


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "w")
    first = [(f"c{k}", k, k) for k in range(200)]
    assert len(sinks.upsert_partitions(spark, path, spark.createDataFrame(first, SCHEMA), ["city", "at"], parts=8)) == 8
    before = files(path)
    touched = sinks.upsert_partitions(spark, path, spark.createDataFrame([("c7", 7, 70), ("new", 1, 1)], SCHEMA), ["city", "at"])
    after = files(path)
    assert 1 <= len(touched) <= 2 and set(after) == set(before)
    for part in before:
        assert (before[part] == after[part]) == (int(part.removeprefix("_part=")) not in touched)
    expected = {(c, at): v for c, at, v in first} | {("c7", 7): 70, ("new", 1): 1}
    assert rows(spark, path) == sorted(((c, at, v) for (c, at), v in expected.items()), key=repr)
    assert not os.path.exists(f"{path}/_staged")


def test_many_batches_equal_a_dictionary(spark, tmp_path):
    path, known, draw = str(tmp_path / "w"), {}, random.Random(1)
    for step in range(4):
        batch = [(f"c{draw.randint(0, 30)}", draw.randint(0, 3), 100 * step + k) for k in range(40)]
        sinks.upsert_partitions(spark, path, spark.createDataFrame(batch, SCHEMA), ["city", "at"], order="v", parts=4)
        known |= {(c, at): v for c, at, v in batch}
        assert rows(spark, path) == sorted(((c, at, v) for (c, at), v in known.items()), key=repr)


def test_repeated_keys_need_an_order_and_null_keys_stay(spark, tmp_path):
    path = str(tmp_path / "w")
    twice = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), (None, 1, 3), (None, 1, 4)], SCHEMA)
    with pytest.raises(ValueError, match="orders them"):
        sinks.upsert_partitions(spark, path, twice, ["city", "at"])
    sinks.upsert_partitions(spark, path, twice, ["city", "at"], order="v")
    sinks.upsert_partitions(spark, path, spark.createDataFrame([(None, 1, 5)], SCHEMA), ["city", "at"])
    assert rows(spark, path) == sorted([("a", 1, 2), (None, 1, 3), (None, 1, 4), (None, 1, 5)], key=repr)


def test_a_run_that_died_is_ended_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "w")
    df = lambda *r: spark.createDataFrame(r, SCHEMA)
    sinks.upsert_partitions(spark, path, df(("a", 1, 1), ("b", 1, 1)), ["city", "at"], parts=2)
    put = sinks._replace_partitions

    def dies(*args):
        raise OSError("gone")

    monkeypatch.setattr(sinks, "_replace_partitions", dies)
    with pytest.raises(OSError):
        sinks.upsert_partitions(spark, path, df(("a", 1, 2)), ["city", "at"])
    assert rows(spark, path) == [("a", 1, 1), ("b", 1, 1)]  # the table is still there
    monkeypatch.setattr(sinks, "_replace_partitions", put)
    sinks.upsert_partitions(spark, path, df(("c", 1, 3)), ["city", "at"])
    assert rows(spark, path) == [("a", 1, 2), ("b", 1, 1), ("c", 1, 3)]


def test_swap_of_a_small_table_is_ended_too(spark, tmp_path):
    path = str(tmp_path / "w")
    spark.createDataFrame([("a", 1, 1)], SCHEMA).write.parquet(f"{path}.staged")  # what a run left between two renames
    sinks.upsert_parquet(spark, path, spark.createDataFrame([("b", 1, 2)], SCHEMA), ["city", "at"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1, 1), ("b", 1, 2)]


def test_extra_partitions_of_a_large_batch(spark, tmp_path):
    path = str(tmp_path / "w")
    many = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("city"), F.lit(1).alias("at"), F.col("id").cast("int").alias("v"))
    sinks.upsert_partitions(spark, path, many, ["city", "at"], parts=4)
    sinks.upsert_partitions(spark, path, many.withColumn("v", F.col("v") + 1), ["city", "at"])
    assert sinks.read_partitions(spark, path).agg(F.count("*"), F.sum("v"), F.count_distinct("city")).first()[:] == (5000, sum(range(1, 5001)), 5000)
