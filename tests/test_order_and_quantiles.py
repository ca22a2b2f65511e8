import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.operators import quantiles, statistics, windows
from granary.operators.quantiles import exact_quantiles
from granary.sources.files import read_terms
from granary.sources.ingest import PLACE, first_in_order, head_in_order, numbered, ordered_first, read_in_order

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def close(got, expected):
    return np.allclose(got, expected, rtol=1e-12, atol=0)


def values(kind, n, seed=1):
    draw = np.random.default_rng(seed)
    if kind == "ties":  # nine tenths of the rows are one value
        return np.where(draw.random(n) < 0.9, 5.0, draw.integers(0, 9, n).astype(float))
    if kind == "scales":  # many powers of ten
        return draw.choice([-1.0, 1.0], n) * 10.0 ** draw.uniform(-300, 300, n)
    return draw.normal(0, 1, n).round(3)


@pytest.mark.parametrize("kind", ["normal", "ties", "scales"])
def test_quantiles_of_one_large_group(spark, kind):
    v = values(kind, 5000)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    assert close(exact_quantiles(df, "v", FRACTIONS, few=20).first()[0], np.quantile(v, FRACTIONS))
    assert close(exact_quantiles(df, "v", FRACTIONS).first()[0], np.quantile(v, FRACTIONS))


def test_no_task_orders_more_than_a_few_rows(spark, monkeypatch):
    seen, ended = [], quantiles._ended

    def watched(known, ready, keys):
        small = quantiles._inside(known, ready.filter("_found IS NULL"), keys)
        seen.extend(r["n"] for r in small.groupBy(*keys, "_rank").agg(F.count("*").alias("n")).collect())
        return ended(known, ready, keys)

    monkeypatch.setattr(quantiles, "_ended", watched)
    df = spark.createDataFrame([("a", float(x)) for x in values("ties", 3000)], "g string, v double")
    exact_quantiles(df, "v", [0.01, 0.5], ["g"], few=50).collect()
    assert all(n <= 50 for n in seen)


def test_quantiles_of_groups(spark):
    draw = random.Random(2)
    rows = [(g, float(draw.randint(0, 999))) for g, n in (("large", 900), (None, 400), ("small", 7), ("one", 1)) for _ in range(n)]
    rows += [("none", None), ("large", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["q"] for r in exact_quantiles(df, "v", [0.25, 0.5], ["g"], "q", few=100).collect()}
    assert got.pop("none") == [None, None]
    for g, q in got.items():
        assert close(q, np.quantile([v for k, v in rows if k == g and v is not None], [0.25, 0.5])), g
    assert set(got) == {"large", None, "small", "one"}
    empty = df.limit(0)
    assert exact_quantiles(empty, "v", [0.5]).collect() == [([None],)] and exact_quantiles(empty, "v", [0.5], ["g"]).count() == 0
    nan = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double")
    assert exact_quantiles(nan, "v", [0.5]).first()[0] == [2.0]


def test_fences_and_spread_use_them(spark):
    v = values("normal", 300)
    df = spark.createDataFrame([("ab"[k % 2], float(x)) for k, x in enumerate(v)], "g string, v double")
    f = statistics.quartile_fences(df, "v").first()
    q1, q3 = np.quantile(v, [0.25, 0.75])
    assert close([f["q1"], f["q3"], f["low"], f["high"]], [q1, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)])


def test_running_totals_split_rows_of_one_value(spark):
    rows = [(k, 0.0 if k % 10 else float(k), 1) for k in range(4000)] + [(None, None, 1)]
    df = spark.createDataFrame(rows, "k int, v double, one int").repartition(3)
    out = windows.running_totals(df, "v", ["k"], ["one"])
    got = [r[0] for r in out.orderBy("one_so_far").select("k").collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0] or 0))]
    plan = windows.running_totals(df, "v", ["k"], ["one"])
    sizes = [r["count"] for r in plan.groupBy(F.col("one_so_far") > 2000).count().collect()]
    assert sum(sizes) == len(rows)
    parts = df.repartitionByRange(4, "v", "k").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 2000


@pytest.fixture
def lines(spark, tmp_path):
    """Three files of rows whose values don't follow their order."""
    draw, out = random.Random(3), []
    for name, n in (("b", 700), ("a", 300), ("c", 1)):
        own = [(draw.randint(0, 20), draw.randint(0, 10**6)) for _ in range(n)]
        (tmp_path / f"{name}.csv").write_text("k,v\n" + "".join(f"{k},{v}\n" for k, v in own))
        out.append((name, own))
    return str(tmp_path), [x for _, own in sorted(out) for x in own]


@pytest.mark.parametrize("split", ["300", "4000", "128m"])
def test_order_of_text_rows_whatever_the_splits(spark, lines, split):
    path, expected = lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = read_in_order(spark, path, "csv", "k int, v int", header=True)
        assert [tuple(r) for r in numbered(df).orderBy("ordinal").select("ordinal", "k", "v").collect()] == [(i, k, v) for i, (k, v) in enumerate(expected)]
        first = {}
        for k, v in expected:
            first.setdefault(k, v)
        assert {r["k"]: r["v"] for r in first_in_order(df, ["k"]).collect()} == first
        assert [tuple(r)[:2] for r in head_in_order(df, 350).orderBy(PLACE).collect()] == expected[:350]
        known = df.withColumn("v", F.when(F.col("v") % 2 == 0, F.col("v"))).groupBy().agg(ordered_first(F.col("v"))).first()[0]
        assert known == next(v for _, v in expected if v % 2 == 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("split", ["2k", "128m"])
def test_order_of_parquet_rows_whatever_the_splits(spark, tmp_path, split):
    import pyarrow as pa
    import pyarrow.parquet as pq

    draw = np.random.default_rng(4)
    parts = [draw.integers(0, 10**6, n) for n in (1000, 0, 500)]
    for k, v in enumerate(parts):
        pq.write_table(pa.table({"v": v}), tmp_path / f"{k}.parquet", row_group_size=64)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = read_in_order(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 2 or split == "128m"
        assert [r[0] for r in numbered(df).orderBy("ordinal").select("v").collect()] == np.concatenate(parts).tolist()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_terms_from_the_first_place_that_exists(spark, tmp_path):
    (tmp_path / "b.txt").write_text("﻿'Nice',\n\nMenton\n\"Nice\"\n  Grasse ,\n", encoding="utf-8")
    (tmp_path / "c.txt").write_text("other\n")
    found = read_terms(spark, [f"{tmp_path}/{n}.txt" for n in "abc"]).orderBy("place")
    assert [r["term"] for r in found.collect()] == ["Nice", "Menton", "Grasse"]
    with pytest.raises(FileNotFoundError):
        read_terms(spark, [f"{tmp_path}/x.txt"])
