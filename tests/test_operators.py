import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from granary.operators import multivariate, records, relational, statistics, windows
from granary.operators.quality import QualityError, check, gate_counts


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_ratio_and_clamp(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 1.0, 0.0), (2, 0.0, 0.0), (3, None, 1.0)], "i int, a double, b double")
    assert rows(df.select("i", relational.ratio_or_zero(F.col("a"), F.col("b")).alias("r"))) == [(0, 0.5), (1, 0.0), (2, None), (3, None)]
    assert rows(df.select("i", relational.clamped(F.col("b"), 0.5, 1.5)), "i")[0] == (0, 1.5)


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (1, "a")], "x int, y string")
    assert rows(relational.profile(df), "column") == [("x", 2, 1, 0.0), ("y", 1, 1, 0.5)]


def test_joins_and_dedup(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, 5)], "k int, w int")
    assert rows(relational.marked_left_join(a, b, ["k"])) == [(1, "x", None, "left_only"), (2, "y", 5, "both")]
    both = relational.fused({"A": a, "B": b})
    assert sorted(both.columns) == ["k", "source", "v", "w"] and both.count() == 3
    df = spark.createDataFrame([(None, "i", "X", 1), (None, "i", "X", 2), ("p", "i", "X", 3), ("p", "i", "NZ", 4)], "p string, i string, s string, o int")
    kept = relational.deduplicated_if_known(df, "p", ["p", "i"], F.col("s") == "NZ", F.col("o"))
    assert sorted(r.o for r in kept.collect()) == [1, 2, 4]
    assert rows(relational.absent_from(a.select("k"), b.select("k"), b.select("k").limit(0), "k")) == [(1,)]
    known = spark.createDataFrame([("d", 1), ("e", 2), ("e", 3)], "name string, id int")
    wanted = spark.createDataFrame([("d",), ("e",), ("f",)], "name string")
    assert rows(relational.matched_if_unique(wanted, known, ["name"], "id")) == [("d", 1, "FOUND"), ("e", None, "AMBIGUOUS"), ("f", None, "NOT_FOUND")]
    old, new = (spark.createDataFrame(r, "k int, v int") for r in ([(1, 1), (2, 2), (3, 3)], [(2, 2), (3, 4), (5, 5)]))
    assert rows(relational.compared_snapshots(old, new, "k", "v")) == [(1, "removed"), (2, "unchanged"), (3, "modified"), (5, "new")]
    assert rows(relational.upserted(old, new, ["k"])) == [(1, 1), (2, 2), (3, 4), (5, 5)]


def test_windows(spark):
    df = spark.createDataFrame([(k, float(k)) for k in range(1, 6)], "k int, v double")
    assert [r[-1] for r in rows(windows.rolling_mean(df, "v", [F.col("k")], 3, "m"), "k")] == [None, None, 2.0, 3.0, 4.0]
    curve = rows(windows.lorenz(df, "k", "v"), "share_of_keys")
    assert curve[-1][1:] == (1.0, 1.0) and all(a[2] <= b[2] for a, b in zip(curve, curve[1:]))
    assert rows(windows.pareto(df, "k", "v", 60).select("k")) == [(4,), (5,)]


def test_statistics(spark):
    a, b = [1.0, 2.0, 2.0, 3.0, 9.0], [4.0, 5.0, 6.0, 7.0, 2.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, v double")
    u = statistics.mann_whitney(df, "v", "g", "a", "b")
    assert u.statistic == sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert statistics.kruskal(df, "v", "g").statistic == pytest.approx(1.7, abs=0.5)
    da, db = ([abs(x - np.median(g)) for x in g] for g in (a, b))
    m, ma, mb = np.mean(da + db), np.mean(da), np.mean(db)
    within = sum((x - ma) ** 2 for x in da) + sum((x - mb) ** 2 for x in db)
    assert statistics.levene(df, "v", "g").statistic == pytest.approx(8 * 5 * ((ma - m) ** 2 + (mb - m) ** 2) / within)
    pair = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 9.0), (4.0, 8.0)], "x double, y double")
    assert statistics.spearman(pair, "x", "y").statistic == pytest.approx(0.8)
    two = spark.createDataFrame([("x", "p")] * 10 + [("x", "q")] * 20 + [("y", "p")] * 30 + [("y", "q")] * 5, "a string, b string")
    r = statistics.chi_square(two, "a", "b")
    cells, n = np.array([[10, 20], [30, 5]]), 65
    e = cells.sum(1, keepdims=True) * cells.sum(0) / n
    assert r.statistic == pytest.approx((((abs(cells - e) - 0.5) ** 2) / e).sum()) and r.freedom == 1
    k = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 3, 10)], "v double").agg(statistics.unbiased_kurtosis("v")).first()[0]
    assert k == pytest.approx(pd.Series([1, 2, 2, 3, 10.0]).kurt())


def test_multivariate(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 1)) @ np.array([[1.0, 2.0, -1.0]]) + rng.normal(size=(60, 3)) * 0.1
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    scored, shares, axes = multivariate.principal_components(df, ["a", "b", "c"], 2)
    assert shares[0] > 0.95 and axes[np.abs(axes[:, 0]).argmax(), 0] > 0 and {"F1", "F2"} <= set(scored.columns)
    costs = multivariate.elbow(multivariate.assembled(df, ["a", "b", "c"]), 3, 1)
    assert [k for k, _ in costs] == [1, 2, 3] and costs[0][1] == pytest.approx(180) and costs[1][1] < costs[0][1]
    points = np.array([[0.0, 0], [0, 1], [10, 0], [10, 1], [50, 50]])
    assert multivariate.ward_clusters(points, 5) == [0, 0, 1, 1, 2]


def test_gate(spark):
    df = spark.createDataFrame([("g", 1, 10.0), ("g", 1, 75.0), ("h", 2, None)], "city string, at int, t double")
    counts = gate_counts(df, ["city", "at"], ["t"], {"t": (-60, 60)}).first()
    assert tuple(counts) == (3, 1, 1, 1)
    with pytest.raises(QualityError):
        check(df, ["city", "at"], ["t"], {"t": (-60, 60)})
    assert check(df.limit(0), ["city", "at"], ["t"], {}).count() == 0


def test_running_totals_over_ranges(spark):
    draw = np.random.default_rng(4)
    values = [float(v) for v in draw.integers(0, 40, 300)] + [None] * 3
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double").withColumn("one", F.lit(1))
    got = {r.k: r.one_so_far for r in windows.running_totals(df, "v", ["k"], ["one"], ranges=7).collect()}
    order = sorted(range(len(values)), key=lambda k: (values[k] is not None, values[k] or 0, k))
    assert got == {k: i + 1 for i, k in enumerate(order)}
    assert windows.running_totals(df.limit(0), "v", ["k"], ["one"]).count() == 0
    ranks = {r.k: r.r for r in windows.with_average_rank(df, "v", "r").collect()}
    assert [ranks[k] for k in range(300)] == pd.Series(values[:300]).rank().tolist() and ranks[300] is None


def test_pairwise_tests_equal_single_ones(spark):
    draw = np.random.default_rng(5)
    rows_ = [(g, float(v)) for g in "abc" for v in draw.integers(0, 9, 30)] + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows_, "g string, v double")
    for a, b, r, p in statistics.pairwise_mann_whitney(df, "v", "g"):
        x, y = ([v for g, v in rows_ if g == k and v is not None] for k in (a, b))
        assert r.statistic == sum((i > j) + 0.5 * (i == j) for i in x for j in y) and p == 3 * r.p_value
        single = statistics.mann_whitney(df, "v", "g", a, b)
        assert (r.statistic, r.p_value) == (single.statistic, single.p_value)
    assert statistics.pairwise_mann_whitney(df.filter("g = 'a'"), "v", "g") == []


def test_loops_do_not_end_silently(spark):
    chain = spark.createDataFrame([(k + 1, k) for k in range(6)], "place long, parent long")
    assert records.place_closure(chain, 0).count() == 7
    with pytest.raises(RuntimeError):
        records.place_closure(chain, 0, depth=4)


def test_columns_of_several_spellings(spark):
    df = spark.createDataFrame([(None, "x", " 7.9 "), ("y", "z", "n")], "a string, A2 string, n string")
    out = relational.renamed(df, {"A2": "a"})
    assert rows(relational.harmonized(out, {"n": "long"}), "n") == [("y", None), ("x", 7)]
    assert relational.numeric_columns(relational.harmonized(out, {"n": "long"})) == ["n"]
