import itertools
import math
import random
import time
from statistics import NormalDist

import duckdb
import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from granary.functions import special
from granary.functions.normal import inverse_normal
from granary.operators import fits, multivariate, statistics
from granary.operators.rank_matrix import rank_correlations
from granary.plans import catalog


def test_inverse_normal(spark):
    p = [1e-300, 1e-20, 1e-12, 1e-6, 0.01, 0.07, 0.075, 0.3, 0.5, 0.9, 0.925, 0.99, 1 - 1e-9]
    df = spark.createDataFrame([(x,) for x in p] + [(0.0,), (1.0,), (-1.0,), (None,)], "p double")
    got = [r[0] for r in df.select(inverse_normal(F.col("p"))).collect()]
    assert np.allclose(got[: len(p)], [NormalDist().inv_cdf(x) for x in p], rtol=1e-12) and got[len(p) :] == [None] * 4


def test_quantile_pairs_and_bins(spark):
    draw = random.Random(1)
    v = [round(draw.gauss(5, 2), 1) for _ in range(200)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(v)] + [(900, None)], "k int, v double")
    got = [tuple(r) for r in fits.quantile_pairs(df, "v", "k").orderBy("v", "k").collect()]
    order = sorted(range(200), key=lambda k: (v[k], k))
    mean, deviation = np.mean(v), np.std(v)
    for i, (k, value, z, line) in enumerate(got):
        expected = NormalDist().inv_cdf((i + 1) / 201)
        assert (k, value) == (order[i], v[order[i]]) and math.isclose(z, expected, abs_tol=1e-12) and math.isclose(line, mean + deviation * expected)
    density, edges = np.histogram(v, 10, density=True)
    bins = fits.density_bins(df, "v").orderBy("bin").collect()
    assert np.allclose([r["density"] for r in bins], density) and np.allclose([r["low"] for r in bins], edges[:-1])
    assert np.allclose([r["fitted"] for r in bins], [NormalDist(mean, deviation).pdf(x) for x in (edges[1:] + edges[:-1]) / 2])
    assert fits.density_bins(df.filter("k = 1"), "v").count() == 0 and fits.density_bins(df.limit(0), "v").count() == 0


def plain_huber(x, y, rounds):
    w, scale = np.ones(len(x)), None
    for k in range(rounds + 1):
        b, a = np.polyfit(x, y, 1, w=np.sqrt(w))
        if k == rounds:
            return a, b, scale
        r = np.abs(y - (a + b * x))
        scale = np.median(r) / 0.6744897501960817
        w = np.minimum(1, 1.345 * scale / np.maximum(r, 1e-300))


def test_robust_line(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(0, 3, 120)
    y = 2 * x + 1 + draw.normal(0, 0.1, 120)
    y[:15] += 50  # outliers
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)] + [(1.0, None), (None, 1.0)], "x double, y double")
    line = fits.huber_line(df, "x", "y", rounds=3, tolerance=0.0)
    assert np.allclose([line.intercept, line.slope, line.scale], plain_huber(x, y, 3)) and line.rounds == 3
    settled = fits.huber_line(df, "x", "y", rounds=30)
    assert settled.rounds < 30 and abs(settled.slope - 2) < 0.05
    exact = spark.createDataFrame([(float(k), 3.0 * k) for k in range(9)], "x double, y double")
    assert fits.huber_line(exact, "x", "y").slope == pytest.approx(3)
    with pytest.raises(ValueError):
        fits.huber_line(exact.filter("x = 1"), "x", "y")
    with pytest.raises(ValueError):
        fits.huber_line(exact.limit(0), "x", "y")


def ranks(v):
    return np.array([(sum(x < y for x in v) + sum(x <= y for x in v) + 1) / 2 for y in v])


def test_rank_matrix_is_complete_by_pairs(spark):
    draw = random.Random(3)
    rows = [(draw.randint(0, 5), draw.gauss(0, 1), draw.choice([None, 1.0, 2.0, 3.0]), draw.choice([None, draw.random()]), None, 7) for _ in range(150)]
    names = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, "a int, b double, c double, d double, e double, f int")
    got = {(r["x"], r["y"]): r for r in rank_correlations(df, names).collect()}
    assert list(got) == list(itertools.combinations(names, 2))
    for (x, y), r in got.items():
        both = [(row[names.index(x)], row[names.index(y)]) for row in rows if row[names.index(x)] is not None and row[names.index(y)] is not None]
        assert r["n"] == len(both)
        if "e" in (x, y) or "f" in (x, y):
            assert r["rho"] is None and r["p"] is None
        else:
            expected = np.corrcoef(*(ranks(side) for side in zip(*both, strict=True)))[0, 1]
            assert r["rho"] == pytest.approx(expected) and 0 <= r["p"] <= 1
    assert got["a", "b"]["p"] == pytest.approx(statistics.spearman(df, "a", "b").p_value)


def test_exact_tail_counts_orders():
    for a, b in ((1, 1), (2, 3), (4, 4), (3, 6)):
        sums = [sum(c) - a * (a - 1) // 2 for c in itertools.combinations(range(a + b), a)]
        for u in range(-1, a * b + 2):
            assert special.rank_sum_tail(u, a, b) == pytest.approx(sum(s >= u for s in sums) / len(sums))
    assert special.rank_sum_tail(0, 8, 1000) == 1.0


def test_few_values_without_ties_are_tested_exactly(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3)] + [("b", float(x)) for x in (4, 5, 6, 7)], "g string, v double")
    assert statistics.mann_whitney(df, "v", "g", "a", "b").p_value == pytest.approx(2 / 35)
    many = spark.createDataFrame([(str(k), 1.0) for k in range(statistics.MOST_GROUPS + 1)], "g string, v double")
    with pytest.raises(ValueError, match="groups"):
        statistics.pairwise_mann_whitney(many, "v", "g")


def plain_ward(points, distance):
    """Joins the two clusters of least height again and again."""
    own = [[k] for k in range(len(points))]
    while len(own) > 1:
        pairs = []
        for i, j in itertools.combinations(range(len(own)), 2):
            a, b = points[own[i]], points[own[j]]
            pairs.append((math.sqrt(2 * len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()), i, j))
        height, i, j = min(pairs)
        if height > distance:
            break
        own[i] += own.pop(j)
    return sorted(map(sorted, own))


def test_ward_equals_the_plain_method_on_many_sets():
    for seed in range(200):
        draw = np.random.default_rng(seed)
        points = draw.normal(0, 1, (draw.integers(1, 16), 2))
        cut = float(draw.uniform(0, 4))
        labels = multivariate.ward_clusters(points, cut)
        groups = sorted([k for k, x in enumerate(labels) if x == c] for c in set(labels))
        assert groups == plain_ward(points, cut)
        assert list(dict.fromkeys(labels)) == list(range(len(set(labels))))


def test_ward_heights_sizes_and_time():
    points = np.random.default_rng(1).normal(0, 1, (5000, 3))
    began = time.process_time()
    links = multivariate.ward_linkage(points)
    assert time.process_time() - began < 20
    assert (np.diff(links[:, 2]) >= 0).all() and links[-1, 3] == 5000
    root, *others = multivariate.top_levels(links, 3)
    assert root[1:] == (0, None, links[-1, 2], 5000) and max(x[1] for x in others) <= 3
    assert sum(x[4] for x in others if x[1] == 1) == 5000
    with pytest.raises(ValueError):
        multivariate.ward_linkage(np.zeros((20, 1)), most=10)
    assert multivariate.ward_clusters(np.zeros((3, 2)), 0.0) == [0, 0, 0] and multivariate.ward_clusters(np.zeros((1, 2)), 1.0) == [0]


def test_clusters_are_named_by_their_centres_and_chosen_as_in_sql(spark):
    draw = random.Random(5)
    rows = [(k, 10.0 * (k % 3) + draw.random(), draw.random(), f"n{k % 7}") for k in range(60)]
    df = spark.createDataFrame(rows, "k int, x double, y double, n string")
    vectors = multivariate.assembled(df, ["x", "y"], scale=False)
    for seed in (1, 2, 3):
        model = KMeans(k=3, seed=seed, initSteps=5).fit(vectors)
        named = multivariate.labelled(vectors, model).drop("features")
        if len({r["cluster"] for r in named.collect()}) == 3 and model.summary.trainingCost < 30:
            assert all(r["cluster"] == "abc"[r["k"] % 3] for r in named.collect())
    table = named.toPandas()
    chosen = multivariate.refined(multivariate.richest_cluster(named, "x"), named, ["y"], {"x": 20.2}, {"n": ["n1", "n2"]})
    sql = """SELECT k FROM table WHERE cluster = (SELECT cluster FROM table GROUP BY 1 ORDER BY avg(x) DESC, cluster LIMIT 1)
        AND y > (SELECT avg(y) FROM table) AND x > 20.2 AND n NOT IN ('n1', 'n2')"""
    db = duckdb.connect()
    db.register("t", table)
    assert sorted(r["k"] for r in chosen.collect()) == sorted(k for (k,) in db.execute(sql.replace("table", "t")).fetchall())


def test_target_nations_are_large_and_not_at_home(spark, tmp_path):
    sizes = {0: 8, 1: 4, 2: 8, 3: 6, 4: 8, 6: 8, 5: 4, 7: 8, 8: 6, 9: 4, 10: 8, 11: 4, 12: 5, 13: 4, 14: 5}  # 6 in the mean
    wealth = {n: 10 if n in (0, 1, 2, 3, 4, 6) else 5 if n < 11 else 1 for n in sizes}
    people = list(enumerate(n for n in sizes for _ in range(sizes[n])))
    tables = {
        "nation": ([(n, "FRANCE" if n == 4 else f"NATION_{n}") for n in sizes], "n_nationkey int, n_name string"),
        "customer": ([(k, n, 100.0 * wealth[n]) for k, n in people], "c_custkey long, c_nationkey int, c_acctbal double"),
        "orders": ([(k, 1000.0 * wealth[n]) for k, n in people for _ in range(wealth[n])], "o_custkey long, o_totalprice double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = catalog.queries()["target_nations"](spark, str(tmp_path)).collect()
    assert sorted(r["n_nationkey"] for r in got) == [0, 2]
