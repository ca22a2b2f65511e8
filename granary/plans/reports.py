"""Statistics and models over the sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.normal import MIDDLE, TAIL
from granary.operators import multivariate, statistics
from granary.operators.fits import BOUND, HALF, density_bins, huber_line, quantile_pairs
from granary.operators.quantiles import exact_quantiles
from granary.operators.rank_matrix import rank_correlations
from granary.operators.windows import with_average_rank
from granary.plans.catalog import query, table
from granary.stored import stored
from granary.streaming.events import hourly_windows


@query(
    """WITH m AS (SELECT round_even(avg(o_totalprice), 2) AS mean, round_even(stddev_pop(o_totalprice), 2) AS dev FROM orders)
    SELECT o_orderkey, round((o_totalprice - mean) / dev, 6) AS z FROM orders, m WHERE (o_totalprice - mean) / dev > 1.5"""
)
def zscore_outliers(spark, sf_dir, bound: float = 1.5):
    orders = table(spark, sf_dir, "orders")
    every = orders.agg(
        F.struct(F.bround(F.avg("o_totalprice"), 2).alias("mean"), F.bround(F.stddev_pop("o_totalprice"), 2).alias("dev")).alias("m")
    )
    z = (F.col("o_totalprice") - F.col("m.mean")) / F.col("m.dev")
    return orders.withColumn("m", every.scalar()).withColumn("z", z).filter(F.col("z") > bound).select("o_orderkey", F.round("z", 6).alias("z"))


@query(
    """WITH q AS (SELECT quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.75) AS q3 FROM part)
    SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(q1 - 1.5 * (q3 - q1), 4) AS low, round(q3 + 1.5 * (q3 - q1), 4) AS high FROM q"""
)
def tukey_fences(spark, sf_dir):
    fences = statistics.quartile_fences(table(spark, sf_dir, "part"), "p_retailprice")
    return fences.select(*(F.round(c, 4).alias(c) for c in ("q1", "q3", "low", "high")))


@query(
    """SELECT count(p_retailprice) AS n, round(avg(p_retailprice), 6) AS mean, round(stddev_samp(p_retailprice), 6) AS deviation,
    min(p_retailprice) AS low, quantile_cont(p_retailprice, 0.5) AS median, max(p_retailprice) AS high, round(kurtosis(p_retailprice), 6) AS kurtosis FROM part"""
)
def describe_price(spark, sf_dir):
    c, part = "p_retailprice", table(spark, sf_dir, "part")
    median = exact_quantiles(part, c, [0.5]).select(F.col("quantiles")[0]).scalar()
    row = part.agg(
        F.count(c).alias("n"), F.round(F.avg(c), 6).alias("mean"), F.round(F.stddev_samp(c), 6).alias("deviation"),
        F.min(c).alias("low"), F.max(c).alias("high"), F.round(statistics.unbiased_kurtosis(c), 6).alias("kurtosis"),
    )
    return row.withColumn("median", median)


@query("SELECT round(corr(l_quantity, l_extendedprice), 8) AS qp, round(corr(l_quantity, l_discount), 8) AS qd, round(corr(l_extendedprice, l_discount), 8) AS pd FROM lineitem")
def pearson_matrix(spark, sf_dir):
    pairs = {"qp": ("l_quantity", "l_extendedprice"), "qd": ("l_quantity", "l_discount"), "pd": ("l_extendedprice", "l_discount")}
    return table(spark, sf_dir, "lineitem").agg(*(F.round(F.corr(a, b), 8).alias(k) for k, (a, b) in pairs.items()))


@query(
    """SELECT round(corr(a, b), 8) AS spearman FROM (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS a,
    rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2 AS b FROM part)"""
)
def spearman_size_price(spark, sf_dir):
    ranks = with_average_rank(with_average_rank(table(spark, sf_dir, "part").select("p_size", "p_retailprice"), "p_size", "a"), "p_retailprice", "b")
    return ranks.agg(F.round(F.corr("a", "b"), 8).alias("spearman"))


@query(
    """WITH t AS (SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    e AS (SELECT a.c_mktsegment, b.o_orderpriority, a.r * b.c / t.s AS x FROM (SELECT c_mktsegment, sum(n) AS r FROM t GROUP BY 1) a,
    (SELECT o_orderpriority, sum(n) AS c FROM t GROUP BY 1) b, (SELECT sum(n) AS s FROM t) t)
    SELECT round(sum((coalesce(n, 0) - x) ** 2 / x), 6) AS chi_square FROM e LEFT JOIN t USING (c_mktsegment, o_orderpriority)"""
)
def chi2_segment_priority(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    both = orders.join(customers, orders.o_custkey == customers.c_custkey)
    cells = statistics.contingency(both, "c_mktsegment", "o_orderpriority")
    gap = F.col("observed") - F.col("expected")
    return cells.agg(F.round(F.sum(gap * gap / F.col("expected")), 6).alias("chi_square"))


def _result(spark, r: statistics.TestResult) -> DataFrame:
    return spark.createDataFrame([(round(r.statistic, 5),)], "statistic double")


@query(
    """WITH d AS (SELECT p_type AS g, abs(p_retailprice - median(p_retailprice) OVER (PARTITION BY p_type)) AS d FROM part),
    o AS (SELECT g, count(*) AS n, avg(d) AS m FROM d GROUP BY 1), a AS (SELECT avg(d) AS m, count(*) AS n FROM d)
    SELECT round((SELECT (a.n - (SELECT count(*) FROM o)) / ((SELECT count(*) FROM o) - 1) * (SELECT sum(o.n * (o.m - a.m) ** 2) FROM o) FROM a)
    / (SELECT sum((d.d - o.m) ** 2) FROM d JOIN o USING (g)), 5) AS statistic"""
)
def levene_type_price(spark, sf_dir):
    return _result(spark, statistics.levene(table(spark, sf_dir, "part"), "p_retailprice", "p_type"))


_RANKS = "(SELECT p_type, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS r FROM part)"


@query(
    f"""WITH g AS (SELECT sum(r) AS s, count(*) AS n FROM {_RANKS} GROUP BY p_type), n AS (SELECT count(*)::DOUBLE AS n FROM part),
    t AS (SELECT sum(c ** 3 - c) AS t FROM (SELECT count(*)::DOUBLE AS c FROM part GROUP BY p_size))
    SELECT round((12 / (n.n * (n.n + 1)) * (SELECT sum(s * s / n) FROM g) - 3 * (n.n + 1)) / (1 - t.t / (n.n ** 3 - n.n)), 5) AS statistic FROM n, t"""
)
def kruskal_type_size(spark, sf_dir):
    return _result(spark, statistics.kruskal(table(spark, sf_dir, "part"), "p_size", "p_type"))


@query(
    """WITH r AS (SELECT p_type, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS r FROM part
    WHERE p_type IN ('ECONOMY', 'PROMO')) SELECT round(sum(r) - count(*) * (count(*) + 1) / 2, 5) AS statistic FROM r WHERE p_type = 'ECONOMY'"""
)
def mannwhitney_types(spark, sf_dir):
    return _result(spark, statistics.mann_whitney(table(spark, sf_dir, "part"), "p_size", "p_type", "ECONOMY", "PROMO"))


@query(
    """WITH p AS (SELECT p_type AS g, p_size::DOUBLE AS v FROM part), g AS (SELECT g, count(*)::DOUBLE AS n FROM p GROUP BY 1),
    k AS (SELECT count(*)::DOUBLE AS m FROM g a JOIN g b ON a.g < b.g),
    c AS (SELECT g, v, count(*)::DOUBLE AS c FROM p GROUP BY 1, 2),
    u AS (SELECT a.g AS first, b.g AS second, sum(a.c * b.c * CASE WHEN a.v > b.v THEN 1 WHEN a.v = b.v THEN 0.5 ELSE 0 END) AS u
        FROM c a JOIN c b ON a.g < b.g GROUP BY 1, 2),
    t AS (SELECT x.g AS first, y.g AS second, sum(s ** 3 - s) AS t FROM g x JOIN g y ON x.g < y.g JOIN LATERAL
        (SELECT sum(c) AS s FROM c WHERE c.g IN (x.g, y.g) GROUP BY v) ON true GROUP BY 1, 2),
    z AS (SELECT u.first, u.second, u, m, (greatest(u, a.n * b.n - u) - a.n * b.n / 2 - 0.5)
        / sqrt(a.n * b.n / 12 * (a.n + b.n + 1 - t / ((a.n + b.n) * (a.n + b.n - 1)))) AS z
        FROM u JOIN t USING (first, second) JOIN g a ON u.first = a.g JOIN g b ON u.second = b.g, k),
    s AS (SELECT first, second, u, m, z, greatest(z, 0) / 2000 AS h FROM z),
    p2 AS (SELECT first, second, u, m, 1 - 2 / sqrt(2 * pi()) * h / 3 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * exp(0 - (i * h) ** 2 / 2)) AS p FROM s, range(0, 2001) r(i) GROUP BY first, second, u, m, h)
    SELECT first, second, round(u, 5) AS u, round(p, 6) AS p, round(p * m, 6) AS p_bonferroni, p * m < 0.05 AS significant FROM p2"""
)
def mannwhitney_pairs(spark, sf_dir):
    found = statistics.pairwise_mann_whitney(table(spark, sf_dir, "part"), "p_size", "p_type")
    rows = [(a, b, round(r.statistic, 5), round(r.p_value, 6), round(p, 6), p < 0.05) for a, b, r, p in found]
    return spark.createDataFrame(rows, "first string, second string, u double, p double, p_bonferroni double, significant boolean")


@query(
    """WITH t AS (SELECT c_mktsegment AS a, o_orderpriority AS b, count(*)::DOUBLE AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    m AS (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS freedom, sum(n) AS s FROM t),
    x AS (SELECT s * (sum(n * n / (r * c)) - 1) AS x, freedom FROM t JOIN (SELECT a, sum(n) AS r FROM t GROUP BY 1) USING (a)
        JOIN (SELECT b, sum(n) AS c FROM t GROUP BY 1) USING (b), m GROUP BY s, freedom)
    SELECT round(x, 5) AS statistic, freedom::DOUBLE AS freedom, round(exp(-x / 2) * list_sum(list_transform(range(0, freedom // 2),
        lambda i: pow(x / 2, i) / gamma(i + 1))), 6) AS p FROM x"""
)
def chi2_test(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    both = orders.join(customers, orders.o_custkey == customers.c_custkey)
    r = statistics.chi_square(both, "c_mktsegment", "o_orderpriority")
    return spark.createDataFrame([(round(r.statistic, 5), float(r.freedom), round(r.p_value, 6))], "statistic double, freedom double, p double")


def _integral(density: str, upper: str, steps: int = 4000) -> str:
    """SQL for the integral of a density of x from 0 to upper, by Simpson's rule."""
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"({upper}) / {3 * steps} * list_sum(list_transform(range(0, {steps + 1}), lambda i: ({weight}) * {density.replace('x', f'(i * ({upper}) / {steps})')}))"


#: Densities with the freedoms d and e as columns; "y" stands for the exponential's name, as x is the place.
_F_DENSITY = "eyp(lgamma((d + e) / 2) - lgamma(d / 2) - lgamma(e / 2)) * pow(d / e, d / 2) * pow(x, d / 2 - 1) * pow(1 + d / e * x, -(d + e) / 2)"
_CHI_DENSITY = "pow(x, d / 2 - 1) * eyp(-x / 2) / (pow(2, d / 2) * gamma(d / 2))"
_T_DENSITY = "eyp(lgamma((d + 1) / 2) - lgamma(d / 2)) / sqrt(d * pi()) * pow(1 + x * x / d, -(d + 1) / 2)"


def _tail(density: str, upper: str) -> str:
    return f"1 - {_integral(density, upper)}".replace("eyp", "exp")


@query(
    f"""WITH d AS (SELECT p_type AS g, abs(p_retailprice - median(p_retailprice) OVER (PARTITION BY p_type)) AS d FROM part),
    o AS (SELECT g, count(*) AS n, avg(d) AS m, var_pop(d) * count(*) AS q FROM d GROUP BY 1), a AS (SELECT avg(d) AS m, count(*) AS n FROM d),
    s AS (SELECT count(*) - 1.0::DOUBLE AS d, any_value(a.n) - count(*)::DOUBLE AS e, sum(o.n * (o.m - a.m) ** 2) AS b, sum(q) AS w FROM o, a),
    f AS (SELECT d, e, e / d * b / w AS f FROM s) SELECT round(f, 5) AS statistic, d AS freedom, round({_tail(_F_DENSITY, "f")}, 6) AS p FROM f"""
)
def levene_test(spark, sf_dir):
    return _with_p(spark, statistics.levene(table(spark, sf_dir, "part"), "p_retailprice", "p_type"))


@query(
    f"""WITH g AS (SELECT sum(r) AS s, count(*) AS n FROM {_RANKS} GROUP BY p_type), n AS (SELECT count(*)::DOUBLE AS n FROM part),
    t AS (SELECT sum(c ** 3 - c) AS t FROM (SELECT count(*)::DOUBLE AS c FROM part GROUP BY p_size)),
    h AS (SELECT (12 / (n.n * (n.n + 1)) * (SELECT sum(s * s / n) FROM g) - 3 * (n.n + 1)) / (1 - t.t / (n.n ** 3 - n.n)) AS h,
        (SELECT count(*) - 1.0::DOUBLE FROM g) AS d FROM n, t)
    SELECT round(h, 5) AS statistic, d AS freedom, round({_tail(_CHI_DENSITY, "h")}, 6) AS p FROM h"""
)
def kruskal_test(spark, sf_dir):
    return _with_p(spark, statistics.kruskal(table(spark, sf_dir, "part"), "p_size", "p_type"))


def _with_p(spark, r: statistics.TestResult) -> DataFrame:
    return spark.createDataFrame([(round(r.statistic, 5), float(r.freedom), round(r.p_value, 6))], "statistic double, freedom double, p double")


_LINES = """(SELECT l_quantity AS quantity, l_extendedprice AS price, CASE WHEN l_linenumber <> 3 THEN l_discount END AS discount,
    CASE WHEN l_quantity % 7 <> 0 THEN l_tax END AS tax FROM lineitem)"""
_FOUR = ["quantity", "price", "discount", "tax"]
_RHO = " UNION ALL ".join(
    f"""SELECT '{a}' AS x, '{b}' AS y, count(*) AS n, corr(ra, rb) AS rho FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2 AS ra,
    rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2 AS rb FROM {_LINES} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""
    for k, a in enumerate(_FOUR) for b in _FOUR[k + 1 :]
)


@query(
    f"""WITH r AS ({_RHO}), t AS (SELECT x AS a, y AS b, n, rho, n - 2.0::DOUBLE AS d, abs(rho) * sqrt((n - 2) / (1 - rho * rho)) AS t FROM r)
    SELECT a AS x, b AS y, n, round(rho, 8) AS rho, round(2 * ({_tail(_T_DENSITY, "t")}) - 1, 6) AS p FROM t"""
)
def spearman_matrix(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    four = lines.select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("discount"), F.when(F.col("l_quantity") % 7 != 0, F.col("l_tax")).alias("tax"),
    )
    return rank_correlations(four, _FOUR).withColumns({"rho": F.round("rho", 8), "p": F.round("p", 6)})


@query(
    """WITH v AS (SELECT n_regionkey AS g, n_nationkey AS k, avg(c_acctbal) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    p AS (SELECT a.g AS first, b.g AS second FROM (SELECT DISTINCT g FROM v) a JOIN (SELECT DISTINCT g FROM v) b ON a.g < b.g),
    u AS (SELECT first, second, sum(CASE WHEN x.v > y.v THEN 1 ELSE 0 END)::BIGINT AS u, count(DISTINCT x.k) AS a, count(DISTINCT y.k) AS b
        FROM p JOIN v x ON x.g = first JOIN v y ON y.g = second GROUP BY 1, 2),
    s AS (SELECT *, greatest(u, a * b - u) AS most, unnest(range(0, (2 ** (a + b))::BIGINT)) AS chosen FROM u),
    o AS (SELECT *, list_sum(list_transform(list_filter(range(0, a + b), lambda i: (chosen >> i) & 1 = 1), lambda i: i + 1)) - a * (a + 1) / 2 AS way
        FROM s WHERE bit_count(chosen) = a)
    SELECT first, second, any_value(u)::DOUBLE AS u, round(least(1, 2.0 * count(*) FILTER (way >= most) / count(*)), 6) AS p FROM o GROUP BY 1, 2"""
)
def mannwhitney_exact(spark, sf_dir):
    """Nations' mean balances by region: few values without ties, so that all orders are counted."""
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    means = customers.join(nations, customers.c_nationkey == nations.n_nationkey).groupBy("n_regionkey", "n_nationkey").agg(F.avg("c_acctbal").alias("v"))
    found = statistics.pairwise_mann_whitney(means, "v", "n_regionkey")
    return spark.createDataFrame([(a, b, r.statistic, round(r.p_value, 6)) for a, b, r, _ in found], "first int, second int, u double, p double")


@query("SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 6) AS p_size FROM part")
def zscore_scaled(spark, sf_dir):
    out = statistics.standardized(table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size").cast("double")), "p_size")
    return out.select("p_partkey", F.round("p_size", 6).alias("p_size"))


@query(
    """WITH n AS (SELECT c_nationkey AS nation, avg(c_acctbal) AS a, count(*)::DOUBLE AS b FROM customer GROUP BY 1)
    SELECT nation, round(100 * (0.7 * (a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()) + 0.3 * b / max(b) OVER ()), 4) AS score FROM n"""
)
def minmax_score(spark, sf_dir):
    by = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation"))
    nations = by.agg(F.avg("c_acctbal").alias("a"), F.count("*").cast("double").alias("b"))
    scaled = multivariate.normalized(nations, "a")
    score = 100 * (0.7 * F.col("a") + 0.3 * F.col("b") / F.max("b").over(Window.partitionBy()))
    return scaled.select("nation", F.round(score, 4).alias("score"))


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def hourly_event_windows(spark, sf_dir):
    by = hourly_windows(table(spark, sf_dir, "events"))
    return by.withColumn("total", F.round("total", 2))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query()
def pca_variance(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*_MEASURES)
    _, shares, _ = multivariate.principal_components(lines, _MEASURES, 3)
    rows = [(i + 1, round(float(s), 6), round(float(shares[: i + 1].sum()), 6)) for i, s in enumerate(shares)]
    return spark.createDataFrame(rows, "component int, share double, running_share double")


@query()
def kmeans_inertia(spark, sf_dir):
    vectors = multivariate.assembled(table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("p_size"), "p_retailprice"), ["p_size", "p_retailprice"])
    kept = vectors.select("features").cache()
    costs = multivariate.elbow(kept, 4, 1)
    kept.unpersist()
    return spark.createDataFrame(costs, "k int, cost double")


@query()
def ward_cut(spark, sf_dir):
    nations = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("a"), F.count("*").cast("double").alias("b"))
    rows = statistics.standardized(nations, "a", "b").orderBy("c_nationkey").collect()  # a row for each nation
    import numpy as np

    labels = multivariate.ward_clusters(np.array([[r["a"], r["b"]] for r in rows]), 2.0)
    return spark.createDataFrame([(r["c_nationkey"], k) for r, k in zip(rows, labels, strict=True)], "nation int, cluster int")


def _spending(spark, sf_dir) -> DataFrame:
    """Customers with orders: balance, and the logarithm of what they spent."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    spent = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.log1p(F.sum("o_totalprice")).alias("spent"))
    return customers.join(spent, "c_custkey").select("c_custkey", F.col("c_acctbal").alias("balance"), "spent")


_SPENDING = "(SELECT c_custkey, c_acctbal AS x, s AS y FROM customer JOIN (SELECT o_custkey, ln(1 + sum(o_totalprice)) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE c_acctbal IS NOT NULL AND s IS NOT NULL)"


def _huber_sql(rounds: int) -> str:
    """The plain fit, then for each round the residuals, their scale, weights and the weighted fit."""
    line = """SELECT (sum(w * y) - b * sum(w * x)) / sum(w) AS a, b FROM {rows}, (SELECT (sum(w * (x - mx) * (y - my)) - sum(w * (x - mx)) * sum(w * (y - my)) / sum(w))
        / (sum(w * (x - mx) ** 2) - sum(w * (x - mx)) ** 2 / sum(w)) AS b FROM {rows}, m) GROUP BY b"""
    steps = [f"d AS MATERIALIZED {_SPENDING}", "m AS (SELECT avg(x) AS mx, avg(y) AS my FROM d)", "w0 AS (SELECT x, y, 1.0::DOUBLE AS w FROM d)", f"p0 AS MATERIALIZED ({line.format(rows='w0')})"]
    for k in range(1, rounds + 1):
        steps += [
            f"r{k} AS MATERIALIZED (SELECT x, y, abs(y - (a + b * x)) AS r FROM d, p{k - 1})",
            f"s{k} AS MATERIALIZED (SELECT median(r) / {HALF} AS s FROM r{k})",
            f"w{k} AS MATERIALIZED (SELECT x, y, CASE WHEN r <= {BOUND} * s THEN 1.0 ELSE {BOUND} * s / r END::DOUBLE AS w FROM r{k}, s{k})",
            f"p{k} AS MATERIALIZED ({line.format(rows=f'w{k}')})",
        ]
    return f"WITH {', '.join(steps)} SELECT round(a, 8) AS intercept, round(b, 12) AS slope, round(s, 8) AS scale FROM p{rounds}, s{rounds}"


@query(_huber_sql(4))
def robust_line(spark, sf_dir):
    line = huber_line(_spending(spark, sf_dir), "balance", "spent", rounds=4, tolerance=0.0)
    return spark.createDataFrame([(round(line.intercept, 8), round(line.slope, 12), round(line.scale, 8))], "intercept double, slope double, scale double")


def _polynomials(own: tuple[list[float], list[float]], r: str) -> str:
    over, under = (" + ".join(f"{c!r} * pow({r}, {k})" for k, c in enumerate(part)) for part in own)
    return f"({over}) / ({under})"


_INVERSE = f"""CASE WHEN abs(p - 0.5) <= 0.425 THEN (p - 0.5) * {_polynomials(MIDDLE, "(0.180625 - (p - 0.5) * (p - 0.5))")}
    ELSE sign(p - 0.5) * {_polynomials(TAIL, "(sqrt(-ln(least(p, 1 - p))) - 1.6)")} END"""


@query(
    f"""WITH v AS (SELECT c_custkey, c_acctbal AS v, row_number() OVER (ORDER BY c_acctbal, c_custkey) / (count(*) OVER () + 1.0::DOUBLE) AS p,
        avg(c_acctbal) OVER () AS m, stddev_pop(c_acctbal) OVER () AS s FROM customer WHERE c_acctbal IS NOT NULL)
    SELECT c_custkey, v AS c_acctbal, round({_INVERSE}, 8) AS theoretical, round(m + s * ({_INVERSE}), 4) AS line FROM v"""
)
def normal_quantile_pairs(spark, sf_dir):
    pairs = quantile_pairs(table(spark, sf_dir, "customer"), "c_acctbal", "c_custkey")
    return pairs.withColumns({"theoretical": F.round("theoretical", 8), "line": F.round("line", 4)})


@query(
    """WITH a AS (SELECT min(c_acctbal) AS a, max(c_acctbal) AS b, count(c_acctbal) AS n, avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer),
    k AS (SELECT least(floor((c_acctbal - a) / (b - a) * 10), 9)::INT AS bin, count(*) AS n FROM customer, a WHERE c_acctbal IS NOT NULL GROUP BY 1),
    e AS (SELECT i::INT AS bin, a + i * (b - a) / 10 AS low, (b - a) / 10 AS w, a.n AS every, m, s FROM range(10) r(i), a)
    SELECT e.bin, round(low, 4) AS low, coalesce(k.n, 0) AS n, round(coalesce(k.n, 0) / (every * w), 10) AS density,
    round(exp(0 - ((low + w / 2 - m) / s) ** 2 / 2) / (s * sqrt(2 * pi())), 10) AS fitted FROM e LEFT JOIN k ON e.bin = k.bin"""
)
def normal_fit_bins(spark, sf_dir):
    bins = density_bins(table(spark, sf_dir, "customer"), "c_acctbal")
    return bins.select("bin", F.round("low", 4).alias("low"), "n", F.round("density", 10).alias("density"), F.round("fitted", 10).alias("fitted"))


_PROFILE = ["spent", "balance", "orders", "size"]

#: The home nation, which is no target: TPC-H's sixth, by its name there and by that of tables that only number nations.
_HOME = ["FRANCE", "NATION_6"]


def _nation_profiles(spark, sf_dir) -> DataFrame:
    """What nations' customers are like: a row for each nation."""
    orders, customers, nations = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    own = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("spent"), F.count("*").alias("orders"))
    by = customers.join(own, "c_custkey", "left").groupBy("c_nationkey").agg(
        F.avg("spent").alias("spent"), F.avg("c_acctbal").alias("balance"), F.avg(F.coalesce("orders", F.lit(0))).alias("orders"), F.count("*").cast("double").alias("size")
    )
    return by.join(nations, by.c_nationkey == nations.n_nationkey).select("n_nationkey", "n_name", *_PROFILE)


@query()
def target_nations(spark, sf_dir):
    """Nations of the richest of three clusters, but for the home nation, that score above the mean and have more customers than the mean."""
    profiles = stored(_nation_profiles(spark, sf_dir).dropna(), "profiles")  # a row for each nation, read by every fit
    scored = multivariate.normalized(profiles, "spent", "balance").withColumn("score", 0.6 * F.col("spent") + 0.4 * F.col("balance")).select("n_nationkey", "score")
    vectors = multivariate.assembled(profiles, _PROFILE)
    model = multivariate.best_kmeans(vectors.select("features"), 3)
    named = multivariate.labelled(vectors, model).select("n_nationkey", "cluster")
    every = profiles.join(named, "n_nationkey").join(scored, "n_nationkey")
    chosen = multivariate.refined(multivariate.richest_cluster(every, "spent"), every, ["score", "size"], {}, {"n_name": _HOME})
    return chosen.select("n_nationkey", "n_name", "cluster", F.round("score", 6).alias("score"))


@query()
def ward_levels(spark, sf_dir):
    """The top three levels of the nations' hierarchy."""
    rows = statistics.standardized(_nation_profiles(spark, sf_dir).dropna(), *_PROFILE).orderBy("n_nationkey").collect()  # a row for each nation
    import numpy as np

    links = multivariate.ward_linkage(np.array([[r[c] or 0.0 for c in _PROFILE] for r in rows]))
    found = [(level, node, parent, round(height, 6), size) for node, level, parent, height, size in multivariate.top_levels(links)]
    return spark.createDataFrame(found, "level int, node int, parent int, height double, size int")
