"""Descriptive statistics and hypothesis tests: Spark aggregates, and a tail probability for the last number."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import special
from granary.operators.quantiles import exact_quantiles
from granary.operators.windows import ranked_values, running_totals, with_average_rank


@dataclass(frozen=True)
class TestResult:
    statistic: float
    p_value: float
    freedom: float = math.nan


def unbiased_kurtosis(column: str) -> Column:
    """Excess kurtosis corrected for the sample's size; null under four values."""
    n, g = F.count(column), F.kurtosis(column)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6))


def quartile_fences(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """One row: q1, q3, and the fences reach times their distance beyond them."""
    row = exact_quantiles(df, column, [0.25, 0.75], name="q").select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    gap = F.col("q3") - F.col("q1")
    return row.withColumn("low", F.col("q1") - reach * gap).withColumn("high", F.col("q3") + reach * gap)


def standardized(df: DataFrame, *columns: str) -> DataFrame:
    """(x - mean) / population deviation; null where all values are equal. The one row of moments is a subquery."""
    moments = df.agg(*(F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns))
    row = moments.select(F.struct(*columns).alias("r")).scalar()
    out = df.withColumn("_r", row)
    z = {c: (F.col(c) - F.col(f"_r.{c}.m")) / F.nullif(F.col(f"_r.{c}.s"), F.lit(0.0)) for c in columns}
    return out.withColumns(z).drop("_r")


def spearman(df: DataFrame, x: str, y: str) -> TestResult:
    """Correlation of average ranks; without a number where a value is missing."""
    own = df.select(F.col(x).alias("x"), F.col(y).alias("y"))
    ranked = with_average_rank(with_average_rank(own, "x", "a"), "y", "b")
    gap = F.col("x").isNull() | F.col("y").isNull()
    row = ranked.agg(F.corr("a", "b").alias("r"), F.count("*").alias("n"), F.max(gap).alias("gap")).first()
    if row["gap"] or row["r"] is None or row["n"] < 3:
        return TestResult(math.nan, math.nan)
    r, f = row["r"], row["n"] - 2
    p = 0.0 if abs(r) >= 1 else special.t_two_sided(r * math.sqrt(f / (1 - r * r)), f)
    return TestResult(r, p, f)


def contingency(df: DataFrame, x: str, y: str, most: int = 1_000_000) -> DataFrame:
    """(x, y, observed, expected) for every pair of values, also those that never meet; at most ``most`` pairs."""
    counts = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count("*").alias("observed"))
    rows, columns = counts.groupBy(x).agg(F.sum("observed").alias("_r")), counts.groupBy(y).agg(F.sum("observed").alias("_c"))
    sizes = counts.agg(F.count_distinct(x).alias("r"), F.count_distinct(y).alias("c")).first()
    if sizes["r"] * sizes["c"] > most:
        raise ValueError(f"{sizes['r']} x {sizes['c']} cells are more than {most}")
    total = counts.agg(F.sum("observed")).scalar()
    every = rows.crossJoin(F.broadcast(columns))  # its size was checked
    full = every.join(counts, [x, y], "left").withColumn("observed", F.coalesce("observed", F.lit(0)))
    return full.select(x, y, "observed", (F.col("_r") * F.col("_c") / total).alias("expected"))


def chi_square(df: DataFrame, x: str, y: str) -> TestResult:
    """Independence of two columns, with Yates' correction for a two by two table."""
    table = contingency(df, x, y)
    row = table.agg(F.count_distinct(x).alias("r"), F.count_distinct(y).alias("c")).first()
    freedom = (row["r"] - 1) * (row["c"] - 1)
    if freedom <= 0:
        return TestResult(0.0, 1.0, 0)
    gap = F.abs(F.col("observed") - F.col("expected"))
    gap = gap - F.least(F.lit(0.5), gap) if freedom == 1 else gap
    value = table.agg(F.sum(gap * gap / F.col("expected"))).first()[0]
    return TestResult(value, special.chi_square_tail(value, freedom), freedom)


def levene(df: DataFrame, value: str, group: str) -> TestResult:
    """Equal spread of groups, from distances to group medians; rows without a group or value take no part."""
    known = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    middle = exact_quantiles(known, value, [0.5], [group], "_m").withColumn("_m", F.col("_m")[0])
    apart = known.join(middle, group).select(group, F.abs(F.col(value) - F.col("_m")).alias("d"))
    own = apart.groupBy(group).agg(F.count("d").alias("n"), F.sum("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("q"))
    r = own.agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"),
    ).first()
    between, within = r["b"] - r["s"] ** 2 / r["n"], r["q"] - r["b"]
    f = (r["n"] - r["k"]) / (r["k"] - 1) * between / within
    return TestResult(f, special.f_tail(f, r["k"] - 1, r["n"] - r["k"]), r["k"] - 1)


def kruskal(df: DataFrame, value: str, group: str) -> TestResult:
    """Equal location of groups, from average ranks, corrected for ties."""
    known = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    counts = known.groupBy(value, group).agg(F.count("*").alias("c"))
    ranks = ranked_values(counts.groupBy(value).agg(F.sum("c").alias("n")), value)
    own = counts.join(ranks, value).groupBy(group).agg(F.sum(F.col("c") * F.col("rank")).alias("s"), F.sum("c").alias("n"))
    row = own.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q")).first()
    t = F.col("n").cast("double")
    ties = ranks.agg(F.sum(t * t * t - t)).first()[0] or 0.0
    n = row["n"]
    h = (12 / (n * (n + 1)) * row["q"] - 3 * (n + 1)) / (1 - ties / (n**3 - n))
    return TestResult(h, special.chi_square_tail(h, row["k"] - 1), row["k"] - 1)


#: Values of the smaller sample, and products of both sizes, up to which orders are counted.
FEW_VALUES, MOST_ORDERS = 8, 200_000


def _mann_whitney(a: int, b: int, u: float, ties: float) -> TestResult:
    """Two-sided: exact for a few values without ties, else by the normal limit with correction for ties and continuity."""
    n = a + b
    if not ties and 0 < min(a, b) <= FEW_VALUES and a * b <= MOST_ORDERS:
        return TestResult(u, min(1.0, 2 * special.rank_sum_tail(int(max(u, a * b - u)), a, b)))
    spread = math.sqrt(a * b / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (max(u, a * b - u) - a * b / 2 - 0.5) / spread if spread else 0.0
    return TestResult(u, min(1.0, special.normal_two_sided(z)) if z > 0 else 1.0)


MOST_GROUPS = 60


def pairwise_mann_whitney(df: DataFrame, value: str, group: str, names: list | None = None) -> list[tuple[object, object, TestResult, float]]:
    """(first, second, result, p times the number of pairs) for every two groups, in one pass over the values.

    U counts the pairs of rows in which first's value is larger, ties half. Each group is a column: at most MOST_GROUPS.
    """
    known = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    if names is None:
        names = sorted(r[0] for r in known.select(group).distinct().limit(MOST_GROUPS + 1).collect())
    if len(names) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups to compare with each other")
    known = known.filter(F.col(group).isin(names))
    place = [f"g{k}" for k in range(len(names))]
    own = [F.count_if(F.col(group) == name).alias(c) for c, name in zip(place, names, strict=True)]
    so_far = running_totals(known.groupBy(F.col(value).cast("double").alias("v")).agg(*own), "v", [], place)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    if not pairs:
        return []
    sums = [F.sum(c).alias(c) for c in place]
    for i, j in pairs:
        a, b, below = F.col(place[i]), F.col(place[j]), F.col(f"{place[j]}_so_far")
        both = (a + b).cast("double")
        sums += [F.sum(a * (below - b / 2)).alias(f"u{i}_{j}"), F.sum(both * both * both - both).alias(f"t{i}_{j}")]
    row = so_far.agg(*sums).first()
    out = []
    for i, j in pairs:
        r = _mann_whitney(row[place[i]], row[place[j]], float(row[f"u{i}_{j}"]), row[f"t{i}_{j}"])
        out.append((names[i], names[j], r, r.p_value * len(pairs)))
    return out


def mann_whitney(df: DataFrame, value: str, group: str, first: object, second: object) -> TestResult:
    """U of first against second; two-sided."""
    return pairwise_mann_whitney(df, value, group, [first, second])[0][2]
