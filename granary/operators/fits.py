"""A normal fit with what its plots show, and a line that outliers don't pull: numbers, not drawings."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.normal import inverse_normal, normal_density
from granary.operators.quantiles import exact_quantiles
from granary.operators.windows import running_totals
from granary.stored import dropped, stored


def quantile_pairs(df: DataFrame, value: str, key: str) -> DataFrame:
    """(key, value, theoretical, line) for each known value: the normal quantile of its rank i of n at i / (n + 1), and
    the line of the fit through it, mean + deviation * quantile. Equal values rank by key; ranks are found by ranges."""
    known = df.filter(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias(value), F.lit(1).alias("_one"))
    every = known.agg(F.struct(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation"))).scalar()
    ranked = running_totals(known, value, [key], ["_one"]).withColumn("_all", every)
    z = inverse_normal(F.col("_one_so_far") / (F.col("_all.n") + 1))
    return ranked.select(key, value, z.alias("theoretical")).withColumn("_all", every).select(
        key, value, "theoretical", (F.col("_all.mean") + F.col("_all.deviation") * F.col("theoretical")).alias("line")
    )


def density_bins(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(bin, low, n, density, fitted) of equal bins from the least to the greatest value, which the last one includes.

    fitted is the normal density with the values' mean and population deviation at the bin's middle. Empty bins are
    there too; without values, or with one value alone, there are no bins.
    """
    c = F.col(value).cast("double")
    every = df.agg(F.struct(F.count(c).alias("n"), F.min(c).alias("a"), F.max(c).alias("b"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("deviation"))).scalar()
    place = F.least(F.floor((c - F.col("_all.a")) / (F.col("_all.b") - F.col("_all.a")) * bins), F.lit(bins - 1)).cast("int")
    counts = df.filter(c.isNotNull()).withColumn("_all", every).filter("_all.b > _all.a").groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_all", every).filter("_all.b > _all.a")
    width = (F.col("_all.b") - F.col("_all.a")) / bins
    low = F.col("_all.a") + F.col("bin") * width
    both = frame.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    fitted = normal_density(low + width / 2, F.col("_all.mean"), F.col("_all.deviation"))
    return both.select("bin", low.alias("low"), "n", (F.col("n") / (F.col("_all.n") * width)).alias("density"), fitted.alias("fitted"))


@dataclass(frozen=True)
class Line:
    intercept: float
    slope: float
    scale: float
    rounds: int


#: Huber's bound in deviations, and the median of a standard normal variable's absolute value.
BOUND, HALF = 1.345, 0.6744897501960817


def _weighted_line(df: DataFrame, x: str, y: str, weight) -> tuple[float, float]:
    """(intercept, slope) by weighted least squares: one aggregate of moments about a middle point."""
    middle = df.agg(F.avg(x).alias("x"), F.avg(y).alias("y")).first()
    own = df.select(weight.alias("w"), (F.col(x) - middle["x"]).alias("a"), (F.col(y) - middle["y"]).alias("b"))
    w, a, b = F.col("w"), F.col("a"), F.col("b")
    s = own.agg(F.sum(w).alias("w"), F.sum(w * a).alias("a"), F.sum(w * b).alias("b"), F.sum(w * a * a).alias("aa"), F.sum(w * a * b).alias("ab")).first()
    spread = s["aa"] - s["a"] ** 2 / s["w"]
    if not spread > 0:
        raise ValueError(f"a line needs two different values of {x}")
    slope = (s["ab"] - s["a"] * s["b"] / s["w"]) / spread
    return middle["y"] + (s["b"] - slope * s["a"]) / s["w"] - slope * middle["x"], slope


def huber_line(df: DataFrame, x: str, y: str, rounds: int = 50, tolerance: float = 1e-8) -> Line:
    """y = intercept + slope * x by iteratively reweighted least squares, from the plain fit on.

    A round takes the scale from the exact median of the absolute residuals, weighs down residuals beyond BOUND scales,
    and fits again; it ends after ``rounds`` or once neither coefficient moves by more than the tolerance, relatively.
    Rows without x or y take no part. Residuals of which half are zero end it too: the line goes through those points.
    """
    # Stored, as each round goes over the rows several times, and df may be joins.
    known = stored(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(), "points")
    if known.isEmpty():
        raise ValueError("no rows with both values")
    intercept, slope = _weighted_line(known, "x", "y", F.lit(1.0))
    scale, done = math.nan, 0
    for done in range(1, rounds + 1):
        gap = F.abs(F.col("y") - (F.lit(intercept) + F.lit(slope) * F.col("x")))
        scale = exact_quantiles(known.select(gap.alias("r")), "r", [0.5]).first()[0][0] / HALF
        if not scale:
            break
        last = intercept, slope
        weight = F.when(gap <= BOUND * scale, F.lit(1.0)).otherwise(F.lit(BOUND * scale) / gap)
        intercept, slope = _weighted_line(known, "x", "y", weight)
        if all(abs(a - b) <= tolerance * abs(b) for a, b in zip((intercept, slope), last, strict=True)):
            break
    dropped(known)
    return Line(intercept, slope, scale, done)
