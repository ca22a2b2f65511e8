"""Running, rolling and rank-based columns.

What runs over a whole table is computed by ranges: Spark deals rows by ranges of
the order and the tie keys together, so that rows of one value are split like any
others; a window runs within each range, and the ranges' totals, a row for each,
are added to what comes after them. No task holds all rows, and there are as many
ranges as the session has shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.stored import stored


def rolling_mean(df: DataFrame, value: str, order: list[Column], rows: int, name: str, by: list[str] = ()) -> DataFrame:
    """Mean of the last ``rows`` rows; null until there are as many."""
    over = Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.withColumn(name, F.when(F.count(value).over(over) == rows, F.avg(value).over(over)))


def running_totals(df: DataFrame, order: str, ties: list[str], sums: list[str], ranges: int | None = None) -> DataFrame:
    """Adds <name>_so_far for each of sums: its total over all rows up to this one by order, then ties; nulls come first.

    ranges is the number of ranges, by default that of the session's shuffle partitions.
    """
    parts = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Stored, as ranges come from a sample that a second reading need not draw again.
    dealt = stored(df.repartitionByRange(parts, order, *ties).withColumn("_range", F.spark_partition_id()), "ranges")
    own = dealt.groupBy("_range").agg(*(F.sum(c).alias(f"_t_{c}") for c in sums))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    shifts = own.select("_range", *(F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_t_{c}") for c in sums))
    within = Window.partitionBy("_range").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(F.broadcast(shifts), "_range")
    totals = {f"{c}_so_far": F.sum(c).over(within) + F.col(f"_t_{c}") for c in sums}
    return out.withColumns(totals).drop("_range", *(f"_t_{c}" for c in sums))


def pareto(df: DataFrame, key: str, value: str, percent: float = 80.0, digits: int = 2) -> DataFrame:
    """Keys by falling value with their rounded share in percent, its running sum, and only those up to percent."""
    total = df.agg(F.sum(value)).scalar()
    shares = df.withColumn("share", F.bround(100 * F.col(value) / total, digits)).withColumn("_falling", -F.col(value))
    out = running_totals(shares, "_falling", [key], ["share"]).withColumnRenamed("share_so_far", "running_share").drop("_falling")
    return out.withColumn("running_share", F.bround("running_share", digits)).filter(F.col("running_share") <= percent)


def lorenz(df: DataFrame, key: str, value: str) -> DataFrame:
    """For each key by rising value: the share of keys and the share of value up to it; one row for each key."""
    every = df.agg(F.struct(F.count("*").alias("n"), F.sum(value).alias("v"))).scalar()
    own = df.select(key, F.col(value).alias("_v"), F.lit(1).alias("_one"))
    out = running_totals(own, "_v", [key], ["_one", "_v"]).withColumn("_all", every)
    return out.select(
        key,
        (F.col("_one_so_far") / F.col("_all.n")).alias("share_of_keys"),
        (F.col("_v_so_far") / F.col("_all.v")).alias("share_of_value"),
    )


def ranked_values(counts: DataFrame, value: str) -> DataFrame:
    """Adds rank to (value, n), a row for each distinct value: the mean of the ranks from 1 that its n rows share."""
    out = running_totals(counts.filter(F.col(value).isNotNull()), value, [], ["n"])
    return out.withColumn("rank", F.col("n_so_far") - (F.col("n") - 1) / 2).drop("n_so_far")


def with_average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """df with the average rank of value; null for a missing one."""
    ranks = ranked_values(df.groupBy(value).agg(F.count("*").alias("n")), value)
    return df.join(ranks.select(value, F.col("rank").alias(name)), value, "left")


def in_lots_of(df: DataFrame, size: int, order: str, ties: list[str] = (), name: str = "lot") -> DataFrame:
    """Adds the number, from 0, of the lot of ``size`` rows that a row falls into by order, then ties; the last lot may be smaller."""
    counted = running_totals(df.withColumn("_one", F.lit(1)), order, list(ties), ["_one"])
    return counted.withColumn(name, F.floor((F.col("_one_so_far") - 1) / size)).drop("_one", "_one_so_far")
