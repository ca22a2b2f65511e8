"""Revenue, customers and products over the sales tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.operators.relational import first_per_key
from granary.operators.windows import lorenz, pareto, rolling_mean
from granary.plans.catalog import query, table, tasks_for


def line_revenue() -> Column:
    """In exact hundredths, so that sums don't depend on their order."""
    return F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))



def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order's customer and date and their part's brand."""
    lines = table(spark, sf_dir, "lineitem").withColumn("revenue", line_revenue())
    orders, parts = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey)


SOLD = """
    (SELECT *, l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)) AS revenue FROM lineitem
     JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""


@query(
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, p_brand AS category, round(sum(revenue), 2)::DOUBLE AS revenue,
    count(DISTINCT o_orderkey) AS n_orders, count(*) AS n_lines FROM {SOLD} GROUP BY 1, 2"""
)
def monthly_revenue_by_category(spark, sf_dir):
    """Lines are summed up for each order and category first: orders are then counted, not collected."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", line_revenue().alias("revenue"))
    orders, parts = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    branded = lines.join(parts, lines.l_partkey == parts.p_partkey).select("l_orderkey", "p_brand", "revenue")
    dealt = branded.repartition(tasks_for(lines, 500_000), "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    each = dealt.groupBy("l_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("p_brand").alias("category"))
    own = each.agg(F.sum("revenue").alias("revenue"), F.count("*").alias("n"))
    return own.groupBy("month", "category").agg(
        F.round(F.sum("revenue"), 2).cast("double").alias("revenue"), F.count("*").alias("n_orders"), F.sum("n").alias("n_lines")
    )


@query(
    f"""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(round(sum(revenue) * 100) AS BIGINT) AS cents FROM {SOLD} GROUP BY 1)
    SELECT day, cents, CASE WHEN count(*) OVER w = 30 THEN CAST(floor(avg(cents) OVER w) AS BIGINT) END AS mean30
    FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""
)
def daily_revenue_rolling30(spark, sf_dir):
    cents = F.round(F.sum("revenue") * 100).cast("long")
    days = sold(spark, sf_dir).groupBy(F.to_date("o_orderdate").alias("day")).agg(cents.alias("cents"))
    return rolling_mean(days, "cents", [F.col("day")], 30, "mean30").withColumn("mean30", F.floor("mean30"))


@query(
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) AS n_customers,
    count(DISTINCT o_orderkey) AS n_orders, count(*) AS n_lines FROM {SOLD} GROUP BY 1"""
)
def monthly_activity(spark, sf_dir):
    return (
        sold(spark, sf_dir)
        .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
        .agg(
            F.count_distinct("o_custkey").alias("n_customers"),
            F.count_distinct("o_orderkey").alias("n_orders"),
            F.count("*").alias("n_lines"),
        )
    )


def _ranked(spark, sf_dir, order):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.round(F.sum(line_revenue()), 2).cast("double").alias("revenue"))
    return lines.orderBy(order("revenue"), "l_partkey").limit(20)


_PART_REVENUE = "SELECT l_partkey, round(sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2))), 2)::DOUBLE AS revenue FROM lineitem GROUP BY 1"


@query(f"{_PART_REVENUE} ORDER BY revenue DESC, l_partkey LIMIT 20")
def top20_products(spark, sf_dir):
    return _ranked(spark, sf_dir, F.desc_nulls_last)


@query(f"{_PART_REVENUE} ORDER BY revenue, l_partkey LIMIT 20")
def flop20_products(spark, sf_dir):
    return _ranked(spark, sf_dir, F.asc_nulls_last)


@query(
    """SELECT n_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance FROM customer
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY balance DESC, n_name LIMIT 10"""
)
def top10_nations(spark, sf_dir):
    nations = F.broadcast(table(spark, sf_dir, "nation"))  # a fixed, small dimension
    joined = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    by = joined.groupBy("n_name").agg(F.count("*").alias("n_customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    return by.orderBy(F.desc("balance"), "n_name").limit(10)


@query(
    """SELECT p_brand, round(avg(m), 2) AS mean_price FROM (SELECT p_brand, p_partkey, avg(l_extendedprice) AS m
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY 1"""
)
def mean_of_means_category(spark, sf_dir):
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    means = lines.groupBy("l_partkey").agg(F.avg("l_extendedprice").alias("m"))
    return (
        means.join(parts, means.l_partkey == parts.p_partkey)
        .groupBy("p_brand")
        .agg(F.round(F.avg("m"), 2).alias("mean_price"))
    )


@query(
    """SELECT o_custkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS spent FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(*) > 60"""
)
def heavy_customers(spark, sf_dir, least: int = 60):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    by = lines.join(orders, lines.l_orderkey == orders.o_orderkey).groupBy("o_custkey")
    counts = by.agg(F.count("*").alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("spent"))
    return counts.filter(F.col("n_lines") > least)


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN
    (SELECT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(*) > 60)"""
)
def remove_heavy(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.join(heavy_customers(spark, sf_dir), "o_custkey", "left_anti")


@query(
    """WITH c AS (SELECT o_custkey, sum(o_totalprice) AS spent FROM orders GROUP BY 1)
    SELECT o_custkey, round(row_number() OVER (ORDER BY spent, o_custkey) / count(*) OVER (), 6) AS share_of_keys,
    round(sum(spent) OVER (ORDER BY spent, o_custkey ROWS UNBOUNDED PRECEDING) / sum(spent) OVER (), 6) AS share_of_value FROM c"""
)
def lorenz_curve(spark, sf_dir):
    spent = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent"))
    shares = {c: F.round(c, 6) for c in ("share_of_keys", "share_of_value")}
    return lorenz(spent, "o_custkey", "spent").withColumns(shares)


@query(
    """WITH b AS (SELECT p_brand, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1), s AS (SELECT *, round_even(100 * revenue / sum(revenue) OVER (), 2) AS share FROM b),
    r AS (SELECT *, round_even(sum(share) OVER (ORDER BY revenue DESC, p_brand ROWS UNBOUNDED PRECEDING), 2) AS running_share FROM s)
    SELECT * FROM r WHERE running_share <= 80"""
)
def pareto_80(spark, sf_dir):
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    by = lines.join(parts, lines.l_partkey == parts.p_partkey).groupBy("p_brand")
    return pareto(by.agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue")), "p_brand", "revenue")


def _top_category(spark, sf_dir, measure):
    by = sold(spark, sf_dir).groupBy("o_custkey", "p_brand").agg(measure.alias("amount"))
    return first_per_key(by, ["o_custkey"], F.desc("amount"), F.asc("p_brand"))


def _top_category_sql(measure: str) -> str:
    return f"""SELECT o_custkey, p_brand, amount FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY amount DESC, p_brand) AS k FROM (SELECT o_custkey, p_brand, {measure} AS amount FROM {SOLD} GROUP BY 1, 2)) WHERE k = 1"""


@query(_top_category_sql("round(sum(revenue), 2)::DOUBLE"))
def top_category_by_spend(spark, sf_dir):
    return _top_category(spark, sf_dir, F.round(F.sum("revenue"), 2).cast("double"))


@query(_top_category_sql("count(*)"))
def top_category_by_count(spark, sf_dir):
    return _top_category(spark, sf_dir, F.count("*"))


@query(
    """SELECT o_custkey, count(DISTINCT o_orderkey) AS n_orders, min(CAST(o_orderdate AS DATE)) AS first_day,
    max(CAST(o_orderdate AS DATE)) AS last_day, date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) + 1 AS n_days,
    round(ln(1 + count(DISTINCT o_orderkey)), 6) AS log_orders FROM orders GROUP BY 1"""
)
def purchase_frequency(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return orders.groupBy("o_custkey").agg(
        F.count_distinct("o_orderkey").alias("n_orders"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        (F.date_diff(F.max("day"), F.min("day")) + 1).cast("long").alias("n_days"),
        F.round(F.log1p(F.count_distinct("o_orderkey")), 6).alias("log_orders"),
    )


@query(
    """SELECT o_custkey, round(avg(n), 4) AS mean_basket FROM (SELECT o_custkey, o_orderkey, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1"""
)
def basket_size(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    size = lines.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    joined = size.join(orders, size.l_orderkey == orders.o_orderkey)
    return joined.groupBy("o_custkey").agg(F.round(F.avg("n"), 4).alias("mean_basket"))


_YEARS = [str(y) for y in range(1995, 2002)]


@query(
    "SELECT o_orderpriority, "
    + ", ".join(f"round(coalesce(sum(o_totalprice) FILTER (year(o_orderdate) = {y}), 0), 2) AS \"{y}\"" for y in _YEARS)
    + " FROM orders GROUP BY 1"
)
def pivot_year_priority(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate").cast("string"))
    wide = orders.groupBy("o_orderpriority").pivot("year", _YEARS).agg(F.round(F.sum("o_totalprice"), 2))
    return wide.fillna(0.0)


@query(
    """SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS share
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
)
def crosstab_segment_priority(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    by = orders.join(customers, orders.o_custkey == customers.c_custkey).groupBy("c_mktsegment", "o_orderpriority")
    counts = by.agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))
