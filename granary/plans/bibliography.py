"""Record fusion and scoring queries, on records derived from the sales tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.operators import multivariate, records
from granary.operators.quantiles import exact_quantiles
from granary.plans.catalog import query, table, tasks_for


@query(
    """WITH RECURSIVE t AS (SELECT 3::BIGINT AS place UNION SELECT p_partkey FROM part JOIN t ON p_partkey // 10 = place
    WHERE p_partkey > 9) SELECT * FROM t"""
)
def place_descendants(spark, sf_dir):
    parents = table(spark, sf_dir, "part").filter("p_partkey > 9").selectExpr("p_partkey AS place", "p_partkey div 10 AS parent")
    return records.place_closure(parents, 3)


@query(
    """SELECT c_nationkey, min(c_name) AS label, string_agg(DISTINCT c_mktsegment, ' | ' ORDER BY c_mktsegment) AS segments,
    count(DISTINCT c_mktsegment) AS n_segments FROM customer GROUP BY 1"""
)
def enrichment_by_item(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.min("c_name").alias("label"),
        F.array_join(F.array_sort(F.collect_set("c_mktsegment")), " | ").alias("segments"),
        F.count_distinct("c_mktsegment").alias("n_segments"),
    )


@query(
    """SELECT DISTINCT l_partkey AS part, l_suppkey AS party, 'supplies' AS relation FROM lineitem
    UNION ALL SELECT DISTINCT l_partkey, o_custkey, 'buys' FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT DISTINCT l_partkey, o_custkey, 'returns' FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'R'"""
)
def united_relations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    bought = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    pick = lambda df, party: df.select(F.col("l_partkey").alias("part"), F.col(party).alias("party"))
    return records.united_relations(
        {"supplies": pick(lines, "l_suppkey"), "buys": pick(bought, "o_custkey"), "returns": pick(bought.filter("l_returnflag = 'R'"), "o_custkey")},
        "relation",
        tasks_for(lines, 500_000),  # a line has up to three relations
    )


@query(
    """SELECT o_custkey, """
    + ", ".join(
        f"""string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) FILTER (o_orderstatus = '{s}') AS "{s}\""""
        for s in "FOP"
    )
    + " FROM orders GROUP BY 1"
)
def typed_values_wide(spark, sf_dir):
    return records.wide_values(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_orderpriority", ["F", "O", "P"])


@query(
    """SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ' | ' ORDER BY l_returnflag) AS l_returnflag,
    string_agg(DISTINCT l_linestatus, ' | ' ORDER BY l_linestatus) AS l_linestatus, arg_min(p, k) AS p FROM (SELECT *,
    CASE WHEN l_partkey % 3 > 0 THEN l_partkey END AS p, CASE WHEN l_partkey % 3 > 0 THEN l_linenumber * 100000000 + l_partkey END AS k FROM lineitem)
    GROUP BY 1"""
)
def merge_by_id_sets(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {"p": F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey")), "k": F.col("l_linenumber") * F.lit(100000000) + F.col("l_partkey")}
    )
    return records.merged_by_id(lines, "l_orderkey", ["l_returnflag", "l_linestatus"], ["p"], "k")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderpriority = '1-URGENT' THEN 'legal deposit'
    WHEN o_orderkey % 3 = 0 THEN 'local' ELSE 'author' END AS class FROM orders"""
)
def record_class(spark, sf_dir):
    search = F.when(F.col("o_orderkey") % 3 == 0, "local").when(F.col("o_orderkey") % 3 == 1, "author")
    reasons = F.when(F.col("o_orderpriority") == "1-URGENT", "title | Place_of_publication")
    return table(spark, sf_dir, "orders").select("o_orderkey", records.record_class(search, reasons).alias("class"))


@query(
    """SELECT p_partkey, p_size FROM part WHERE coalesce(CASE WHEN p_partkey % 4 > 0 THEN p_size END, p_size + 1)
    NOT IN (SELECT p_size FROM part WHERE p_type = 'PROMO' AND p_partkey % 5 = 0)"""
)
def exclusion_history(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    decision = F.when((F.col("p_type") == "PROMO") & (F.col("p_partkey") % 5 == 0), " Non ").otherwise("Oui")
    _, refused = records.split_decisions(parts.withColumn("decision", decision), "p_size", "decision")
    key = F.coalesce(F.when(F.col("p_partkey") % 4 > 0, F.col("p_size")), F.col("p_size") + 1)
    return records.without_excluded(parts, refused, key, "p_size").select("p_partkey", "p_size")


@query(
    """SELECT p_partkey, NULL AS person, unnest([p_size, p_size + 1]) AS number FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT p_partkey, person, unnest([p_size, p_size + 1]) FROM (SELECT *, unnest([p_brand, p_type]) AS person FROM part WHERE p_partkey % 3 > 0)"""
)
def person_number_pairs(spark, sf_dir):
    people = F.when(F.col("p_partkey") % 3 > 0, F.array("p_brand", "p_type"))
    rows = table(spark, sf_dir, "part").select("p_partkey", people.alias("person"), F.array(F.col("p_size"), F.col("p_size") + 1).alias("number"))
    return records.pairs_of(rows, "person", "number")


@query(
    """SELECT p_partkey, p_size + 2 AS midpoint FROM part"""
)
def interval_midpoint(spark, sf_dir):
    span = F.concat(F.col("p_size").cast("string"), F.lit("-"), (F.col("p_size") + 4).cast("string"))
    ends = F.split(span, "-")
    middle = F.floor((ends[0].cast("int") + ends[1].cast("int")) / 2)
    return table(spark, sf_dir, "part").select("p_partkey", middle.cast("long").alias("midpoint"))


_NATIONS = """(SELECT c_nationkey AS nation, avg(c_acctbal) AS wealth, count(*)::DOUBLE AS people, stddev_samp(c_acctbal) AS spread FROM customer GROUP BY 1)"""


def _nations(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.avg("c_acctbal").alias("wealth"), F.count("*").cast("double").alias("people"), F.stddev_samp("c_acctbal").alias("spread")
    )


@query(f"SELECT nation FROM {_NATIONS} WHERE nation <> 5 AND people > 40 AND wealth > (SELECT avg(wealth) FROM {_NATIONS}) AND spread > (SELECT avg(spread) FROM {_NATIONS})")
def shortlist_cascade(spark, sf_dir):
    every = Window.partitionBy()
    marked = _nations(spark, sf_dir).withColumns({"w": F.avg("wealth").over(every), "s": F.avg("spread").over(every)})
    return marked.filter("nation <> 5 AND people > 40 AND wealth > w AND spread > s").select("nation")


@query(
    f"""WITH n AS (SELECT nation, (wealth - min(wealth) OVER ()) / (max(wealth) OVER () - min(wealth) OVER ()) AS w,
    (spread - min(spread) OVER ()) / (max(spread) OVER () - min(spread) OVER ()) AS s, people / max(people) OVER () AS p FROM {_NATIONS})
    SELECT nation, round(100 * (0.5 * w + 0.2 * (1 - s) + 0.3 * p), 2) AS score FROM n WHERE s > 0"""
)
def target_scores(spark, sf_dir):
    scaled = multivariate.normalized(_nations(spark, sf_dir), "wealth", "spread")
    people = F.col("people") / F.max("people").over(Window.partitionBy())
    score = 100 * (0.5 * F.col("wealth") + 0.2 * (1 - F.col("spread")) + 0.3 * people)
    return scaled.select("nation", F.round(score, 2).alias("score"), "spread").filter("spread > 0").select("nation", "score")


@query(
    """SELECT CAST(floor(o_totalprice / 50000) AS BIGINT) AS bin, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1"""
)
def histogram_bins(spark, sf_dir):
    bins = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_totalprice") / 50000).alias("bin"))
    return bins.agg(F.count("*").alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@query(
    """SELECT p_brand, min(p_retailprice) AS low, quantile_cont(p_retailprice, 0.25) AS q1, median(p_retailprice) AS middle,
    quantile_cont(p_retailprice, 0.75) AS q3, max(p_retailprice) AS high FROM part GROUP BY 1"""
)
def five_number_summary(spark, sf_dir):
    part, c = table(spark, sf_dir, "part"), "p_retailprice"
    ends = part.groupBy("p_brand").agg(F.min(c).alias("low"), F.max(c).alias("high"))
    q = exact_quantiles(part, c, [0.25, 0.5, 0.75], ["p_brand"])
    both = ends.join(q, "p_brand")
    return both.select("p_brand", "low", *(F.col("quantiles")[k].alias(n) for k, n in enumerate(("q1", "middle", "q3"))), "high")
