"""Cleaning, joining, fusing and checking: small transformations on the sales tables."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.operators import relational as R
from granary.operators.quality import gate_counts
from granary.plans.catalog import query, table
from granary.sources.files import exists
from granary.sources.sinks import read_partitions, upsert_partitions
from granary.stored import removed, shared_dir


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS present, count(DISTINCT {c}) AS "distinct", 1 - count({c}) / count(*) AS null_share FROM customer"""
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    )
)
def profile_counts(spark, sf_dir):
    return R.profile(table(spark, sf_dir, "customer"))


@query("SELECT p_partkey, p_size * 1000 AS p_size, p_retailprice * 1000 AS p_retailprice FROM part")
def unit_scaling(spark, sf_dir):
    return R.scaled(table(spark, sf_dir, "part"), 1000, "p_size", "p_retailprice").select("p_partkey", "p_size", "p_retailprice")


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS level FROM orders")
def conditional_label(spark, sf_dir):
    level = F.when(F.col("o_totalprice") > 250000, "high").otherwise("low")
    return table(spark, sf_dir, "orders").select("o_orderkey", level.alias("level"))


@query("SELECT c_custkey, least(greatest(c_acctbal, 0), 5000) AS balance FROM customer")
def clamp_range(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", R.clamped(F.col("c_acctbal"), 0.0, 5000.0).alias("balance"))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN CASE WHEN p_partkey % 3 <> 0 THEN 0.0 END
    ELSE (p_partkey % 3) / CAST(p_size % 5 AS DOUBLE) END AS ratio FROM part"""
)
def div_zero_policy(spark, sf_dir):
    top, bottom = (F.col("p_partkey") % 3).cast("double"), (F.col("p_size") % 5).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", R.ratio_or_zero(top, bottom).alias("ratio"))


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE (l_quantity > 40 AND l_returnflag = 'R') OR NOT (l_discount < 0.09)"""
)
def filter_predicates(spark, sf_dir):
    keep = ((F.col("l_quantity") > 40) & (F.col("l_returnflag") == "R")) | ~(F.col("l_discount") < 0.09)
    return table(spark, sf_dir, "lineitem").filter(keep).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')")
def isin_list(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("MACHINERY", "BUILDING")).select("c_custkey", "c_mktsegment")


@query(
    """SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
    AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)"""
)
def semi_and_anti_join(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").filter("n_regionkey = 1")
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 300000")
    return customers.join(orders, customers.c_custkey == orders.o_custkey, "left_anti").select("c_custkey")


@query(
    """SELECT n_name, round(coalesce(sum(s_acctbal), 0) / count(DISTINCT n_nationkey), 2) AS balance, count(s_suppkey) AS n_suppliers
    FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY 1"""
)
def right_join_ratio(spark, sf_dir):
    rich = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    nations = table(spark, sf_dir, "nation")
    joined = rich.join(nations, rich.s_nationkey == nations.n_nationkey, "right")
    balance = F.round(F.coalesce(F.sum("s_acctbal"), F.lit(0.0)) / F.count_distinct("n_nationkey"), 2)
    return joined.groupBy("n_name").agg(balance.alias("balance"), F.count("s_suppkey").alias("n_suppliers"))


@query(
    """SELECT p_partkey, CASE WHEN n IS NULL THEN 'left_only' ELSE 'both' END AS _merge, n FROM part LEFT JOIN
    (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON p_partkey = l_partkey"""
)
def left_join_indicator(spark, sf_dir):
    big = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").groupBy(F.col("l_partkey").alias("p_partkey"))
    parts = table(spark, sf_dir, "part").select("p_partkey")
    return R.marked_left_join(parts, big.agg(F.count("*").alias("n")), ["p_partkey"]).select("p_partkey", "_merge", "n")


@query(
    """SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def inner_chain(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", "n_name", "r_name")


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n, round(avg(l_quantity), 4) AS mean_quantity, arg_min(l_partkey, l_shipdate::VARCHAR
    || lpad(l_partkey::VARCHAR, 12, '0')) AS first_part FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def dup_key_aggregate(spark, sf_dir):
    by = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    first = F.min_by("l_partkey", F.struct("l_shipdate", "l_partkey"))
    out = by.agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 4).alias("mean_quantity"), first.alias("first_part"))
    return out.filter("n > 1")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def value_counts(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, round(100 * sum(o_totalprice) / sum(sum(o_totalprice)) OVER (), 4) AS share FROM orders GROUP BY 1")
def share_of_total(spark, sf_dir):
    by = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    return by.select("o_orderstatus", F.round(100 * F.col("v") / F.sum("v").over(Window.partitionBy()), 4).alias("share"))


def _accounts(spark, sf_dir) -> dict[str, DataFrame]:
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return {
        "CUSTOMER": customers.select((F.col("c_custkey") % 50).alias("key"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")),
        "SUPPLIER": suppliers.select((F.col("s_suppkey") % 50).alias("key"), F.col("s_nationkey").alias("nation")),
    }


_FUSED = """(SELECT DISTINCT c_custkey % 50 AS key, c_nationkey AS nation, c_mktsegment AS segment, 'CUSTOMER' AS source FROM customer
    UNION SELECT DISTINCT s_suppkey % 50, s_nationkey, NULL, 'SUPPLIER' FROM supplier)"""


@query(f"SELECT * FROM {_FUSED}")
def fusion_union(spark, sf_dir):
    return R.fused(_accounts(spark, sf_dir))


@query(
    f"""WITH f AS (SELECT nullif(segment, 'MACHINERY') AS known, * FROM {_FUSED})
    SELECT key, nation, segment, source, known FROM (SELECT *, row_number() OVER (PARTITION BY known, key
    ORDER BY CASE WHEN source = 'CUSTOMER' THEN 0 ELSE 1 END, nation, segment) AS k FROM f WHERE known IS NOT NULL) WHERE k = 1
    UNION ALL SELECT key, nation, segment, source, known FROM f WHERE known IS NULL"""
)
def conditional_dedup(spark, sf_dir):
    rows = R.fused(_accounts(spark, sf_dir)).withColumn("known", F.nullif(F.col("segment"), F.lit("MACHINERY")))
    return R.deduplicated_if_known(rows, "known", ["known", "key"], F.col("source") == "CUSTOMER", F.col("nation"), F.col("segment"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def exact_dedup(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    """SELECT p_partkey FROM part WHERE p_partkey % 11 <> 0 AND p_partkey NOT IN
    (SELECT l_partkey FROM lineitem WHERE l_quantity > 47 UNION SELECT p_partkey FROM part WHERE p_partkey % 13 = 0)"""
)
def effective_key_antijoin(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey")
    key = F.when(F.col("p_partkey") % 11 != 0, F.col("p_partkey")).alias("p_partkey")
    held = table(spark, sf_dir, "lineitem").filter("l_quantity > 47").select(F.col("l_partkey").alias("p_partkey"))
    return R.absent_from(parts.select(key), held, parts.filter("p_partkey % 13 = 0"), "p_partkey")


@query(
    """WITH k AS (SELECT s_nationkey AS nation, s_suppkey % 7 AS part, count(DISTINCT s_suppkey) AS n, min(s_suppkey) AS id FROM supplier GROUP BY 1, 2)
    SELECT c_custkey, CASE WHEN n = 1 THEN id END AS supplier, CASE WHEN n = 1 THEN 'FOUND' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'NOT_FOUND' END AS status
    FROM customer LEFT JOIN k ON c_nationkey = nation AND c_custkey % 7 = part"""
)
def entity_unique_match(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 7).alias("part"), F.col("s_suppkey").alias("supplier"))
    wanted = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 7).alias("part"))
    return R.matched_if_unique(wanted, suppliers, ["nation", "part"], "supplier").drop("nation", "part")


_STATUS = """(SELECT p_partkey AS key, CASE WHEN p_partkey % 13 = 0 THEN 'error' WHEN p_partkey IN (SELECT l_partkey FROM lineitem
    WHERE l_quantity > 47) THEN 'present' ELSE 'absent' END AS status FROM part)"""


@query(f"SELECT status, count(*) AS n, sum(count(*)) OVER () AS searched FROM {_STATUS} GROUP BY 1")
def status_reconcile(spark, sf_dir):
    held = table(spark, sf_dir, "lineitem").filter("l_quantity > 47").select(F.col("l_partkey").alias("p_partkey")).distinct()
    parts = R.marked_left_join(table(spark, sf_dir, "part").select("p_partkey"), held, ["p_partkey"])
    status = F.when(F.col("p_partkey") % 13 == 0, "error").when(F.col("_merge") == "both", "present").otherwise("absent")
    counts = parts.groupBy(status.alias("status")).agg(F.count("*").alias("n"))
    return counts.withColumn("searched", F.sum("n").over(Window.partitionBy()))


_OLD = "(SELECT o_orderkey AS key, o_orderdate AS version FROM orders WHERE o_orderkey % 10 < 8)"
_NEW = "(SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS version FROM orders WHERE o_orderkey % 10 > 2)"


@query(
    f"""SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'new' WHEN b.key IS NULL THEN 'removed'
    WHEN a.version IS NOT DISTINCT FROM b.version THEN 'unchanged' ELSE 'modified' END AS status FROM {_OLD} a FULL JOIN {_NEW} b ON a.key = b.key"""
)
def snapshot_compare(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("version"))
    later = F.when(F.col("key") % 4 == 0, F.col("version") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("version"))
    return R.compared_snapshots(orders.filter("key % 10 < 8"), orders.filter("key % 10 > 2").withColumn("version", later), "key", "version")


@query(
    """SELECT user_id, event_type, max(value) AS value FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2 UNION ALL
    SELECT user_id, event_type, min(value) FROM events WHERE event_id % 2 = 0 AND (user_id, event_type) NOT IN
    (SELECT (user_id, event_type) FROM events WHERE event_id % 2 = 1) GROUP BY 1, 2"""
)
def upsert_latest(spark, sf_dir):
    events, keys = table(spark, sf_dir, "events"), ["user_id", "event_type"]
    old = events.filter("event_id % 2 = 0").groupBy(*keys).agg(F.min("value").alias("value"))
    return R.upserted(old, events.filter("event_id % 2 = 1").groupBy(*keys).agg(F.max("value").alias("value")), keys)


@query(
    """SELECT user_id, event_type, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events
    WHERE event_id % 3 <> 2 OR user_id % 5 = 0 GROUP BY 1, 2"""
)
def upsert_by_partition(spark, sf_dir):
    """A table of the latest event of each user and type, first written from one third of events, then brought up to date."""
    events, keys = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"]
    path = f"{shared_dir(spark)}/granary/latest-{uuid.uuid4().hex}"
    atexit.register(removed, spark, path)
    for batch in ("event_id % 3 = 0", "event_id % 3 = 1 OR event_id % 3 = 0", "event_id % 3 = 2 AND user_id % 5 = 0"):
        known = read_partitions(spark, path) if exists(spark, path) else events.limit(0)
        late = known.select(*keys, F.col("event_id").alias("_known"))
        newer = events.filter(batch).join(late, keys, "left").filter("_known IS NULL OR event_id > _known").drop("_known")
        upsert_partitions(spark, path, newer, keys, order="event_id", parts=16)
    return read_partitions(spark, path)


@query(
    """SELECT count(*) AS n_rows, count(*) - count(value) AS n_missing, (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM events
    GROUP BY user_id, ts)) AS n_repeated, count(*) FILTER (value < 1 OR value > 60) AS n_out_of_range FROM events"""
)
def quality_counters(spark, sf_dir):
    return gate_counts(table(spark, sf_dir, "events"), ["user_id", "ts"], ["value"], {"value": (1, 60)})


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS id, trim(c_name) AS title, CAST(floor(c_acctbal) AS BIGINT) AS year, 'CUSTOMER' AS source, '' AS decision,
    c_mktsegment AS segment FROM customer WHERE c_acctbal IS NOT NULL"""
)
def column_contract(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").filter("c_acctbal IS NOT NULL").select(
        F.col("c_mktsegment").alias("segment"), F.lit("CUSTOMER").alias("Sources"), F.lit(None).cast("string").alias("source"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("title"), F.floor("c_acctbal").cast("string").alias("raw_year"), F.col("c_custkey").alias("ID"),
    )
    named = R.renamed(raw, {"Sources": "source", "ID": "id", "raw_year": "year"})
    kinds = {"id": "string", "title": "string", "year": "long", "source": "string", "none": "string"}
    typed = R.with_defaults(R.harmonized(named, kinds, ["title"]), {"decision": "", "source": "other"})
    return R.ordered_columns(typed, ["id", "title", "year", "source", "decision", "none"])


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'unknown' END AS status, w AS weight FROM orders
    LEFT JOIN (VALUES ('1-URGENT', 3), ('2-HIGH', 2)) AS d(p, w) ON o_orderpriority = p"""
)
def mapped_labels(spark, sf_dir):
    weights = spark.createDataFrame([("1-URGENT", 3), ("2-HIGH", 2)], "o_orderpriority string, weight int")
    orders = table(spark, sf_dir, "orders").join(F.broadcast(weights), "o_orderpriority", "left")  # a dimension of two rows
    status = R.mapped(F.col("o_orderstatus"), {"F": "closed", "O": "open"}, F.lit("unknown"))
    return orders.select("o_orderkey", status.alias("status"), "weight")


@query(
    """SELECT o_custkey, string_agg(o_orderpriority, ' | ' ORDER BY k) AS o_orderpriority FROM
    (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS k FROM orders GROUP BY 1, 2) GROUP BY 1"""
)
def concat_first_seen(spark, sf_dir):
    return R.first_seen_joined(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query(
    """SELECT (SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1) AS p_retailprice_most,
    (SELECT p_partkey FROM part ORDER BY p_retailprice, p_partkey LIMIT 1) AS p_retailprice_least,
    (SELECT p_partkey FROM part ORDER BY p_size DESC, p_partkey LIMIT 1) AS p_size_most,
    (SELECT p_partkey FROM part ORDER BY p_size, p_partkey LIMIT 1) AS p_size_least"""
)
def labels_of_extremes(spark, sf_dir):
    return R.labels_of_extremes(table(spark, sf_dir, "part"), "p_partkey", ["p_retailprice", "p_size"])


@query("SELECT p_partkey, p_type FROM part WHERE TRY_CAST(CASE WHEN p_partkey % 4 = 0 THEN p_type ELSE p_size::VARCHAR END AS DOUBLE) IS NULL")
def not_numeric(spark, sf_dir):
    code = F.when(F.col("p_partkey") % 4 == 0, F.col("p_type")).otherwise(F.col("p_size").cast("string"))
    parts = table(spark, sf_dir, "part")
    return parts.filter(code.isNotNull() & code.try_cast("double").isNull()).select("p_partkey", "p_type")
