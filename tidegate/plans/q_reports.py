"""Plain reports: filters, joins, groups, ranks and unions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators import statistics
from tidegate.plans.registry import query, table


@query("column_projection", "SELECT c_custkey, c_name FROM customer")
def column_projection(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", "c_name")


@query(
    "top_orders",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
    """,
)
def top_orders(spark, folder):
    since = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    wanted = (
        table(spark, folder, "orders")
        .filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= since))
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )
    return statistics.top(wanted, 100, "o_totalprice", "o_orderkey")


@query(
    "top_per_segment",
    """
    SELECT c_mktsegment, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rn FROM (
        SELECT c_mktsegment, o_orderkey, o_totalprice, row_number() OVER (
               PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM orders JOIN customer ON o_custkey = c_custkey)
    WHERE rn <= 100
    """,
)
def top_per_segment(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    joined = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    picked = joined.select("c_mktsegment", "o_orderkey", "o_totalprice")
    return statistics.top_per_group(picked, ["c_mktsegment"], 100, "o_totalprice", "o_orderkey")


@query(
    "top_of_parts",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
    """,
)
def top_of_parts(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    is_final = F.col("o_orderstatus") == "F"
    parts = [
        statistics.top(part, 100, "o_totalprice", "o_orderkey")
        for part in (orders.filter(is_final), orders.filter(~is_final))
    ]
    return statistics.top(parts[0].unionByName(parts[1]), 100, "o_totalprice", "o_orderkey")


@query("names_like", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%7%1%'")
def names_like(spark, folder):
    return table(spark, folder, "customer").filter(F.col("c_name").like("%7%1%")).select("c_custkey", "c_name")


@query(
    "orders_above",
    "SELECT * FROM orders WHERE o_totalprice > 250000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def orders_above(spark, folder):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return table(spark, folder, "orders").filter((F.col("o_totalprice") > 250_000) & urgent)


@query(
    "customer_orders_join",
    """
    SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_totalprice, o_orderdate
    FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def customer_orders_join(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate"
    )
    return customers.join(orders, "c_custkey", "inner")


@query(
    "region_summary",
    """
    SELECT r_name, count(*) AS customer_count,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avg_balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
    """,
)
def region_summary(spark, folder):
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return statistics.count_and_mean(customers, ["r_name"], "c_acctbal", "customer_count", "avg_balance")


@query(
    "filtered_mean",
    """
    SELECT count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS mean
    FROM orders WHERE o_orderstatus = 'O'
    """,
)
def filtered_mean(spark, folder):
    open_orders = table(spark, folder, "orders").filter("o_orderstatus = 'O'")
    return statistics.count_and_mean(open_orders, [], "o_totalprice", "orders", "mean")


@query(
    "hourly_events",
    "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL",
)
def hourly_events(spark, folder):
    return statistics.hourly(table(spark, folder, "events"))


@query(
    "union_all_names",
    "SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT n_name FROM nation",
)
def union_all_names(spark, folder):
    customers = table(spark, folder, "customer").selectExpr("c_name AS name")
    suppliers = table(spark, folder, "supplier").selectExpr("s_name AS name")
    nations = table(spark, folder, "nation").selectExpr("n_name AS name")
    return customers.unionByName(suppliers).unionByName(nations)


@query(
    "null_and_case_functions",
    """
    SELECT event_id, CASE WHEN value > 100 THEN 'high' WHEN value IS NULL THEN 'none' ELSE 'low' END AS level,
           value IS NOT NULL AND event_type <> '' AS usable, coalesce(value, 0.0) AS value FROM events
    """,
)
def null_and_case_functions(spark, folder):
    value = F.col("value")
    return table(spark, folder, "events").select(
        "event_id",
        F.when(value > 100, "high").when(value.isNull(), "none").otherwise("low").alias("level"),
        (value.isNotNull() & (F.col("event_type") != "")).alias("usable"),
        F.coalesce(value, F.lit(0.0)).alias("value"),
    )
