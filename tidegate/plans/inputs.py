"""Domain tables made from the given ones, with faults to find.

Each column is one expression that Spark and ANSI SQL read the same way, so a query and its
SQL start from the same rows. Faults are spread over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.plans.registry import table

CUSTOMERS = (
    "CASE WHEN c_custkey % 101 = 7 THEN NULL ELSE c_custkey END AS customer_id",
    "concat('  ', c_name, '   x ') AS name",
    "CASE WHEN c_custkey % 13 = 5 THEN NULL ELSE concat('User', c_custkey, '@Example.COM') END AS email",
    "concat('+1 (555) ', c_custkey, '-', c_nationkey) AS phone",
    "c_mktsegment AS region",
)

ORDERS = (
    "o_orderkey AS order_id",
    "o_custkey AS customer_id",
    "o_orderdate AS order_date",
    "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN -o_totalprice "
    "ELSE o_totalprice END AS amount",
    "concat('  ', o_orderpriority, '   x ') AS status",
)

PRODUCTS = (
    "CASE WHEN p_partkey % 53 = 2 THEN NULL ELSE p_partkey END AS product_id",
    "concat(' ', p_name, '  ', p_brand) AS name",
    "p_type AS category",
    "p_retailprice AS price",
)

NAMED_PRODUCTS = (
    "p_partkey AS product_id",
    "upper(p_name) AS product_name",
    "p_type AS category",
    "p_retailprice AS price",
)

EVENTS = (
    "CASE WHEN event_id % 31 = 3 THEN NULL ELSE event_id END AS event_id",
    "user_id AS user_id",
    "CASE WHEN event_id % 17 = 4 THEN NULL ELSE event_type END AS event_type",
    "ts AS timestamp",
    "concat(props, '   ', event_type, ' ') AS properties",
)

#: Some rows have nothing at all.
HOLLOW_EVENTS = tuple(
    f"CASE WHEN event_id % 11 = 6 THEN NULL ELSE {c} END AS {c}"
    for c in ("event_type", "value", "props", "user_id")
)

#: Some rows have only nulls and empty or blank text.
BLANK_CUSTOMERS = (
    "CASE WHEN c_custkey % 10 < 3 THEN NULL ELSE c_acctbal END AS balance",
    "CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN '   ' "
    "WHEN c_custkey % 10 = 3 THEN '' ELSE concat(c_name, '  .') END AS name",
    "CASE WHEN c_custkey % 10 < 3 THEN NULL ELSE c_mktsegment END AS region",
)


def columns(spark: SparkSession, folder: str, name: str, expressions: tuple[str, ...]) -> DataFrame:
    return table(spark, folder, name).selectExpr(*expressions)


def select(name: str, expressions: tuple[str, ...]) -> str:
    """The same columns as a SQL subquery."""
    return f"(SELECT {', '.join(expressions)} FROM {name})"


def pieces(df: DataFrame, rows: int) -> int:
    """Pieces of about ``rows`` rows that a table makes, one at least."""
    return max(1, -(-df.count() // rows))


def spread(df: DataFrame, count: int) -> DataFrame:
    """Rows dealt in turn to ``count`` tasks, which are as large as each other; nothing is sorted."""
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(count)).cast("int")
    return df.select("*", turn.alias("__turn")).repartitionById(count, "__turn").drop("__turn")
