"""Queries over the profiles, cleaners and filters of the jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import text
from tidegate.operators import audit, profiles, quality
from tidegate.options import ConvertOptions
from tidegate.plans import inputs
from tidegate.plans.jobs import convert, pass_through, standardise
from tidegate.plans.registry import query, table

#: Audit columns that differ from run to run or by version.
VOLATILE = ("_processing_timestamp", "_spark_version")

STANDARD_AUDIT = "'j-1' AS _job_id, 'tidegate' AS _source_system, '7.8.0' AS _emr_version"


def convert_audit(target: str) -> str:
    return (
        f"'j-2' AS _job_id, '{target}' AS _target_name, "
        "'tidegate-1' AS _framework_version, '7.8.0' AS _emr_version"
    )


def squeezed(column: str) -> str:
    return rf"regexp_replace(regexp_replace({column}, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


def collapsed(column: str) -> str:
    return rf"regexp_replace({column}, '\s+', ' ', 'g')"


@query(
    "orders_ingest",
    f"""
    SELECT order_id AS "ORDER_ID", customer_id AS "CUSTOMER_ID", order_date AS "ORDER_DATE",
           amount AS "ORDER_AMOUNT", {collapsed('status')} AS status, {STANDARD_AUDIT}
    FROM {inputs.select('orders', inputs.ORDERS)} WHERE order_id IS NOT NULL AND amount > 0
    """,
)
def orders_ingest(spark, folder):
    df = inputs.columns(spark, folder, "orders", inputs.ORDERS)
    return standardise(df, "ORDERS", "j-1").drop(*VOLATILE)


@query(
    "profile_customers",
    f"""
    SELECT customer_id AS "CUSTOMER_ID", {collapsed('name')} AS "CUSTOMER_NAME",
           {collapsed('email')} AS "EMAIL_ADDRESS", {collapsed('phone')} AS "PHONE_NUMBER",
           region, {STANDARD_AUDIT}
    FROM {inputs.select('customer', inputs.CUSTOMERS)}
    WHERE customer_id IS NOT NULL AND email IS NOT NULL
    """,
)
def profile_customers(spark, folder):
    df = inputs.columns(spark, folder, "customer", inputs.CUSTOMERS)
    return standardise(df, "CUSTOMER_ORDERS", "j-1").drop(*VOLATILE)


@query(
    "profile_products",
    f"""
    SELECT product_id AS "PRODUCT_ID", {collapsed('name')} AS "PRODUCT_NAME",
           {collapsed('category')} AS "CATEGORY", price AS "PRICE", {STANDARD_AUDIT}
    FROM {inputs.select('part', inputs.PRODUCTS)} WHERE product_id IS NOT NULL
    """,
)
def profile_products(spark, folder):
    df = inputs.columns(spark, folder, "part", inputs.PRODUCTS)
    return standardise(df, "products_v2", "j-1").drop(*VOLATILE)


@query(
    "profile_analytics",
    f"""
    SELECT event_id AS "EVENT_ID", user_id AS "USER_ID", event_type AS "EVENT_TYPE",
           "timestamp" AS "EVENT_TIMESTAMP", {collapsed('properties')} AS "EVENT_PROPERTIES",
           {STANDARD_AUDIT}
    FROM {inputs.select('events', inputs.EVENTS)}
    WHERE event_id IS NOT NULL AND event_type IS NOT NULL
    """,
)
def profile_analytics(spark, folder):
    df = inputs.columns(spark, folder, "events", inputs.EVENTS)
    return standardise(df, "ANALYTICS_EVENTS", "j-1").drop(*VOLATILE)


@query(
    "profile_unknown_target",
    f"SELECT s_suppkey, {collapsed('s_name')} AS s_name, s_nationkey, s_acctbal, {STANDARD_AUDIT} FROM supplier",
)
def profile_unknown_target(spark, folder):
    return standardise(table(spark, folder, "supplier"), "SUPPLIERS", "j-1").drop(*VOLATILE)


@query(
    "convert_customers",
    rf"""
    SELECT customer_id, {squeezed('name')} AS name, lower({squeezed('email')}) AS email,
           regexp_replace({squeezed('phone')}, '[^\d]', '', 'g') AS phone,
           {squeezed('region')} AS region, {convert_audit('CUSTOMERS')}
    FROM {inputs.select('customer', inputs.CUSTOMERS)}
    """,
)
def convert_customers(spark, folder):
    df = inputs.columns(spark, folder, "customer", inputs.CUSTOMERS)
    return convert(df, "CUSTOMERS", "j-2", ConvertOptions(clean_strings=True)).drop(*VOLATILE)


@query(
    "convert_orders",
    f"""
    SELECT order_id, customer_id, order_date, coalesce(amount, 0.0) AS amount, status,
           {convert_audit('ORDERS')}
    FROM {inputs.select('orders', inputs.ORDERS)}
    """,
)
def convert_orders(spark, folder):
    df = inputs.columns(spark, folder, "orders", inputs.ORDERS)
    return convert(df, "ORDERS", "j-2").drop(*VOLATILE)


@query(
    "convert_products",
    f"""
    SELECT product_id, category, price, {convert_audit('PRODUCTS')},
           array_to_string(list_transform(string_split(lower(product_name), ' '),
                           lambda w: upper(w[1]) || w[2:]), ' ') AS product_name
    FROM {inputs.select('part', inputs.NAMED_PRODUCTS)}
    """,
)
def convert_products(spark, folder):
    df = inputs.columns(spark, folder, "part", inputs.NAMED_PRODUCTS)
    return convert(df, "PRODUCTS", "j-2").drop(*VOLATILE)


@query(
    "pass_through_events",
    f"""
    SELECT *, 'j-3' AS _job_id, 'tidegate-local' AS _source_system
    FROM {inputs.select('events', inputs.HOLLOW_EVENTS)}
    WHERE event_type IS NOT NULL OR value IS NOT NULL OR props IS NOT NULL OR user_id IS NOT NULL
    """,
)
def pass_through_events(spark, folder):
    df = inputs.columns(spark, folder, "events", inputs.HOLLOW_EVENTS)
    return pass_through(df, "j-3").drop(*VOLATILE)


@query(
    "drop_all_null",
    f"""
    SELECT * FROM {inputs.select('events', inputs.HOLLOW_EVENTS)}
    WHERE NOT (event_type IS NULL AND value IS NULL AND props IS NULL AND user_id IS NULL)
    """,
)
def drop_all_null(spark, folder):
    return quality.drop_null_rows(inputs.columns(spark, folder, "events", inputs.HOLLOW_EVENTS))


@query(
    "drop_all_empty",
    f"""
    SELECT * FROM (
        SELECT balance, {squeezed('name')} AS name, {squeezed('region')} AS region
        FROM {inputs.select('customer', inputs.BLANK_CUSTOMERS)})
    WHERE balance IS NOT NULL OR coalesce(name, '') <> '' OR coalesce(region, '') <> ''
    """,
)
def drop_all_empty(spark, folder):
    df = inputs.columns(spark, folder, "customer", inputs.BLANK_CUSTOMERS)
    return quality.drop_empty_rows(quality.squeeze_text(df))


@query(
    "drop_all_empty_uncleaned",
    f"""
    SELECT * FROM {inputs.select('customer', inputs.BLANK_CUSTOMERS)}
    WHERE balance IS NOT NULL OR coalesce(name, '') <> '' OR coalesce(region, '') <> ''
    """,
)
def drop_all_empty_uncleaned(spark, folder):
    return quality.drop_empty_rows(inputs.columns(spark, folder, "customer", inputs.BLANK_CUSTOMERS))


@query(
    "squeeze_documents",
    f"SELECT doc_id, {squeezed('text')} AS text, {squeezed('lang')} AS lang, "
    f"{squeezed('source')} AS source, n_chars FROM documents",
)
def squeeze_documents(spark, folder):
    return quality.squeeze_text(table(spark, folder, "documents"))


@query(
    "phone_digits",
    r"SELECT page_id, regexp_replace(url, '[^\d]', '', 'g') AS digits FROM pages",
)
def phone_digits(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.digits_only(F.col("url")).alias("digits"))


@query(
    "quality_stats",
    f"""
    SELECT count(*) AS input_records,
           count(*) FILTER (order_id IS NOT NULL AND amount > 0) AS output_records,
           count(*) - count(*) FILTER (order_id IS NOT NULL AND amount > 0) AS data_quality_issues
    FROM {inputs.select('orders', inputs.ORDERS)}
    """,
)
def quality_stats(spark, folder):
    df = profiles.ORDERS.rename(inputs.columns(spark, folder, "orders", inputs.ORDERS))
    return quality.quality_counts(df, profiles.ORDERS.keep())


@query(
    "empty_rows_removed",
    f"""
    SELECT count(*) AS input_records,
           count(*) FILTER (balance IS NOT NULL OR coalesce(name, '') <> '' OR coalesce(region, '') <> '')
               AS output_records,
           count(*) FILTER (balance IS NULL AND coalesce(name, '') = '' AND coalesce(region, '') = '')
               AS data_quality_issues
    FROM {inputs.select('customer', inputs.BLANK_CUSTOMERS)}
    """,
)
def empty_rows_removed(spark, folder):
    df = inputs.columns(spark, folder, "customer", inputs.BLANK_CUSTOMERS)
    return quality.quality_counts(df, quality.has_content(df))


@query(
    "row_id_unique",
    "SELECT count(*) AS rows, count(*) AS ids FROM lineitem",
)
def row_id_unique(spark, folder):
    numbered = audit.add_row_id(table(spark, folder, "lineitem").select("l_orderkey"))
    return numbered.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_row_id").alias("ids")
    )


_REQUIRED = ("customer_id", "name", "email", "signup_year")


@query(
    "required_fields_report",
    f"""
    WITH c AS (SELECT * FROM {inputs.select('customer', inputs.CUSTOMERS)})
    SELECT 'customer_id' AS field, true AS present, count(*) FILTER (customer_id IS NULL) AS missing_rows,
           count(*) AS total_rows FROM c
    UNION ALL SELECT 'name', true, count(*) FILTER (name IS NULL), count(*) FROM c
    UNION ALL SELECT 'email', true, count(*) FILTER (email IS NULL), count(*) FROM c
    UNION ALL SELECT 'signup_year', false, count(*), count(*) FROM c
    """,
)
def required_fields_report(spark, folder):
    df = inputs.columns(spark, folder, "customer", inputs.CUSTOMERS)
    return quality.required_fields_report(df, _REQUIRED)


@query(
    "required_fields_rows",
    f"""
    SELECT * FROM {inputs.select('customer', inputs.CUSTOMERS)}
    WHERE customer_id IS NOT NULL AND name IS NOT NULL AND email IS NOT NULL
    """,
)
def required_fields_rows(spark, folder):
    df = inputs.columns(spark, folder, "customer", inputs.CUSTOMERS)
    return df.filter(quality.has_required(df, ("customer_id", "name", "email")))
