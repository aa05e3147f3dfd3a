"""Queries that write given tables as files and read, list or count those files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import jsontext, paths, values
from tidegate.operators import loads, tables, tracking, validation
from tidegate.options import ConvertOptions
from tidegate.plans import inputs, jobs
from tidegate.plans.q_profiles import collapsed
from tidegate.plans.registry import query, table
from tidegate.session import work_folder
from tidegate.sinks import files as sink
from tidegate.sources import file_digests, inventory, listing, readers, split_files

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _typed_orders(df):
    """Orders in their own types, whatever a reader inferred."""
    return df.select(
        F.col("o_orderkey").cast("bigint"),
        F.col("o_custkey").cast("bigint"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double"),
        F.col("o_orderdate").cast("timestamp_ntz"),
        "o_orderpriority",
    )


@query("csv_scan", ORDERS_SQL)
def csv_scan(spark, folder):
    path = work_folder(spark, "csv")
    sink.write(table(spark, folder, "orders"), path, "CSV", "none")
    return _typed_orders(readers.read(spark, path, "csv"))


QUOTED = (
    "c_custkey AS id",
    "concat(c_name, ' \"x\"; ', chr(10), c_mktsegment, '; ') AS name",
    "c_acctbal AS balance",
)


@query("csv_dialect_scan", f"SELECT * FROM {inputs.select('customer', QUOTED)}")
def csv_dialect_scan(spark, folder):
    path = work_folder(spark, "dialect")
    dialect = ConvertOptions(delimiter=";")
    sink.write(
        inputs.columns(spark, folder, "customer", QUOTED),
        path,
        "CSV",
        "none",
        options={"sep": ";", "escape": '"', "ignoreTrailingWhiteSpace": "false"},
    )
    return readers.read_csv(spark, path, dialect).select(
        F.col("id").cast("bigint"), "name", F.col("balance").cast("double")
    )


@query("tsv_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def tsv_scan(spark, folder):
    path = work_folder(spark, "tsv")
    sink.write(table(spark, folder, "supplier"), path, "CSV", "none", options={"sep": "\t"})
    schema = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    return readers.read(spark, path, "TSV", schema)


@query("compressed_csv_scan", ORDERS_SQL)
def compressed_csv_scan(spark, folder):
    path = work_folder(spark, "gzip")
    orders = table(spark, folder, "orders")
    sink.write(orders, path, "CSV", "gzip")
    return _typed_orders(readers.read(spark, path, "CSV"))


@query(
    "json_scan",
    "SELECT event_id, date_trunc('milliseconds', ts) AS ts, user_id, event_type, value, props FROM events",
)
def json_scan(spark, folder):
    path = work_folder(spark, "json")
    sink.write(table(spark, folder, "events"), path, "JSON", "none")
    return readers.read(spark, path, "JSON").select(
        "event_id", F.col("ts").cast("timestamp_ntz"), "user_id", "event_type", "value", "props"
    )


@query(
    "json_lines_options_scan",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, "
    "l_returnflag FROM lineitem",
)
def json_lines_options_scan(spark, folder):
    path = work_folder(spark, "jsonl")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    sink.write(lines, path, "JSON", "none")
    return readers.read(spark, path, "JSONL", options={"primitivesAsString": "true"})


#: Customers per JSON array file.
ARRAY_ROWS = 5_000


def _array_files(spark, folder, pretty):
    """Customers as files of one JSON array each; every array has a bounded number of rows."""
    path = work_folder(spark, "arrays")
    part = F.floor(F.col("c_custkey") / ARRAY_ROWS)
    arrays = (
        table(spark, folder, "customer")
        .groupBy(part.alias("part"))
        .agg(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal")).alias("rows"))
        .select("part", F.to_json("rows", {"pretty": str(pretty).lower()}).alias("value"))
    )
    arrays.write.partitionBy("part").text(path)
    return path


@query("json_array_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_array_scan(spark, folder):
    path = _array_files(spark, folder, pretty=True)
    schema = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE"
    return readers.read(spark, path, "JSON_ARRAY", schema).drop("part")


@query(
    "parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
    "WHERE l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' AND l_quantity > 25",
)
def parquet_scan(spark, folder):
    items = readers.read(spark, f"{folder}/lineitem.parquet", "parquet")
    late = F.col("l_shipdate") >= F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return items.filter(late & (F.col("l_quantity") > 25)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query("registered_format_scan", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def registered_format_scan(spark, folder):
    path = work_folder(spark, "orc")
    sink.write_registered(table(spark, folder, "part"), "orc", path)
    return readers.read_registered(spark, "orc", path)


@query("sink_parquet", "SELECT * FROM lineitem")
def sink_parquet(spark, folder):
    path = work_folder(spark, "parquet")
    sink.write(table(spark, folder, "lineitem"), path, "PARQUET", "zstd")
    return spark.read.parquet(path)


@query("sink_json", ORDERS_SQL)
def sink_json(spark, folder):
    path = work_folder(spark, "json")
    sink.write(table(spark, folder, "orders"), path, "JSON", "gzip")
    return _typed_orders(spark.read.json(path))


@query("sink_csv", "SELECT event_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS VARCHAR) AS ts FROM events")
def sink_csv(spark, folder):
    path = work_folder(spark, "csv")
    events = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp"))
    sink.write(events, path, "CSV", "gzip")
    return spark.read.option("header", "true").schema("event_id BIGINT, ts STRING").csv(path)


@query(
    "sink_partitioned",
    "SELECT l_returnflag, l_linestatus, count(*) AS rows, "
    "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY ALL",
)
def sink_partitioned(spark, folder):
    path = work_folder(spark, "partitioned")
    sink.write(
        table(spark, folder, "lineitem"), path, partition_by=("l_returnflag", "l_linestatus")
    )
    written = spark.read.parquet(path)
    return written.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
    )


@query("sink_row_cap", "SELECT count(*) AS rows, true AS within_cap FROM lineitem")
def sink_row_cap(spark, folder):
    path = work_folder(spark, "capped")
    sink.write(table(spark, folder, "lineitem"), path, max_records_per_file=sink.ROWS_PER_FILE)
    per_file = inventory.count_rows(spark, path, "PARQUET")
    return per_file.agg(
        F.sum("records").alias("rows"), (F.max("records") <= sink.ROWS_PER_FILE).alias("within_cap")
    )


@query(
    "sink_with_marker",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'local-test' AS _job_id, "
    "'tidegate-local' AS _source_system FROM supplier",
)
def sink_with_marker(spark, folder):
    path = work_folder(spark, "marked")
    data = sink.write_with_marker(jobs.pass_through(table(spark, folder, "supplier"), "local-test"), path)
    return spark.read.parquet(data).drop("_processing_timestamp")


@query(
    "sink_by_target",
    "SELECT upper(event_type) AS target_name, "
    "concat('s3://out/processed/', upper(event_type)) AS processed, "
    "concat('s3://stage/staging/', upper(event_type)) AS staging, count(*) AS rows "
    "FROM events GROUP BY ALL",
)
def sink_by_target(spark, folder):
    path = work_folder(spark, "targets")
    events = table(spark, folder, "events").withColumn("target_name", F.upper("event_type"))
    sink.write(events, path, partition_by=("target_name",))
    target = F.col("target_name")
    return (
        spark.read.parquet(path)
        .groupBy("target_name")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumns(
            {
                "processed": paths.target_location("s3://out", "processed", target),
                "staging": paths.target_location("s3://stage/", "staging", target),
            }
        )
    )


# No line starts with "[", which would make its file an array.
DAMAGED = (
    "event_type",
    "CASE WHEN event_id % 7 = 1 THEN concat(props, ' x') WHEN event_id % 9 = 2 THEN replace(props, '}', '') "
    "WHEN event_id % 11 = 3 THEN '' WHEN event_id % 13 = 4 THEN concat('  ', props, '  ') "
    "WHEN event_id % 17 = 5 THEN concat(props, ', ', props) WHEN event_id % 19 = 6 THEN '\"[1, 2]\"' "
    "WHEN event_id % 23 = 7 THEN '12' ELSE props END AS value",
)


@query(
    "count_json_lines",
    f"""
    SELECT event_type, count(*) FILTER (trim(value) <> '' AND json_valid(value)) AS records
    FROM {inputs.select('events', DAMAGED)} GROUP BY event_type
    """,
)
def count_json_lines(spark, folder):
    path = work_folder(spark, "lines")
    inputs.columns(spark, folder, "events", DAMAGED).write.partitionBy("event_type").text(path)
    kind = F.regexp_extract("path", "event_type=([^/]*)/", 1)
    return (
        inventory.count_json(spark, path)
        .groupBy(kind.alias("event_type"))
        .agg(F.sum("records").alias("records"))
    )


@query(
    "valid_json_values",
    f"""
    SELECT event_type, count(*) AS rows, count(*) FILTER (trim(value) <> '' AND json_valid(value)) AS valid
    FROM {inputs.select('events', DAMAGED)} GROUP BY event_type
    """,
)
def valid_json_values(spark, folder):
    damaged = inputs.columns(spark, folder, "events", DAMAGED)
    return damaged.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), inventory.valid_json_lines(F.col("value")).alias("valid")
    )


@query(
    "count_json_arrays",
    f"SELECT CAST(floor(c_custkey / {ARRAY_ROWS}) AS BIGINT) AS part, count(*) AS records, "
    "CAST(NULL AS VARCHAR) AS error FROM customer GROUP BY ALL",
)
def count_json_arrays(spark, folder):
    path = _array_files(spark, folder, pretty=True)
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint")
    return inventory.count_json(spark, path).select(part.alias("part"), "records", "error")


@query(
    "count_json_arrays_one_line",
    f"SELECT CAST(floor(c_custkey / {ARRAY_ROWS}) AS BIGINT) AS part, count(*) AS records "
    "FROM customer GROUP BY ALL",
)
def count_json_arrays_one_line(spark, folder):
    path = _array_files(spark, folder, pretty=False)
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint")
    return inventory.count_records(spark, path, "JSON").select(part.alias("part"), "records")


@query("count_csv_lines", "SELECT o_orderstatus, count(*) AS records FROM orders GROUP BY o_orderstatus")
def count_csv_lines(spark, folder):
    path = work_folder(spark, "counted")
    sink.write(table(spark, folder, "orders"), path, "CSV", "gzip", partition_by=("o_orderstatus",))
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1)
    return (
        inventory.count_records(spark, path, "CSV")
        .groupBy(status.alias("o_orderstatus"))
        .agg(F.sum("records").alias("records"))
    )


@query(
    "count_lines_and_rows",
    "SELECT count(*) AS records, 2 * count(*) AS physical_lines FROM customer",
)
def count_lines_and_rows(spark, folder):
    path = work_folder(spark, "multiline")
    sink.write(
        inputs.columns(spark, folder, "customer", QUOTED), path, "CSV", "none", options={"escape": '"'}
    )
    lines = inventory.count_lines(spark, path, True).withColumnRenamed("records", "physical_lines")
    rows = inventory.count_rows(
        spark,
        path,
        "CSV",
        "id BIGINT, name STRING, balance DOUBLE",
        {"multiLine": "true", "escape": '"'},
    )
    return rows.join(lines, "path").agg(
        F.sum("records").alias("records"), F.sum("physical_lines").alias("physical_lines")
    )


@query("count_parquet_rows", "SELECT count(*) AS records FROM lineitem")
def count_parquet_rows(spark, folder):
    counted = inventory.count_records(spark, f"{folder}/lineitem.parquet", "PARQUET")
    return counted.agg(F.sum("records").alias("records"))


@query(
    "count_jsonl_lines",
    "SELECT count(*) AS records FROM events",
)
def count_jsonl_lines(spark, folder):
    path = work_folder(spark, "jsonl")
    sink.write(table(spark, folder, "events"), path, "JSON", "none")
    return inventory.count_records(spark, path, "JSONL").agg(F.sum("records").alias("records"))


@query(
    "file_inventory",
    "SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS size FROM documents GROUP BY lang",
)
def file_inventory(spark, folder):
    path = work_folder(spark, "texts")
    table(spark, folder, "documents").select("lang", "text").write.partitionBy("lang").text(path)
    lang = F.regexp_extract("path", "lang=([^/]*)/", 1)
    return inventory.list_files(spark, path).groupBy(lang.alias("lang")).agg(F.sum("size").alias("size"))


TREE_SQL = """
    SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS size, 0 AS empty FROM documents GROUP BY lang
    UNION ALL SELECT 'none', 0, 1
"""


def _tree(spark, folder):
    """Texts by language, and a folder with one file of length zero."""
    path = work_folder(spark, "tree")
    texts = table(spark, folder, "documents").select("lang", "text")
    texts.write.partitionBy("lang").text(path)
    texts.select("text").where("false").coalesce(1).write.text(f"{path}/lang=none")
    return path


def _by_language(files, name):
    lang = F.regexp_extract(name, "lang=([^/]*)/", 1)
    empty = F.count_if(F.col("size") == 0).cast("int")
    return files.groupBy(lang.alias("lang")).agg(F.sum("size").alias("size"), empty.alias("empty"))


@query("listed_tree", TREE_SQL)
def listed_tree(spark, folder):
    return _by_language(listing.list_tree(spark, _tree(spark, folder)), "key")


@query("looked_up_files", TREE_SQL)
def looked_up_files(spark, folder):
    """Files that are there, and as many names of files that are not."""
    files = listing.list_tree(spark, _tree(spark, folder), tasks=2).select("path")
    named = files.union(files.select(F.concat("path", F.lit(".gone"))))
    found = work_folder(spark, "found")
    listing.lookup(named, "path").write.parquet(found)
    return _by_language(spark.read.parquet(found), "file_path")


@query(
    "header_columns",
    "SELECT o_orderstatus, 5 AS column_count, "
    "'Column count mismatch: expected 6, got 5' AS error FROM orders GROUP BY ALL",
)
def header_columns(spark, folder):
    path = work_folder(spark, "headers")
    sink.write(table(spark, folder, "orders"), path, "CSV", "none", partition_by=("o_orderstatus",))
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1)
    return (
        inventory.header_columns(spark, path)
        .select(
            status.alias("o_orderstatus"),
            "column_count",
            validation.column_count_error(F.lit(6), F.col("column_count")).alias("error"),
        )
        .distinct()
    )


@query(
    "lines_and_columns",
    "SELECT o_orderstatus, 5 AS column_count, count(*) AS records FROM orders GROUP BY ALL",
)
def lines_and_columns(spark, folder):
    path = work_folder(spark, "headers")
    sink.write(table(spark, folder, "orders"), path, "CSV", "none", partition_by=("o_orderstatus",))
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1)
    counted = inventory.lines_and_columns(spark, path)
    return counted.groupBy(status.alias("o_orderstatus"), "column_count").agg(F.sum("records").alias("records"))


@query(
    "content_checksums",
    """
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN md5(html) WHEN 1 THEN sha1(html) ELSE sha256(html) END AS digest
    FROM pages
    """,
)
def content_checksums(spark, folder):
    body = F.encode("html", "UTF-8")
    promised = (
        F.when(F.col("page_id") % 3 == 0, F.md5(body))
        .when(F.col("page_id") % 3 == 1, F.sha1(body))
        .otherwise(F.sha2(body, 256))
    )
    return table(spark, folder, "pages").select("page_id", values.checksum(body, promised).alias("digest"))


@query(
    "json_array_sizes",
    "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size FROM embeddings",
)
def json_array_sizes(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return vectors.select("vec_id", jsontext.array_size(F.to_json("embedding")).alias("size"))


CSV_ORDERS = "order_id BIGINT, customer_id BIGINT, order_date TIMESTAMP_NTZ, amount DOUBLE, status STRING"


def _order_files(spark, folder):
    path = work_folder(spark, "orders")
    sink.write(
        inputs.columns(spark, folder, "orders", inputs.ORDERS),
        path,
        "CSV",
        "none",
        options={"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"},
    )
    return path


@query(
    "standard_job",
    f"""
    SELECT order_id AS "ORDER_ID", customer_id AS "CUSTOMER_ID", order_date AS "ORDER_DATE",
           amount AS "ORDER_AMOUNT", {collapsed('status')} AS status, 'j-1' AS _job_id
    FROM {inputs.select('orders', inputs.ORDERS)} WHERE order_id IS NOT NULL AND amount > 0
    """,
)
def standard_job(spark, folder):
    source, out = _order_files(spark, folder), work_folder(spark, "standard")
    jobs.run_standard(spark, source, out, "ORDERS", "j-1", schema=CSV_ORDERS)
    columns = ("ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "ORDER_AMOUNT", "status", "_job_id")
    return spark.read.parquet(out).select(*columns)


@query(
    "standard_job_stats",
    f"""
    SELECT count(*) AS input_records, count(*) FILTER (amount > 0) AS output_records,
           count(*) - count(*) FILTER (amount > 0) AS data_quality_issues
    FROM {inputs.select('orders', inputs.ORDERS)}
    """,
)
def standard_job_stats(spark, folder):
    source, out = _order_files(spark, folder), work_folder(spark, "standard")
    stats = jobs.run_standard(spark, source, out, "ORDERS", "j-1", schema=CSV_ORDERS)
    return stats.frame(spark).select("input_records", "output_records", "data_quality_issues")


@query(
    "convert_job_partitioned",
    f"""
    SELECT order_id, customer_id, order_date, coalesce(amount, 0.0) AS amount,
           trim({collapsed('status')}) AS status, 'csv-to-parquet' AS _job_id, 'ORDERS_PARQUET' AS _target_name
    FROM {inputs.select('orders', inputs.ORDERS)}
    """,
)
def convert_job_partitioned(spark, folder):
    source, out = _order_files(spark, folder), work_folder(spark, "converted")
    options = ConvertOptions.from_params(
        {"clean-strings": "true", "add-row-id": "true", "partition-by": " status ", "compression": "gzip"}
    )
    jobs.run_convert(spark, source, out, "ORDERS_PARQUET", options=options, schema=CSV_ORDERS)
    columns = ("order_id", "customer_id", "order_date", "amount", "status", "_job_id", "_target_name")
    return spark.read.parquet(out).select(*columns)


LOADABLE = {
    "no order id": "order_id IS NOT NULL",
    "no amount": "amount IS NOT NULL",
    "amount not positive": "amount > 0",
}


def _loadable(spark, folder):
    orders = inputs.columns(spark, folder, "orders", inputs.ORDERS)
    return validation.with_reason(orders, {name: F.expr(test) for name, test in LOADABLE.items()})


@query(
    "reject_reasons",
    f"""
    SELECT CASE WHEN order_id IS NULL THEN 'no order id' WHEN amount IS NULL THEN 'no amount'
                WHEN amount <= 0 THEN 'amount not positive' END AS reject_reason, count(*) AS rows
    FROM {inputs.select('orders', inputs.ORDERS)} GROUP BY ALL
    """,
)
def reject_reasons(spark, folder):
    return _loadable(spark, folder).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "load_target",
    f"""
    SELECT 'ORDERS' AS target_name, count(*) FILTER (amount > 0) AS loaded_records,
           count(*) - count(*) FILTER (amount > 0) AS rejected_records
    FROM {inputs.select('orders', inputs.ORDERS)}
    """,
)
def load_target(spark, folder):
    result = tables.load(_loadable(spark, folder), "ORDERS", work_folder(spark, "load"))
    row = (result.target_name, result.loaded_records, result.rejected_records)
    return spark.createDataFrame([row], "target_name STRING, loaded_records BIGINT, rejected_records BIGINT")


@query(
    "load_in_parts",
    f"""
    SELECT order_id, amount, CASE WHEN order_id % 2 = 0 THEN 'even' ELSE 'odd' END AS load_id
    FROM {inputs.select('orders', inputs.ORDERS)} WHERE amount > 0 AND order_id IS NOT NULL
    """,
)
def load_in_parts(spark, folder):
    """Two loads into one table, the second of them run twice."""
    path, rows = work_folder(spark, "load"), _loadable(spark, folder)
    for part, name in ((0, "even"), (1, "odd"), (1, "odd")):
        tables.load(rows.filter(F.col("order_id") % 2 == part), "ORDERS", path, name)
    return spark.read.parquet(path).filter("load_status = 'loaded'").select("order_id", "amount", "load_id")


@query(
    "dead_letter_rows",
    f"""
    SELECT *, CASE WHEN amount IS NULL THEN 'no amount' ELSE 'amount not positive' END AS reject_reason
    FROM {inputs.select('orders', inputs.ORDERS)} WHERE amount IS NULL OR amount <= 0
    """,
)
def dead_letter_rows(spark, folder):
    result = tables.load(_loadable(spark, folder), "ORDERS", work_folder(spark, "load"))
    return spark.read.parquet(result.rejected_path)


@query("split_csv_scan", f"SELECT * FROM {inputs.select('customer', QUOTED)}")
def split_csv_scan(spark, folder):
    """Quoted line breaks in files that many tasks read; converted, so the result has no Python."""
    path, out = work_folder(spark, "split-csv"), work_folder(spark, "converted")
    sink.write(
        inputs.columns(spark, folder, "customer", QUOTED),
        path,
        "CSV",
        "none",
        options={"sep": ";", "escape": '"', "ignoreTrailingWhiteSpace": "false"},
    )
    dialect = ConvertOptions(delimiter=";", split=True)
    sink.write(readers.read_csv(spark, path, dialect, "id BIGINT, name STRING, balance DOUBLE"), out)
    return spark.read.parquet(out)


@query("split_array_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def split_array_scan(spark, folder):
    path, out = _array_files(spark, folder, pretty=True), work_folder(spark, "converted")
    schema = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE"
    sink.write(split_files.read_json_arrays(spark, path, schema), out)
    return spark.read.parquet(out)


def _page_files(spark, folder):
    """Pages as files of one line each, ten folders of them."""
    path = work_folder(spark, "page-files")
    pages = table(spark, folder, "pages").where("length(html) > 0")
    joined = pages.groupBy((F.col("page_id") % 10).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "url"))), lambda p: p["url"]), "\n").alias("value")
    )
    joined.write.partitionBy("part").text(path)
    return path


PAGE_FILES_SQL = """
    SELECT page_id % 10 AS part, string_agg(url, chr(10) ORDER BY page_id) || chr(10) AS body
    FROM pages WHERE length(html) > 0 AND url IS NOT NULL GROUP BY ALL
"""


@query(
    "chunked_digests",
    f"""
    SELECT part, CAST(strlen(body) AS BIGINT) AS size, md5(body) AS md5, sha1(body) AS sha1, sha256(body) AS sha256
    FROM ({PAGE_FILES_SQL})
    """,
)
def chunked_digests(spark, folder):
    """Files beyond the largest value (lowered here), read in chunks by several tasks."""
    path, out = _page_files(spark, folder), work_folder(spark, "digests")
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint")
    found = inventory.digests(spark, path, most_bytes=10)
    found.select(part.alias("part"), "size", "md5", "sha1", "sha256").write.parquet(out)
    return spark.read.parquet(out)


@query(
    "part_etags",
    f"""
    SELECT part, CAST(ceil(strlen(body) / 400.0) AS BIGINT) AS parts,
           CASE WHEN strlen(body) <= 400 THEN md5(body) ELSE
             md5(unhex(array_to_string(list_transform(range(0, CAST(ceil(strlen(body) / 400.0) AS BIGINT)),
                 lambda i: md5(substr(body, 400 * i + 1, 400))), '')))
             || '-' || CAST(ceil(strlen(body) / 400.0) AS BIGINT) END AS etag
    FROM ({PAGE_FILES_SQL}) WHERE strlen(body) = length(body)
    """,
)
def part_etags(spark, folder):
    path, out = _page_files(spark, folder), work_folder(spark, "etags")
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint")
    found = file_digests.part_etags(spark, path, 400)
    found.select(part.alias("part"), "parts", "etag").write.parquet(out)
    return spark.read.parquet(out)


@query(
    "published_loads",
    f"""
    SELECT order_id, amount, CASE WHEN order_id % 2 = 0 THEN 'even' ELSE 'odd' END AS load_id
    FROM {inputs.select('orders', inputs.ORDERS)} WHERE amount > 0 AND order_id IS NOT NULL
    """,
)
def published_loads(spark, folder):
    """Two loads, one of them asked for again with other rows after it was published."""
    path, rows = work_folder(spark, "published"), _loadable(spark, folder)
    for part, name in ((0, "even"), (1, "odd"), (0, "odd")):
        loads.load(rows.filter(F.col("order_id") % 2 == part), "ORDERS", path, name)
    return loads.read_loaded(spark, path).select("order_id", "amount", "load_id")


@query(
    "load_states",
    f"""
    SELECT file_path, 'COMPLETED' AS orchestration_state, loaded_records, rejected_records FROM (
        SELECT 's3://in/orders-' || (order_id % 3) || '.csv' AS file_path,
               count(*) FILTER (amount > 0) AS loaded_records,
               count(*) - count(*) FILTER (amount > 0) AS rejected_records
        FROM {inputs.select('orders', inputs.ORDERS)} GROUP BY order_id % 3
    )
    """,
)
def load_states(spark, folder):
    """A load per file; the state of each file as its log tells it."""
    path, log = work_folder(spark, "published"), work_folder(spark, "log")
    rows, results = _loadable(spark, folder), []
    for part in range(3):
        name = f"s3://in/orders-{part}.csv"
        files = spark.createDataFrame([(name, "job-9")], "file_path STRING, job_id STRING")
        done = loads.load(rows.filter(F.col("order_id") % 3 == part), "ORDERS", path, f"load-{part}", files, log)
        results.append((name, done.loaded_records, done.rejected_records))
    counts = spark.createDataFrame(results, "file_path STRING, loaded_records BIGINT, rejected_records BIGINT")
    records = tracking.fold(tracking.read_log(spark, log), 3).select("file_path", "orchestration_state")
    return records.join(counts, "file_path")
