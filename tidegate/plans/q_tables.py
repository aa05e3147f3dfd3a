"""Queries over whole-table operations: upsert, append, as-of reads, compaction, statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidegate.functions.partitioning import PartitionField, SortField, with_partitions
from tidegate.operators import differences, packing, statistics, tables, zones
from tidegate.plans import inputs
from tidegate.plans.registry import query, table
from tidegate.session import work_folder
from tidegate.sinks import files as sink
from tidegate.sources import inventory

#: Rows of a large file of the tables that are made here, whatever the size of the input.
FILE_ROWS = 2_000_000

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

# New prices of orders, made from their items; some are for orders that do not exist yet.
NEW_KEY = "CASE WHEN l_orderkey % 10 = 3 THEN l_orderkey + 1000000000000 ELSE l_orderkey END"
CHANGES_SQL = f"""
    SELECT {NEW_KEY} AS o_orderkey, min(l_suppkey) AS o_custkey, 'M' AS o_orderstatus,
           max(l_extendedprice) * 4 AS o_totalprice, max(l_shipdate) AS o_orderdate,
           '0-MERGED' AS o_orderpriority
    FROM lineitem GROUP BY {NEW_KEY}
"""


def changes(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.expr(NEW_KEY).alias("o_orderkey"))
        .agg(
            F.min("l_suppkey").alias("o_custkey"),
            F.lit("M").alias("o_orderstatus"),
            (F.max("l_extendedprice") * 4).alias("o_totalprice"),
            F.max("l_shipdate").alias("o_orderdate"),
            F.lit("0-MERGED").alias("o_orderpriority"),
        )
    )


def _merged_sql(condition: str) -> str:
    take = f"s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR ({condition}))"
    columns = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in ORDERS.split(", "))
    return f"SELECT {columns} FROM orders t FULL JOIN ({CHANGES_SQL}) s ON t.o_orderkey = s.o_orderkey"


@query("upsert_orders", _merged_sql("s.o_totalprice > t.o_totalprice"))
def upsert_orders(spark, folder):
    higher = F.col("source.o_totalprice") > F.col("target.o_totalprice")
    return tables.merge(table(spark, folder, "orders"), changes(spark, folder), ["o_orderkey"], higher)


@query("upsert_unconditional", _merged_sql("true"))
def upsert_unconditional(spark, folder):
    return tables.merge(table(spark, folder, "orders"), changes(spark, folder), ["o_orderkey"])


@query(
    "schema_merge_append",
    f"SELECT {ORDERS}, NULL AS channel FROM orders UNION ALL BY NAME "
    f"SELECT {ORDERS}, concat('web-', o_orderpriority) AS channel FROM orders",
)
def schema_merge_append(spark, folder):
    path = work_folder(spark, "growing")
    orders = table(spark, folder, "orders")
    tables.append(orders, path)
    tables.append(orders.withColumn("channel", F.concat(F.lit("web-"), "o_orderpriority")), path)
    return tables.read_merged(spark, path)


@query(
    "schema_merge_union",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier",
)
def schema_merge_union(spark, folder):
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_acctbal AS balance", "s_suppkey AS id", "s_name AS name"
    )
    return tables.append_merging_schema([customers, suppliers])


@query("overwrite_sized", "SELECT count(*) AS rows, true AS within_cap FROM lineitem")
def overwrite_sized(spark, folder):
    path = work_folder(spark, "sized")
    items = table(spark, folder, "lineitem")
    tables.overwrite_sized(items, path, 20_000)
    tables.overwrite_sized(items, path, 10_000)
    per_file = inventory.count_rows(spark, path, "PARQUET")
    return per_file.agg(
        F.sum("records").alias("rows"), (F.max("records") <= 10_000).alias("within_cap")
    )


@query(
    "created_table",
    f"SELECT {ORDERS}, CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS order_year FROM orders",
)
def created_table(spark, folder):
    name = f"orders_{uuid.uuid4().hex}"
    made = tables.create_table(
        table(spark, folder, "orders"),
        name,
        work_folder(spark, "created"),
        [PartitionField("o_orderdate", "year", "order_year")],
        [SortField("o_totalprice", "desc", "last"), SortField("o_orderkey")],
        {"compression": "zstd"},
    )
    if not made:
        raise RuntimeError(f"table {name} already exists")
    return spark.table(name).withColumn("order_year", F.col("order_year").cast("int"))


@query(
    "added_columns",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR) AS grade, "
    "CAST(NULL AS BIGINT) AS visits FROM supplier",
)
def added_columns(spark, folder):
    name = f"suppliers_{uuid.uuid4().hex}"
    tables.create_table(table(spark, folder, "supplier"), name, work_folder(spark, "evolved"))
    tables.add_columns(spark, name, [("grade", "STRING", "set by hand"), ("visits", "BIGINT", "")])
    return spark.table(name)


@query(
    "partition_transforms",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y') AS o_orderdate_year,
           strftime(o_orderdate, '%Y-%m') AS o_orderdate_month, strftime(o_orderdate, '%Y-%m-%d') AS day,
           strftime(o_orderdate, '%Y-%m-%d-%H') AS o_orderdate_hour, substr(o_orderpriority, 1, 1) AS urgency,
           o_custkey - o_custkey % 100 AS o_custkey_truncate, true AS in_bucket
    FROM orders
    """,
)
def partition_transforms(spark, folder):
    spec = [
        PartitionField("o_orderdate", "year"),
        PartitionField("o_orderdate", "month"),
        PartitionField("o_orderdate", "day", "day"),
        PartitionField("o_orderdate", "hour"),
        PartitionField("o_orderpriority", "truncate", "urgency", 1),
        PartitionField("o_custkey", "truncate", size=100),
        PartitionField("o_orderkey", "bucket", "slot", 16),
        PartitionField("o_orderstatus"),
    ]
    return with_partitions(table(spark, folder, "orders"), spec).select(
        "o_orderkey",
        "o_orderdate_year",
        "o_orderdate_month",
        "day",
        "o_orderdate_hour",
        "urgency",
        "o_custkey_truncate",
        F.col("slot").between(0, 15).alias("in_bucket"),
    )


CHANGE_LOG = "user_id, ts AS committed_at, event_id AS version, event_type, value"
AS_OF = "2024-01-20 00:00:00"


@query(
    "as_of_read",
    f"""
    SELECT * FROM (SELECT {CHANGE_LOG} FROM events) WHERE committed_at <= TIMESTAMP '{AS_OF}'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY version DESC) = 1
    """,
)
def as_of_read(spark, folder):
    log = table(spark, folder, "events").selectExpr(*CHANGE_LOG.split(", "))
    return tables.as_of(log, ["user_id"], F.lit(AS_OF).cast("timestamp_ntz"))


@query(
    "snapshot_history",
    """
    SELECT CAST(floor(event_id / 100) AS BIGINT) AS version, min(ts) AS committed_at, count(*) AS added_records
    FROM events GROUP BY ALL
    """,
)
def snapshot_history(spark, folder):
    log = table(spark, folder, "events").select(
        F.floor(F.col("event_id") / 100).alias("version"), F.col("ts").alias("committed_at")
    )
    return tables.snapshots(log)


@query(
    "compacted_table",
    "SELECT count(*) AS rows, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, "
    "true AS fewer_files FROM lineitem",
)
def compacted_table(spark, folder):
    path, new = work_folder(spark, "scattered"), work_folder(spark, "compact")
    items = table(spark, folder, "lineitem")
    inputs.spread(items, max(24, 2 * inputs.pieces(items, FILE_ROWS))).write.parquet(path)
    tables.compact(spark, path, new)
    fewer = inventory.list_files(spark, new).count() < inventory.list_files(spark, path).count()
    return spark.read.parquet(new).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
        F.lit(fewer).alias("fewer_files"),
    )


@query("compacted_small_only", "SELECT *, true AS large_files_stay FROM lineitem")
def compacted_small_only(spark, folder):
    """A table of large files, one for FILE_ROWS rows, and 12 times as many small ones: all its rows,
    and where they are read from."""
    path, new = work_folder(spark, "mixed"), work_folder(spark, "joined")
    lines = table(spark, folder, "lineitem")
    large = inputs.pieces(lines, FILE_ROWS)
    inputs.spread(lines.filter("l_orderkey % 4 > 0"), large).write.parquet(path)
    inputs.spread(lines.filter("l_orderkey % 4 = 0"), 12 * large).write.mode("append").parquet(path)
    limit = inventory.list_files(spark, path).orderBy(F.desc("size")).limit(large).agg(F.min("size")).first()[0]
    made = tables.compact_small(spark, path, new, target_bytes=limit)
    read = tables.read_compacted(spark, path, new, limit)
    found = read.select(F.input_file_name().contains(path).alias("old"), F.input_file_name().alias("file"))
    files = {r.old: r["count"] for r in found.distinct().groupBy("old").count().collect()}
    stay = made and files[True] == large and files[False] < 12 * large
    return read.withColumn("large_files_stay", F.lit(stay))


@query("packed_small_files", "SELECT *, true AS fewer, true AS within_target, true AS large_stay FROM lineitem")
def packed_small_files(spark, folder):
    """Each value of a partition column has a large file for FILE_ROWS rows of the table, and small
    ones of many sizes."""
    path, new = work_folder(spark, "mixed"), work_folder(spark, "packed")
    lines = table(spark, folder, "lineitem")
    by = ["l_returnflag"]
    large = inputs.pieces(lines, FILE_ROWS)
    inputs.spread(lines.filter("l_orderkey % 4 > 0"), large).write.partitionBy(*by).parquet(path)
    uneven = F.pmod(F.floor(F.sqrt("l_orderkey")), F.lit(24)) * large
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(large))
    small = lines.filter("l_orderkey % 4 = 0").select("*", (uneven + turn).cast("int").alias("_task"))
    small = small.repartitionById(24 * large, "_task").drop("_task")
    small.write.mode("append").partitionBy(*by).parquet(path)
    files = inventory.list_files(spark, path)
    target = files.agg(F.max("size")).first()[0]
    made = packing.pack_small(spark, path, new, by, target)
    packed = inventory.list_files(spark, new).filter("path NOT LIKE '%/_packed/%'")
    count, most = packed.agg(F.count(F.lit(1)), F.max("size")).first()
    before = files.filter(F.col("size") < packing.small_below(target)).count()
    read = packing.read_packed(spark, path, new, target)
    old = read.select(F.input_file_name().alias("file")).distinct().filter(F.col("file").contains(path))
    shown = {
        "fewer": made and count < before / 2,
        "within_target": most <= 1.1 * target,
        "large_stay": old.count() < before,
    }
    return read.select(*lines.columns, *(F.lit(v).alias(n) for n, v in shown.items()))


@query("overwritten_by_bytes", "SELECT *, true AS within_target FROM orders")
def overwritten_by_bytes(spark, folder):
    """The cap of the second write comes from the files of the first."""
    path, new = work_folder(spark, "as-it-was"), work_folder(spark, "by-bytes")
    orders = table(spark, folder, "orders")
    large = inputs.pieces(orders, FILE_ROWS)
    sink.write(inputs.spread(orders, large), path)
    target = inventory.list_files(spark, path).agg(F.max("size")).first()[0] // 4
    packing.overwrite_by_bytes(inputs.spread(orders, large), new, target, like=path)
    count, most = inventory.list_files(spark, new).agg(F.count(F.lit(1)), F.max("size")).first()
    # Footers and dictionaries, which every file has, weigh in small files.
    return spark.read.parquet(new).withColumn("within_target", F.lit(4 * large <= count <= 6 * large and most <= 2 * target))


@query(
    "compacted_partitions",
    "SELECT l_returnflag, count(*) AS rows, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity "
    "FROM lineitem GROUP BY l_returnflag",
)
def compacted_partitions(spark, folder):
    path, new = work_folder(spark, "scattered"), work_folder(spark, "compact")
    items = table(spark, folder, "lineitem")
    count = max(8, 2 * inputs.pieces(items, FILE_ROWS))
    inputs.spread(items, count).write.partitionBy("l_returnflag").parquet(path)
    tables.compact(spark, path, new, ["l_returnflag"])
    return (
        spark.read.parquet(new)
        .groupBy("l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
        )
    )


# Each document is read as a file of n_chars bytes.
FILES = ("source AS table_name", "lang", "n_chars AS size")


@query(
    "table_stats",
    """
    SELECT source AS table_name, CAST(sum(n_chars) AS BIGINT) AS total_size_bytes, count(*) AS file_count,
           count(DISTINCT lang) AS snapshot_count FROM documents GROUP BY source
    """,
)
def table_stats(spark, folder):
    files = inputs.columns(spark, folder, "documents", FILES)
    return statistics.table_stats(files, files.withColumnRenamed("lang", "version"))


@query(
    "partition_stats",
    """
    SELECT lang AS partition_value, count(*) AS file_count, CAST(sum(n_chars) AS BIGINT) AS total_size_bytes,
           CAST(sum(n_chars) AS DOUBLE) / count(*) / 1048576 AS avg_file_size_mb FROM documents GROUP BY lang
    """,
)
def partition_stats(spark, folder):
    files = inputs.columns(spark, folder, "documents", FILES)
    return statistics.partition_stats(files, F.col("lang"))


@query(
    "value_ranges",
    """
    SELECT l_suppkey AS file, count(*) AS record_count, min(l_extendedprice) AS min_l_extendedprice,
           max(l_extendedprice) AS max_l_extendedprice, min(l_shipdate) AS min_l_shipdate,
           max(l_shipdate) AS max_l_shipdate FROM lineitem GROUP BY l_suppkey
    """,
)
def value_ranges(spark, folder):
    items = table(spark, folder, "lineitem")
    return statistics.value_ranges(items, F.col("l_suppkey"), ["l_extendedprice", "l_shipdate"])


@query(
    "value_ranges_per_file",
    """
    SELECT count(*) AS record_count, min(o_totalprice) AS min_o_totalprice,
           max(o_totalprice) AS max_o_totalprice FROM orders
    """,
)
def value_ranges_per_file(spark, folder):
    file = F.col(inventory.FILE_PATH)
    ranges = statistics.value_ranges(table(spark, folder, "orders"), file, ["o_totalprice"])
    return ranges.agg(
        F.sum("record_count").alias("record_count"),
        F.min("min_o_totalprice").alias("min_o_totalprice"),
        F.max("max_o_totalprice").alias("max_o_totalprice"),
    )


@query(
    "scan_efficiency",
    """
    WITH r AS (SELECT l_suppkey, l_returnflag, max(l_extendedprice) AS high FROM lineitem GROUP BY ALL)
    SELECT l_returnflag AS table_name, count(*) FILTER (high >= 95000) AS files_scanned, count(*) AS files_total,
           CAST(count(*) FILTER (high >= 95000) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS scan_efficiency_pct
    FROM r GROUP BY l_returnflag
    """,
)
def scan_efficiency(spark, folder):
    file = F.struct("l_returnflag", "l_suppkey")
    ranges = statistics.value_ranges(table(spark, folder, "lineitem"), file, ["l_extendedprice"])
    needed = statistics.may_contain("l_extendedprice", low=F.lit(95_000))
    return statistics.scan_efficiency(ranges, F.col("file.l_returnflag"), needed)


@query(
    "sorted_write",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
def sorted_write(spark, folder):
    path = work_folder(spark, "sorted")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sink.write(
        orders,
        path,
        partition_by=("o_orderstatus",),
        sort_by=[SortField("o_totalprice", "desc", "last"), SortField("o_orderkey")],
    )
    return spark.read.parquet(path)


def _zoned_items(spark, folder):
    path = work_folder(spark, "zoned")
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    zones.write_zoned(items, path, ["l_shipdate", "l_extendedprice"])
    return path


@query(
    "zone_map_scan",
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem "
    "WHERE l_shipdate >= TIMESTAMP '1996-03-01 00:00:00' AND l_shipdate <= TIMESTAMP '1996-05-31 00:00:00'",
)
def zone_map_scan(spark, folder):
    """Opens the files whose zones meet the range; a test holds that they are few."""
    low, high = (F.lit(f"1996-{day} 00:00:00").cast("timestamp_ntz") for day in ("03-01", "05-31"))
    return zones.scan(spark, _zoned_items(spark, folder), "l_shipdate", low, high)


@query(
    "zone_map_efficiency",
    """
    WITH r AS (SELECT l_returnflag, year(l_shipdate) AS y, max(l_extendedprice) AS high FROM lineitem GROUP BY ALL)
    SELECT l_returnflag AS table_name, count(*) FILTER (high >= 95000) AS files_scanned, count(*) AS files_total,
           CAST(count(*) FILTER (high >= 95000) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS scan_efficiency_pct
    FROM r GROUP BY l_returnflag
    """,
)
def zone_map_efficiency(spark, folder):
    """Files that a predicate needs, of the files that a write made (small: one a value)."""
    path = work_folder(spark, "zoned")
    items = table(spark, folder, "lineitem").select(
        "l_extendedprice", "l_returnflag", F.year("l_shipdate").alias("y")
    )
    zones.write_zoned(items, path, ["l_extendedprice"], partition_by=("l_returnflag", "y"))
    flag = F.regexp_extract("file", "l_returnflag=([^/]*)/", 1)
    needed = statistics.may_contain("l_extendedprice", low=F.lit(95_000))
    return statistics.scan_efficiency(zones.read_zones(spark, path), flag, needed)


@query(
    "listed_partition_stats",
    """
    SELECT o_orderstatus AS partition_value, 1 AS file_count,
           CAST(sum(strlen(o_orderpriority) + 1) AS BIGINT) AS total_size_bytes,
           CAST(sum(strlen(o_orderpriority) + 1) AS DOUBLE) / 1048576 AS avg_file_size_mb
    FROM orders GROUP BY o_orderstatus
    """,
)
def listed_partition_stats(spark, folder):
    """Sizes told by the listing of files that were written (small: one file a value)."""
    path = work_folder(spark, "listed")
    orders = table(spark, folder, "orders").select("o_orderstatus", F.col("o_orderpriority").alias("value"))
    orders.hint("rebalance", "o_orderstatus").write.partitionBy("o_orderstatus").text(path)
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1)
    return statistics.partition_stats(inventory.list_files(spark, path), status)


@query(
    "listed_table_stats",
    """
    SELECT 'orders-' || o_orderstatus AS table_name, CAST(sum(strlen(o_orderpriority) + 1) AS BIGINT) AS total_size_bytes,
           CAST(2 AS BIGINT) AS file_count, CAST(2 AS BIGINT) AS snapshot_count
    FROM orders GROUP BY o_orderstatus
    """,
)
def listed_table_stats(spark, folder):
    """Tables written in two versions, a file each: their bytes and files from the listing."""
    path = work_folder(spark, "listed")
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("orders-"), "o_orderstatus").alias("t"),
        (F.col("o_orderkey") % 2).alias("version"),
        F.col("o_orderpriority").alias("value"),
    )
    orders.hint("rebalance", "t", "version").write.partitionBy("t", "version").text(path)
    files = inventory.list_files(spark, path)
    files = files.withColumns(
        {"table_name": F.regexp_extract("path", "t=([^/]*)/", 1), "version": F.regexp_extract("path", "version=([^/]*)/", 1)}
    )
    return statistics.table_stats(files, files)


#: Orders a version later: some are gone, some have other values or none, and some are new.
NEXT_ORDERS = (
    "CASE WHEN o_orderkey % 17 = 5 THEN o_orderkey + 2000000000000 ELSE o_orderkey END AS o_orderkey",
    "o_custkey",
    "CASE WHEN o_orderkey % 13 = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus",
    "CASE WHEN o_orderkey % 19 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice",
)
FIRST_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
NEXT_SQL = f"SELECT {', '.join(NEXT_ORDERS)} FROM orders WHERE o_orderkey % 11 <> 4"


def _two_snapshots(spark, folder):
    before = inputs.columns(spark, folder, "orders", FIRST_ORDERS)
    after = table(spark, folder, "orders").where("o_orderkey % 11 <> 4").selectExpr(*NEXT_ORDERS)
    return before, after


@query(
    "snapshot_changes",
    f"""
    WITH a AS ({NEXT_SQL}), b AS (SELECT {', '.join(FIRST_ORDERS)} FROM orders)
    SELECT 'insert' AS change, a.* FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
    UNION ALL SELECT 'delete', b.* FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
    UNION ALL SELECT 'update', a.* FROM a JOIN b USING (o_orderkey)
    WHERE (a.o_custkey, a.o_orderstatus, a.o_totalprice) IS DISTINCT FROM (b.o_custkey, b.o_orderstatus, b.o_totalprice)
    """,
)
def snapshot_changes(spark, folder):
    before, after = _two_snapshots(spark, folder)
    return differences.changes(before, after, ["o_orderkey"])


@query("snapshot_changes_applied", NEXT_SQL)
def snapshot_changes_applied(spark, folder):
    """A snapshot and its changes are the next one, also if they are applied again."""
    before, after = _two_snapshots(spark, folder)
    path = work_folder(spark, "changes")
    differences.changes(before, after, ["o_orderkey"]).write.parquet(path)
    changed = spark.read.parquet(path)
    once = differences.applied(before, changed, ["o_orderkey"])
    return differences.applied(once, changed, ["o_orderkey"])
