"""What reaches the scan, and how rows are moved."""

import pytest
from pyspark.sql import functions as F

from tidegate.operators import statistics, tables, tracking
from tidegate.operators.latest import latest_per_key
from tidegate.plans import catalog, inputs, jobs
from tidegate.sinks import files as sink
from tidegate.sources import inventory

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    """The plan with all details of its nodes."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(catalog.QUERIES["parquet_scan"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity)" in text
    assert "GreaterThan(l_quantity,25.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text


def test_profile_filters_pass_the_renames(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").selectExpr(
        "o_orderkey AS order_id", "o_totalprice AS amount", "o_orderstatus AS status"
    )
    text = plan(jobs.standardise(orders, "ORDERS", "j"))
    assert "GreaterThan(o_totalprice,0.0)" in text and "IsNotNull(o_orderkey)" in text
    assert "Exchange" not in text


@pytest.mark.parametrize(
    "name", ["orders_ingest", "profile_customers", "convert_customers", "route_files", "path_parts", "content_checksums"]
)
def test_row_work_needs_no_shuffle(spark, name):
    assert "Exchange" not in plan(catalog.QUERIES[name](spark, FOLDER))


def test_folds_shuffle_once_and_reduce_first(spark):
    log = spark.range(3).selectExpr(
        "'f' AS file_path", "concat('j', id) AS job_id", "'e' AS event_id", "timestamp_seconds(id) AS occurred_at",
        "'transition' AS kind", "'S' AS to_state", "true AS retryable", "'r' AS job_run_id",
    )
    text = plan(tracking.fold(log, 3))
    assert "partial_max" in text and text.count("hashpartitioning") == 1


def test_counts_shuffle_counters_only(spark):
    orders = inputs.columns(spark, FOLDER, "orders", inputs.ORDERS)
    hourly = statistics.hourly(spark.read.parquet(f"{FOLDER}/events.parquet"))
    for df in (statistics.count_and_mean(orders, ["status"], "amount", "n", "m"), hourly):
        text = plan(df)
        assert "partial_" in text and text.count("hashpartitioning") == 1


def test_small_merge_source_leaves_the_target_in_place(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    source = orders.filter("o_totalprice > 400000")
    text = plan(tables.merge(orders, source, ["o_orderkey"]))
    assert "SortMergeJoin" not in text and "LeftOuter" in text and "FullOuter" not in text


def test_as_of_reads_only_what_was_committed(spark):
    log = spark.read.parquet(f"{FOLDER}/events.parquet").selectExpr("user_id", "ts AS committed_at", "event_id AS version")
    text = plan(tables.as_of(log, ["user_id"], F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")))
    assert "LessThanOrEqual(ts,2024-01-02T00:00)" in text


def test_latest_takes_only_the_columns_asked_for(spark):
    newest = latest_per_key(spark.read.parquet(f"{FOLDER}/events.parquet"), ["user_id"], "event_id")
    text = plan(newest.select("user_id", "value"))
    assert "partial_max_by" in text


def test_hot_target_key_is_split(spark):
    """With both sides too large to broadcast, adaptive execution splits the hot key of the target."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        target = spark.range(0, 400_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7L ELSE id END AS k", "sha2(cast(id AS STRING), 256) AS v"
        )
        source = spark.range(0, 400_000, 20, 4).selectExpr("id + 7 AS k", "'new' AS v")
        merged = tables.merge(target, source, ["k"])
        assert "skew=true" in _final_plan(merged)
        hits = target.join(source, "k", "left_semi").count()
        assert merged.filter("v = 'new'").count() == hits + source.join(target, "k", "left_anti").count()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_hot_partition_value_is_written_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        rows = spark.range(0, 400_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 7) END AS p", "sha2(cast(id AS STRING), 256) AS v"
        )
        sink.write(rows, str(tmp_path / "o"), partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(str(tmp_path / "o"))
    assert written.count() == 400_000
    files = written.filter("p = 'hot'").select("_metadata.file_path").distinct().count()
    assert files > 2


def _final_plan(df):
    """The plan as adaptive execution left it."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def test_header_width_sorts_no_lines(spark, tmp_path):
    for i, line in enumerate(('a,"b,c",d', "a,b", "", "a||b||", '"a""b"')):
        (tmp_path / f"{i}.csv").write_text(f"{line}\n1,2,3,4,5,6\n")
    df = inventory.lines_and_columns(spark, str(tmp_path))
    assert "SortAggregate" not in plan(df) and "HashAggregate" in plan(df)
    assert [r.column_count for r in df.orderBy("path").collect()] == [3, 2, 1, 1, 1]
    wide = inventory.header_columns(spark, str(tmp_path), "||").orderBy("path").collect()
    assert [r.column_count for r in wide] == [1, 1, 1, 3, 1]
