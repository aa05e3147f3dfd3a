"""Sinks and whole jobs, with the faults that inputs may have."""

import os

import pytest
from pyspark.sql import functions as F

from tidegate.functions.partitioning import SortField
from tidegate.operators import profiles, quality
from tidegate.options import ConvertOptions
from tidegate.plans import jobs
from tidegate.sinks import files as sink


def files(path, suffix):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(suffix)]


@pytest.mark.parametrize("codec", ["none", "SNAPPY", "gzip", "lz4", "zstd"])
def test_parquet_codecs(spark, tmp_path, codec):
    sink.write(spark.range(10), str(tmp_path / "o"), "PARQUET", codec)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 10
    assert os.path.exists(tmp_path / "o" / "_SUCCESS")


def test_text_outputs_have_their_time_formats(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP '2024-01-02 03:04:05.678' AS at")
    sink.write(df, str(tmp_path / "j"), "json", "none")
    sink.write(df, str(tmp_path / "c"), "csv", "none")
    assert '"at":"2024-01-02T03:04:05.678Z"' in open(files(tmp_path / "j", ".json")[0]).read()
    assert open(files(tmp_path / "c", ".csv")[0]).read() == "id,at\n1,2024-01-02 03:04:05\n"


@pytest.mark.parametrize("name", ["DELTA", "ICEBERG", "XML"])
def test_unknown_output_format(spark, tmp_path, name):
    with pytest.raises(ValueError, match=f"Unsupported output format: {name}"):
        sink.write(spark.range(1), str(tmp_path / "o"), name)


def test_row_cap_per_file(spark, tmp_path):
    sink.write(spark.range(0, 95, 1, 1), str(tmp_path / "o"), max_records_per_file=10)
    assert len(files(tmp_path / "o", ".parquet")) == 10


def test_partitions_are_gathered_and_sorted(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).select((F.col("id") % 3).alias("p"), (F.col("id") * 7 % 1000).alias("v"))
    sink.write(df, str(tmp_path / "o"), partition_by=["p"], sort_by=[SortField("v", "desc")])
    assert len(files(tmp_path / "o", ".parquet")) == 3
    for part in range(3):
        values = [r.v for r in spark.read.parquet(str(tmp_path / "o" / f"p={part}")).collect()]
        assert values == sorted(values, reverse=True)


def test_missing_partition_column_is_refused_before_the_read(spark, tmp_path):
    source = tmp_path / "c.csv"
    source.write_text("id,name\n1,a\n")
    options = ConvertOptions(partition_by=("region", "signup_year"))
    with pytest.raises(ValueError, match="region, signup_year"):
        jobs.run_convert(spark, str(source), str(tmp_path / "o"), options=options)


def test_target_name_chooses_the_first_profile():
    assert profiles.step_for("customer_orders", profiles.STANDARD_STEPS) == profiles.CUSTOMERS.apply
    assert profiles.step_for("ANALYTICS_EVENTS", profiles.STANDARD_STEPS) == profiles.ANALYTICS.apply
    assert profiles.step_for("ANALYTICS_EVENTS", profiles.CONVERT_STEPS) is None
    assert profiles.step_for("SUPPLIERS", profiles.STANDARD_STEPS) is None


def test_names_that_differ_by_case_are_refused(spark):
    df = spark.createDataFrame([(1, 2, "e")], "customer_id INT, CUSTOMER_ID INT, email STRING")
    with pytest.raises(ValueError, match="more than one column named customer_id"):
        profiles.CUSTOMERS.rename(df)


def test_profile_without_its_columns_says_which(spark):
    df = spark.createDataFrame([(1, "a")], "customer_id INT, name STRING")
    with pytest.raises(ValueError, match="customers: required columns missing: EMAIL_ADDRESS"):
        jobs.standardise(df, "CUSTOMERS", "j")


def test_empty_rows_with_numbers_only_are_kept(spark):
    rows = [(1, None, None), (None, "", None), (None, None, None), (None, " ", float("nan")), (None, "x", 1.0)]
    df = spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE")
    assert [r.a for r in quality.drop_empty_rows(df).select("a").collect()] == [1, None, None]
    assert quality.drop_null_rows(df).count() == 4


def test_metadata_columns_do_not_count_as_values(spark):
    df = spark.createDataFrame([(None, "j"), (1, "j")], "a INT, _job_id STRING")
    assert quality.drop_null_rows(df).count() == 1
    assert quality.text_columns(df) == []


def test_standard_job_columns(spark):
    df = spark.createDataFrame([(1, "A  B", "a@b", "5", "x")], "customer_id INT, name STRING, email STRING, phone STRING, city STRING")
    row = jobs.standardise(df, "CUSTOMERS", "job-1").first().asDict()
    assert row["CUSTOMER_NAME"] == "A B"
    assert row["_spark_version"] == spark.version
    assert set(row) - {"CUSTOMER_ID", "CUSTOMER_NAME", "EMAIL_ADDRESS", "PHONE_NUMBER", "city"} == {
        "_processing_timestamp", "_job_id", "_source_system", "_emr_version", "_spark_version",
    }


def test_convert_job_with_all_switches(spark, tmp_path):
    source = tmp_path / "p.csv"
    source.write_text('product_id,product_name,category\n1,"  usb-c   CABLE ",a\n,"  ",\n2,"x\ny",b\n')
    options = ConvertOptions(clean_strings=True, add_row_id=True, partition_by=("category",))
    stats = jobs.run_convert(spark, str(source), str(tmp_path / "o"), "PRODUCTS", "j", options)
    assert (stats.input_records, stats.output_records, stats.data_quality_issues) == (3, 2, 1)
    rows = spark.read.parquet(str(tmp_path / "o")).orderBy("product_id").collect()
    assert [(r.product_name, r.category) for r in rows] == [("Usb-c Cable", "a"), ("X Y", "b")]
    assert len({r._row_id for r in rows}) == 2


def test_convert_orders_fills_whole_amounts(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "order_id INT, amount INT")
    out = jobs.convert(df, "ORDERS", "j")
    assert dict(out.dtypes)["amount"] == "double"
    assert [r.amount for r in out.collect()] == [5.0, 0.0]


def test_basic_job_leaves_data_and_marker(spark, tmp_path):
    source = tmp_path / "c.csv"
    source.write_text("id,name\n1,a\n,\n2,b\n")
    stats = jobs.run_basic(spark, str(source), str(tmp_path / "o"), output_format="JSON")
    assert (stats.input_records, stats.output_records) == (3, 2)
    assert (tmp_path / "o" / "_SUCCESS").read_text() == "Processing completed successfully"
    assert spark.read.json(str(tmp_path / "o" / "data")).count() == 2


def test_job_over_a_file_without_rows(spark, tmp_path):
    source = tmp_path / "c.csv"
    source.write_text("order_id,amount\n")
    stats = jobs.run_standard(spark, str(source), str(tmp_path / "o"), "ORDERS", "j")
    assert (stats.input_records, stats.output_records) == (0, 0)
    empty = spark.createDataFrame([], "a INT")
    stats = jobs.run_counted(empty, lambda d: d, lambda d: sink.write(d, str(tmp_path / "e")))
    assert (stats.input_records, stats.output_records) == (0, 0)


@pytest.mark.parametrize("name", ["JSON", "CSV"])
def test_text_outputs_take_the_default_codec(spark, tmp_path, name):
    sink.write(spark.range(100), str(tmp_path / "o"), name)
    assert spark.read.text(str(tmp_path / "o")).count() >= 100


def test_stats_frame(spark):
    row = jobs.JobStats(10, 8, 2.0).frame(spark).first()
    assert (row.data_quality_issues, row.records_per_second) == (2, 4.0)


def test_jobs_are_found_by_name(spark):
    jobs.register_job("twice", lambda df, target, job_id, params: df.union(df))
    assert jobs.job_named("twice")(spark.range(2), "T", "j", {}).count() == 4
    with pytest.raises(ValueError, match="unknown job: nope"):
        jobs.job_named("nope")


def test_ingest_is_one_stage_without_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 2.0, "s")], "order_id INT, customer_id INT, amount DOUBLE, status STRING")
    plan = jobs.standardise(df, "ORDERS", "j")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_conversion_reads_quoted_line_breaks_by_splits(spark, tmp_path):
    """The same result whether a file is read by one task or by many."""
    rows = "".join(f'{i},"line {i}\nand ""more"", {i}",{i / 4}\n' for i in range(300))
    (tmp_path / "c.csv").write_text("id,text,amount\n" + rows)
    names = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    found = []
    for split in ("false", "true"):
        for k, v in (names if split == "true" else before).items():
            spark.conf.set(k, v)
        out = str(tmp_path / split)
        options = ConvertOptions.from_params({"csv-split": split, "clean-strings": "true"})
        stats = jobs.run_convert(spark, str(tmp_path / "c.csv"), out, "T", options=options)
        assert (stats.input_records, stats.output_records) == (300, 300)
        found.append(sorted(map(tuple, spark.read.parquet(out).select("id", "text", "amount").collect())))
    for k, v in before.items():
        spark.conf.set(k, v)
    assert found[0] == found[1]
