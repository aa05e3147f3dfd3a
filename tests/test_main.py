import json

import pytest

from tidegate.__main__ import main, parser


def run(spark, capsys, *arguments):
    code = main([str(a) for a in arguments], spark)
    return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])


@pytest.fixture
def orders(tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,customer_id,amount,status\n1,1,5.5,a  b\n2,1,-1,c\n3,2,,d\n")
    return path


def test_standard_job(spark, capsys, tmp_path, orders):
    code, stats = run(
        spark, capsys, "standard", "--input-path", orders, "--output-path", tmp_path / "o", "--target-name", "ORDERS",
        "--job-id", "j", "--expected-records", 3, "--required-fields", "order_id, amount", "--output-format", "JSON",
        "--compression", "NONE",
    )
    assert code == 0
    assert (stats["input_records"], stats["output_records"], stats["data_quality_issues"]) == (3, 1, 2)
    assert spark.read.json(str(tmp_path / "o")).first().status == "a b"


def test_unexpected_count_and_missing_fields(spark, capsys, tmp_path, orders):
    common = ("basic", "--input-path", orders, "--output-path", tmp_path / "o")
    code, stats = run(spark, capsys, *common, "--expected-records", 5)
    assert code == 1 and stats["errors"] == ["Record count mismatch: expected 5, got 3"]
    with pytest.raises(ValueError, match="required fields missing: region"):
        run(spark, capsys, *common, "--required-fields", "order_id,region")


def test_convert_job(spark, capsys, tmp_path, orders):
    code, stats = run(
        spark, capsys, "convert", "--input-path", orders, "--output-path", tmp_path / "o", "--target-name", "ORDERS",
        "--partition-by", "customer_id", "--clean-strings", "true", "--compression", "gzip",
    )
    assert code == 0 and stats["output_records"] == 3
    assert {r.amount for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {5.5, -1.0, 0.0}


def test_batch(spark, capsys, tmp_path, orders):
    config = tmp_path / "config.json"
    prefix = str(tmp_path).lstrip("/") + "/orders"
    config.write_text(json.dumps({"prefix_mappings": [{"s3_prefix": prefix, "target_name": "ORDERS"}]}))
    code, result = run(
        spark, capsys, "batch", "--config", config, "--input-path", orders, "--output-path", tmp_path / "o",
        "--log-path", tmp_path / "log", "--job-id", "j",
    )
    assert code == 0 and result["files"] == {"PROCESSED": 1}


def test_missing_arguments_are_refused():
    with pytest.raises(SystemExit):
        parser().parse_args(["standard", "--input-path", "x"])
