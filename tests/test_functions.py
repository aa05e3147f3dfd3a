import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.functions import jsontext, partitioning, paths, text, values
from tidegate.schemas import STAGE_TEXT, STATES


def column(spark, rows, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_squeeze_trims_and_collapses(spark):
    rows = ["  a \t b\n", "", "   ", None, "plain", "\r\nx\f y "]
    assert column(spark, rows, text.squeeze(F.col("v"))) == ["a b", "", "", None, "plain", "x y"]


def test_collapse_keeps_the_ends_and_backslashes(spark):
    rows = ["  a \t b\n", r"a\s\sb", None]
    assert column(spark, rows, text.collapse_blanks(F.col("v"))) == [" a b ", r"a\s\sb", None]


def test_digits_of_numbers_become_text(spark):
    df = spark.createDataFrame([(5550101,), (None,)], "phone INT")
    got = df.select(text.digits_only(F.col("phone"))).collect()
    assert [r[0] for r in got] == ["5550101", None]


def test_title_case_splits_on_blanks_only(spark):
    assert column(spark, ["usb-c CABLE", "o'neil x"], text.title_case(F.col("v"))) == ["Usb-c Cable", "O'neil X"]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("a.csv", "CSV"),
        ("a.CSV.gz", "CSV"),
        ("a.tsv.gzip", "TSV"),
        ("a.json.bz2", "JSON"),
        ("a.jsonl", "JSONL"),
        ("a.ndjson.gz", "JSONL"),
        ("a.parquet", "PARQUET"),
        ("a.txt", "CSV"),
        ("a.json.gz.gz", "CSV"),
        ("noext", "CSV"),
    ],
)
def test_format_from_name(spark, name, expected):
    assert column(spark, [name], paths.file_format(F.col("v"))) == [expected]


def test_path_parts(spark):
    rows = ["s3a://b/d/e/f.csv", "b/f.csv", "s3://only", "s3://b/", "s3://b/d/"]
    key = paths.key(F.col("v"))
    assert column(spark, rows, paths.bucket(F.col("v"))) == ["b", "b", None, "b", "b"]
    assert column(spark, rows, key) == ["d/e/f.csv", "f.csv", None, "", "d/"]
    assert column(spark, rows, paths.directory(key)) == ["d/e/", "", None, "", "d/"]
    assert column(spark, rows, paths.file_name(key)) == ["f.csv", "f.csv", None, "", ""]
    assert column(spark, rows, paths.is_object_path(F.col("v"))) == [True, True, False, True, True]


def test_compressed_suffixes(spark):
    rows = ["a.gz", "a.GZIP", "a.bz2", "a.zip", "a.csv", "gz"]
    assert column(spark, rows, paths.is_compressed(F.col("v"))) == [True, True, True, True, False, False]


def test_every_state_has_a_text(spark):
    assert set(STAGE_TEXT) == set(STATES)
    got = column(spark, [*STATES, "ODD"], values.stage_text(F.col("v")))
    assert got == [STAGE_TEXT[s] for s in STATES] + ["State: ODD"]


def test_ids_are_shaped_and_repeatable(spark):
    at = F.lit("2024-03-05 10:00:00").cast("timestamp")
    df = spark.range(2).select(
        values.batch_id(at, F.lit("x")).alias("a"),
        values.batch_id(at, F.lit("x")).alias("b"),
        values.batch_id(at).alias("c"),
        values.job_id().alias("d"),
        values.job_id(F.lit("y")).alias("e"),
    )
    row = df.first()
    assert row.a == row.b
    assert all(x.startswith("batch_20240305_") and len(x) == 23 for x in (row.a, row.c))
    assert all(x.startswith("job-") and len(x) == 12 for x in (row.d, row.e))


def test_expiry_and_rfc3339(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    row = spark.range(1).select(values.expiry(at, 30).alias("e"), values.rfc3339(at).alias("r")).first()
    assert row.e == 1704067200 + 30 * 86400
    assert row.r == "2024-01-01T00:00:00Z"


def test_checksum_follows_the_length_of_the_hash(spark):
    df = spark.createDataFrame([("abc", "0" * n) for n in (32, 40, 64, 5)], "t STRING, h STRING")
    got = [r[0] for r in df.select(values.checksum(F.encode("t", "UTF-8"), F.col("h"))).collect()]
    assert [len(x) if x else None for x in got] == [32, 40, 64, None]


def is_json(value):
    def refuse(_):
        raise ValueError

    try:
        json.loads(value, parse_constant=refuse)
        return True
    except ValueError:
        return False


CASES = [
    '{"a":1} x', '{"k": 87', '"k": 87}', "1,2", "1],[2", "", "null", "1", '"s"', "[1,2]", "{}",
    '{"a":1,"a":2}', ' {"a":1} ', '{"a":1},{"b":2}', "abc", "[1", "1]", "],[", '{"a":1}]', "tru",
    '"a', "NaN", "1 2", "{a:1}", "{'a':1}", '{"a":"it\'s"}', "1,2],[", "'a'", "01", "-1.5e3", '"\t"',
    '{"a":1}}', "[[1],[2]]", "true", " null ", "'", '{"a":NaN,"b":"\'"}', "[\n1,\n2\n]",
]


def test_json_check(spark):
    assert column(spark, CASES, jsontext.is_json(F.col("v"))) == [is_json(c) for c in CASES]


PIECES = st.lists(
    st.sampled_from(['{"a":', "}", "[", "]", ",", "1", '"x"', "null", " ", "'", "0", '"', "{", ":", "\n"]),
    max_size=8,
).map("".join)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PIECES, min_size=200, max_size=400))
def test_json_check_on_scrambled_text(spark, rows):
    got = column(spark, rows, jsontext.is_json(F.col("v")))
    assert [(r, g) for r, g in zip(rows, got) if g != is_json(r)] == []


def test_partition_field_errors(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="needs a size"):
        partitioning.with_partitions(df, [partitioning.PartitionField("id", "bucket")])
    with pytest.raises(ValueError, match="unknown partition transform"):
        partitioning.with_partitions(df, [partitioning.PartitionField("id", "week")])
    with pytest.raises(ValueError, match="unknown sort order"):
        partitioning.SortField("id", "up").column_order()


def test_truncate_of_negative_numbers_goes_down(spark):
    df = spark.createDataFrame([(-1,), (0,), (19,)], "n INT")
    made = partitioning.with_partitions(df, [partitioning.PartitionField("n", "truncate", "t", 10)])
    assert [r.t for r in made.collect()] == [-10, 0, 10]
