import bz2
import gzip
import hashlib
import json

import pytest

from tidegate.options import ConvertOptions, parse_config
from tidegate.sources import control, inventory, readers

STATIONS = (
    "station_id,label,river,metres\n"
    "11,Upper weir,Mosel,4.25\n"
    "12,Old mill,Saar,1.5\n"
    "15,Harbour,Rhein,7.75"  # no line break at the end
)


def put(folder, name, data):
    path = folder / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_csv_types_are_inferred(spark, tmp_path):
    df = readers.read(spark, put(tmp_path, "c.csv", STATIONS), "csv")
    assert df.dtypes[0] == ("station_id", "int")
    assert df.count() == 3


def test_csv_dates_and_quoted_commas(spark, tmp_path):
    text = 'id,level,seen,remark\n7,3.125,"2019-11-30","low, then ""high"""\n8,0.5,"2020-02-29","dry"\n'
    df = readers.read_csv(spark, put(tmp_path, "p.csv", text))
    assert [t for _, t in df.dtypes] == ["int", "double", "date", "string"]
    assert df.first().remark == 'low, then "high"'


def test_given_schema_wins_over_inference(spark, tmp_path):
    path = put(tmp_path, "c.csv", STATIONS)
    df = readers.read(spark, path, "CSV", "station_id BIGINT, label STRING, river STRING")
    assert df.dtypes[0] == ("station_id", "bigint")


@pytest.mark.parametrize(
    "suffix, pack", [(".gz", gzip.compress), (".gzip", gzip.compress), (".bz2", bz2.compress)]
)
def test_compressed_csv(spark, tmp_path, suffix, pack):
    path = put(tmp_path, "c.csv" + suffix, pack(STATIONS.encode()))
    assert readers.read(spark, path, "CSV").count() == 3


def test_json_array_on_one_line_gives_a_row_each(spark, tmp_path):
    path = put(tmp_path, "a.json", json.dumps([{"id": 1, "ok": True}, {"id": 2, "ok": False}]))
    df = readers.read(spark, path, "JSON")
    assert dict(df.dtypes) == {"id": "bigint", "ok": "boolean"}
    assert df.count() == 2


def test_json_array_over_many_lines(spark, tmp_path):
    path = put(tmp_path, "a.json", json.dumps([{"id": 1}, {"id": 2}, {"id": 3}], indent=2))
    assert readers.read(spark, path, "JSON_ARRAY").count() == 3


def test_tsv_and_options(spark, tmp_path):
    path = put(tmp_path, "t.tsv", "id\tname\n1\ta,b\n2\t-\n")
    df = readers.read(spark, path, "tsv", options={"nullValue": "-"})
    assert [tuple(r) for r in df.collect()] == [(1, "a,b"), (2, None)]


def test_unknown_format_and_missing_path(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported file format: XML"):
        readers.read(spark, str(tmp_path), "XML")
    with pytest.raises(FileNotFoundError, match="nothing.csv"):
        readers.read(spark, str(tmp_path / "nothing.csv"))
    with pytest.raises(ValueError, match="not yet supported: .zip"):
        readers.read(spark, put(tmp_path, "c.csv.zip", b"x"))


def test_delimiter_and_no_header(spark, tmp_path):
    options = ConvertOptions.from_params({"csv-delimiter": ";", "csv-header": "false"})
    df = readers.read_csv(spark, put(tmp_path, "c.csv", "1;x\n2;y\n"), options)
    assert df.columns == ["_c0", "_c1"] and df.count() == 2


def by_name(df, *columns):
    return {r.path.rsplit("/", 1)[1]: tuple(r[c] for c in columns) for r in df.collect()}


def test_line_counts(spark, tmp_path):
    put(tmp_path, "a.csv", STATIONS)
    put(tmp_path, "b.csv", "h\n\n1\r\n\n")
    put(tmp_path, "c.csv", "h")
    got = by_name(inventory.count_records(spark, str(tmp_path), "CSV"), "records")
    assert got == {"a.csv": (3,), "b.csv": (3,), "c.csv": (0,)}
    raw = by_name(inventory.count_records(spark, str(tmp_path), "NDJSON"), "records")
    assert raw == {"a.csv": (4,), "b.csv": (4,), "c.csv": (1,)}
    assert by_name(inventory.count_records(spark, str(tmp_path), "ODD"), "records") == raw


def test_empty_file_counts_zero_when_expected(spark, tmp_path):
    put(tmp_path, "a.csv", STATIONS)
    put(tmp_path, "empty.csv", "")
    uris = [(f"file://{tmp_path}/{n}",) for n in ("a.csv", "empty.csv")]
    expected = spark.createDataFrame(uris, "path STRING")
    got = by_name(inventory.count_records(spark, str(tmp_path), "CSV", expected), "records")
    assert got == {"a.csv": (3,), "empty.csv": (0,)}
    got = by_name(inventory.count_json(spark, str(tmp_path), expected), "records", "error")
    assert got["empty.csv"] == (0, None)


def test_quoted_line_breaks_are_no_records(spark, tmp_path):
    text = 'id,note\n1,"a\nb"\n2,"c\nd"\n3,e\n'
    path = put(tmp_path, "q.csv", text)
    assert inventory.count_lines(spark, path, True).first().records == 5
    options = {"multiLine": "true", "escape": '"'}
    rows = inventory.count_rows(spark, path, "CSV", "id INT, note STRING", options)
    assert rows.first().records == 3


def test_json_counts(spark, tmp_path):
    put(tmp_path, "lines.json", '{"a":1}\n\nbroken\n [1]\n12\n{"a":2} x\n')
    put(tmp_path, "one.json", '\n  [{"a":1},{"a":2}]\n')
    put(tmp_path, "many.json", json.dumps([{"a": i} for i in range(7)], indent=1))
    put(tmp_path, "bad.json", '[{"a":1},\n{"a":2}')
    put(tmp_path, "two.json", "[1]\n[2]\n")
    put(tmp_path, "none.json", "[]")
    put(tmp_path, "blank.json", " \n\t\n")
    got = by_name(inventory.count_json(spark, str(tmp_path)), "records", "error")
    broken = (None, "failed to parse JSON array")
    assert got == {
        "lines.json": (3, None),
        "one.json": (2, None),
        "many.json": (7, None),
        "bad.json": broken,
        "two.json": broken,
        "none.json": (0, None),
        "blank.json": (0, None),
    }


def test_listing_and_digests(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    put(tmp_path, "a.csv", STATIONS)
    put(tmp_path / "sub", "b.bin", b"abc")
    size = len(STATIONS)
    assert by_name(inventory.list_files(spark, str(tmp_path)), "size") == {"a.csv": (size,), "b.bin": (3,)}
    got = by_name(inventory.digests(spark, str(tmp_path)), "md5", "sha1", "sha256")["b.bin"]
    assert got == tuple(getattr(hashlib, n)(b"abc").hexdigest() for n in ("md5", "sha1", "sha256"))


def test_header_columns_with_quoted_delimiters(spark, tmp_path):
    put(tmp_path, "a.csv", 'a,"b,c",d\n1,2,3\n')
    put(tmp_path, "b.csv", "x\n1,2,3\n")
    got = by_name(inventory.header_columns(spark, str(tmp_path)), "column_count")
    assert got == {"a.csv": (3,), "b.csv": (1,)}


def test_control_records(spark, tmp_path):
    good = {
        "file_name": "c.csv", "file_size": 150, "file_hash": "h", "record_count": 3, "column_count": 6,
        "created_at": "2024-01-07T10:00:00Z", "batch_id": "b", "metadata": {"k": "v"},
    }
    path = put(tmp_path, "c.json", json.dumps(good) + "\nbroken\n")
    rows = control.read_control(spark, path).collect()
    assert rows[0].metadata == {"k": "v"} and rows[0].created_at.hour == 10
    assert rows[1].file_name is None


CONFIG = """
{"input_bucket_name": "in", "output_bucket_name": "out", "max_retries": 0, "control_ttl_days": 7,
 "prefix_mappings": [
  {"s3_prefix": "products/", "target_name": "PRODUCTS", "script_params": {"partition-by": "category , x"},
   "processing_config": {"max_file_size": 10485760, "output_format": "JSON"},
   "validation_rules": {"validate_record_count": true, "required_fields": ["product_id"]}},
  {"s3_prefix": "orders/", "target_name": "ORDERS", "entry_point": "convert"}]}
"""


def test_configuration_defaults(spark, tmp_path):
    config = control.load_config(spark, put(tmp_path, "config.json", CONFIG))
    assert (config.timeout_minutes, config.max_retries, config.ttl_days) == (60, 3, 7)
    first, second = config.mappings
    assert first.job == "standard" and second.job == "convert"
    assert first.rules.validate_record_count and not first.rules.validate_checksum
    assert (first.processing.file_format, first.processing.output_format) == ("CSV", "JSON")
    assert second.processing.max_file_size == 5 * 1024**3
    assert second.processing.output_format == "PARQUET"
    assert ConvertOptions.from_params(first.params).partition_by == ("category", "x")
    frame = control.mappings_frame(spark, config.mappings)
    assert [r.target_name for r in frame.orderBy("position").collect()] == ["PRODUCTS", "ORDERS"]


def test_configuration_needs_a_mapping():
    with pytest.raises(ValueError, match="at least one prefix mapping"):
        parse_config('{"prefix_mappings": []}')


def test_files_without_records_count_zero(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(0).write.parquet(folder)
    spark.range(3).coalesce(1).write.mode("append").parquet(folder)
    counts = inventory.count_records(spark, folder, "PARQUET").collect()
    assert sorted(r.records for r in counts) == [0, 3]
    put(tmp_path, "h.csv", "a,b\n")
    got = by_name(inventory.count_rows(spark, str(tmp_path / "h.csv"), "CSV", "a INT, b INT"), "records")
    assert got == {"h.csv": (0,)}


def test_digests_only_of_files_that_shall_be_read(spark, tmp_path):
    put(tmp_path, "a.csv", b"x" * 10)
    put(tmp_path, "b.csv", b"y" * 200)
    got = by_name(inventory.digests(spark, str(tmp_path), most_bytes=100), "md5", "unread", "size")
    assert got == {
        "a.csv": (hashlib.md5(b"x" * 10).hexdigest(), None, 10),
        "b.csv": (hashlib.md5(b"y" * 200).hexdigest(), None, 200),  # in chunks
    }
    prefix = f"{str(tmp_path).lstrip('/')}/b"
    got = by_name(inventory.digests(spark, str(tmp_path), [prefix]), "md5", "unread")
    assert got["a.csv"] == (None, "digest not asked for")
    assert got["b.csv"] == (hashlib.md5(b"y" * 200).hexdigest(), None)
