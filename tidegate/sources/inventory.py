"""What lies below a path: files, their sizes and digests, and how many records they hold.

Counters give a row for every listed file, 0 for one without records. File sources never list
files of length zero; where those matter, pass ``expected``, the paths that should exist.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import paths
from tidegate.functions.jsontext import array_size, is_json
from tidegate.session import work_folder
from tidegate.sources import file_digests, split_files
from tidegate.sources.readers import read

# Characters that count as blank around a JSON line.
BLANKS = " \t\r\n\v\f"

FILE_PATH = "_metadata.file_path"

#: Bytes of the largest file that can be one value.
MOST_BYTES = 2**31 - 1024


def file_rows(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """One row per file, for uses that do not touch ``content``.

    Spark makes tasks by the bytes of the files, which are not read here, so a large table
    would get very many empty ones. They are joined without a shuffle.
    """
    rows = spark.read.format("binaryFile").options(**options).load(path)
    return rows.coalesce(spark.sparkContext.defaultParallelism)


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, size and modification time of each file. No file content is read; Spark's driver
    lists the files, as it does for every table."""
    return file_rows(spark, path, recursiveFileLookup="true").select(
        F.col(FILE_PATH).alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mod_time"),
    )


def digests(
    spark: SparkSession, path: str, prefixes: Sequence[str] | None = None, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """MD5, SHA-1 and SHA-256 of each file's bytes, and why there are none.

    Only files whose keys start with one of ``prefixes`` are read, if those are given; the others
    have an ``unread`` reason. A file is one value up to ``most_bytes``, and larger ones are read
    in chunks, see :mod:`file_digests`.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    key = paths.key(F.col(FILE_PATH))
    asked = F.lit(True) if prefixes is None else F.lit(False)
    for prefix in prefixes or ():
        asked = asked | F.startswith(key, F.lit(prefix))
    small = F.col("length") <= most_bytes
    none = F.lit(None).cast("string")
    read_ = files.filter(asked & small).select(
        F.col(FILE_PATH).alias("path"),
        F.col("length").alias("size"),
        F.md5("content").alias("md5"),
        F.sha1("content").alias("sha1"),
        F.sha2("content", 256).alias("sha256"),
        none.alias("unread"),
    )
    rest = file_rows(spark, path, recursiveFileLookup="true")
    skipped = rest.filter(~asked).select(
        F.col(FILE_PATH).alias("path"),
        F.col("length").alias("size"),
        *(none.alias(n) for n in ("md5", "sha1", "sha256")),
        F.lit("digest not asked for").alias("unread"),
    )
    found = read_.union(skipped)
    # of these there is one at most for each ``most_bytes`` of all data
    large = [r.path for r in rest.filter(asked & ~small).select(F.col(FILE_PATH).alias("path")).collect()]
    if large:
        found = found.union(file_digests.streamed_digests(spark, large).withColumn("unread", none))
    return found


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)


def _with_expected(
    counts: DataFrame, expected: DataFrame | None, path: str | list[str]
) -> DataFrame:
    """Counts of the ``expected`` paths (default: of all listed files), 0 where no record was seen."""
    if expected is None:
        expected = list_files(counts.sparkSession, path)
    found = counts.withColumnRenamed("path", "_path")
    same = paths.location(F.col("path")) == paths.location(F.col("_path"))
    joined = expected.select("path").join(found, same, "left")
    zero = F.when(F.col("_path").isNull(), F.lit(0)).otherwise(F.col("records"))
    return joined.withColumn("records", zero.cast("bigint")).drop("_path")


def count_lines(
    spark: SparkSession, path: str | list[str], header: bool, expected: DataFrame | None = None
) -> DataFrame:
    """Physical lines per file, without the header line when there is one.

    Lines are counted in each split before the shuffle, so one huge file is no hot spot.
    """
    lines = F.count(F.lit(1)) - F.lit(1 if header else 0)
    counts = (
        _lines(spark, path)
        .groupBy(F.col(FILE_PATH).alias("path"))
        .agg(F.greatest(lines, F.lit(0)).cast("bigint").alias("records"))
    )
    return _with_expected(counts, expected, path)


def count_rows(
    spark: SparkSession,
    path: str | list[str],
    file_format: str,
    schema: str | None = None,
    options: dict[str, str] | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Records per file as the reader of that format sees them.

    For CSV with quoted line breaks this, not the line count, is the number of records.
    """
    counts = (
        read(spark, path, file_format, schema, options)
        .groupBy(F.col(FILE_PATH).alias("path"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return _with_expected(counts, expected, path)


def valid_json_lines(line: Column) -> Column:
    """Aggregate: lines that are one valid JSON value each; blank and broken ones are skipped."""
    text = F.btrim(line, F.lit(BLANKS))
    return F.count_if((text != "") & is_json(text))


def count_json(spark: SparkSession, path: str | list[str], expected: DataFrame | None = None) -> DataFrame:
    """Records per JSON file: array elements when the file starts with ``[``, else valid lines.

    Files are read line by line. Arrays that span several lines are read again by splits, see
    :func:`split_files.count_arrays`; no file is one value. A broken array has null records and
    an error text.
    """
    text = F.col("text")
    opens = F.startswith(text, F.lit("["))
    # What a line adds is worked out here, so that no text is sorted or shuffled after it.
    lines = (
        _lines(spark, path)
        .select(
            F.col(FILE_PATH).alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.btrim("value", F.lit(BLANKS)).alias("text"),
        )
        .filter(text != "")
        .select(
            "path",
            "start",
            F.monotonically_increasing_id().alias("at"),
            opens.alias("opens"),
            is_json(text).alias("valid"),
            F.when(opens, array_size(text)).alias("elements"),
        )
    )
    splits = lines.groupBy("path", "start").agg(
        F.min("at").alias("first"),
        F.min(F.when(F.col("opens"), F.col("at"))).alias("first_open"),
        F.count(F.lit(1)).alias("filled"),
        F.count_if("valid").alias("valid"),
        F.max("elements").alias("elements"),
    )
    # A file is an array when the first filled line of its first split opens one.
    opened = F.coalesce(F.col("first") == F.col("first_open"), F.lit(False))
    per_file = splits.groupBy("path").agg(
        F.min_by(opened, "start").alias("in_array"),
        F.sum("filled").alias("filled"),
        F.sum("valid").alias("valid"),
        F.max("elements").alias("elements"),
    )
    # One row per file, used twice below; written, so that the files are read once.
    kept = work_folder(spark, "json-counts")
    per_file.write.parquet(kept)
    seen = spark.read.parquet(kept)
    in_array = F.col("in_array")
    broken = F.lit("failed to parse JSON array")
    by_line = seen.filter(~in_array | (F.col("filled") == 1)).select(
        "path",
        F.when(in_array, F.col("elements")).otherwise(F.col("valid")).cast("bigint").alias("records"),
        F.when(in_array & F.col("elements").isNull(), broken).alias("error"),
    )
    spanning = seen.filter(in_array & (F.col("filled") > 1)).select("path")
    counts = by_line
    if not spanning.isEmpty():
        whole = split_files.count_arrays(spark, path, spanning)
        whole = whole.select("path", "records", F.when(F.col("broken"), broken).alias("error"))
        counts = by_line.unionByName(whole)
    return _with_expected(counts, expected, path)


def count_records(
    spark: SparkSession, path: str | list[str], file_format: str, expected: DataFrame | None = None
) -> DataFrame:
    """path and records per file, by the counting rule of the format."""
    name = file_format.upper()
    if name in ("CSV", "TSV"):
        return count_lines(spark, path, True, expected)
    if name == "JSON":
        return count_json(spark, path, expected).select("path", "records")
    if name == "PARQUET":
        return count_rows(spark, path, "PARQUET", expected=expected)
    return count_lines(spark, path, False, expected)


def _width(header: Column, delimiter: str) -> Column:
    """Columns that a header line names; quoted delimiters do not count."""
    quoted = F.regexp_replace(header, r'"([^"]|"")*"', "")
    parts = F.size(F.split(quoted, F.lit(re.escape(delimiter)), F.lit(-1)))
    spare = F.length(header) - F.length(F.replace(header, F.lit(delimiter)))
    plain = F.lit(1) + (spare / len(delimiter)).cast("int")
    return F.when(F.contains(header, F.lit('"')), parts).otherwise(plain)


def lines_and_columns(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """Lines after the header, and columns of the header, per delimited file, in one scan.

    Splits count their lines. Each line of a first split becomes the number of its columns before
    the aggregate, so no text is sorted or shuffled.
    """
    starts = F.col("_metadata.file_block_start") == 0
    at = F.when(starts, F.monotonically_increasing_id())
    lines = _lines(spark, path).select(
        F.col(FILE_PATH).alias("path"), at.alias("at"), F.when(starts, _width(F.col("value"), delimiter)).alias("width")
    )
    found = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("lines"), F.min_by("width", "at").alias("column_count")
    )
    records = F.greatest(F.col("lines") - 1, F.lit(0)).cast("bigint")
    return found.select("path", records.alias("records"), "column_count")


def header_columns(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Number of columns per delimited file, told by its first line. Where lines are counted too,
    :func:`lines_and_columns` does both in one scan."""
    return lines_and_columns(spark, path, delimiter).select("path", "column_count")
