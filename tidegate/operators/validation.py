"""Checks of files against what their control records promise.

Each check is a column: true, false, or an error text that is null when all is well. A whole
batch of files is checked in one select, and a file that fails becomes a row with reasons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import plain_etag


def control_error(control: str = "", hash_required: Column | None = None) -> Column:
    """First thing wrong with a control record; ``control`` is a column prefix such as ``c.``.

    A missing hash only counts where ``hash_required`` holds, which is everywhere by default.
    """

    def field(name: str) -> Column:
        return F.col(f"{control}{name}")

    def blank(name: str) -> Column:
        return F.coalesce(field(name), F.lit("")) == ""

    need_hash = F.lit(True) if hash_required is None else hash_required
    # Order and wording of the checks.
    return (
        F.when(blank("file_name"), "file_name is required in control data")
        .when(F.coalesce(field("file_size"), F.lit(0)) <= 0, "file_size must be positive")
        .when(F.coalesce(field("record_count"), F.lit(0)) < 0, "record_count cannot be negative")
        .when(F.coalesce(field("column_count"), F.lit(0)) <= 0, "column_count must be positive")
        .when(need_hash & blank("file_hash"), "file_hash is required")
        .when(field("created_at").isNull(), "created_at is required")
    )


def size_error(expected: Column, actual: Column) -> Column:
    return F.when(
        ~expected.eqNullSafe(actual),
        F.format_string("File size mismatch: expected %d bytes, got %d bytes", expected, actual),
    )


def checksum_error(expected: Column, etag: Column) -> Column:
    got = plain_etag(etag)
    return F.when(
        F.coalesce(expected, F.lit("")) == "", F.lit("No checksum provided in control file")
    ).when(
        ~expected.eqNullSafe(got),
        F.format_string("Checksum mismatch: expected %s, got %s", expected, got),
    )


def record_count_error(expected: Column) -> Column:
    return F.when(expected < 0, F.lit("Invalid record count in control file"))


def column_count_error(expected: Column, actual: Column) -> Column:
    return F.when(
        expected != actual,
        F.format_string("Column count mismatch: expected %d, got %d", expected, actual),
    )


def is_valid(errors: Column) -> Column:
    return F.size(errors) == 0


def check_files(df: DataFrame) -> DataFrame:
    """Check joined file and control rows, adding ``validation`` and ``is_valid``.

    Needs the control columns, ``actual_size`` and ``etag`` of the file (null when there is no
    such file), and the three ``validate_`` switches of its mapping. A check that is off
    passes. All errors are collected; a bad control record or a missing file stops the rest.
    """
    on_size, on_hash, on_count = (
        F.coalesce(F.col(c), F.lit(False))
        for c in ("validate_file_size", "validate_checksum", "validate_record_count")
    )
    found = F.col("actual_size").isNotNull()
    bad_control = control_error(hash_required=on_hash)
    size = F.when(on_size, size_error(F.col("file_size"), F.col("actual_size")))
    digest = F.when(on_hash, checksum_error(F.col("file_hash"), F.col("etag")))
    count = F.when(on_count, record_count_error(F.col("record_count")))
    stopped = F.coalesce(bad_control, F.when(~found, F.lit("object not found")))
    errors = F.when(stopped.isNotNull(), F.array(stopped)).otherwise(
        F.array_compact(F.array(size, digest, count))
    )

    def passed(error: Column) -> Column:
        return stopped.isNull() & error.isNull()

    validation = F.struct(
        passed(count).alias("record_count_match"),
        passed(size).alias("file_size_match"),
        passed(digest).alias("checksum_match"),
        F.col("record_count").alias("expected_records"),
        F.lit(0).cast("bigint").alias("actual_records"),
        errors.alias("validation_errors"),
    )
    checked = df.withColumn("validation", validation)
    return checked.withColumn("is_valid", is_valid(F.col("validation.validation_errors")))


def match_control(control: DataFrame, files: DataFrame, on: str = "file_path") -> DataFrame:
    """Control records with the metadata of their files; a record without file stays."""
    return control.join(
        files.select(on, F.col("size").alias("actual_size"), "etag", "mod_time"), on, "left"
    )


def with_digest(df: DataFrame) -> DataFrame:
    """``etag`` replaced by the content digest of the kind that ``file_hash`` is.

    For files that were digested (``inventory.digests``); the kind shows in the length.
    """
    size = F.length("file_hash")
    kinds = {32: "md5", 40: "sha1", 64: "sha256"}
    digest = F.coalesce(*(F.when(size == n, F.col(c)) for n, c in kinds.items()), F.col("md5"))
    return df.withColumn("etag", digest).drop(*kinds.values())


def reconcile(
    validation: Column, actual: Column, more_errors: Column | None = None
) -> Column:
    """Validation struct after processing, with the counted records.

    Where records were promised the count must equal them, else one more error is added.
    """
    promised = F.coalesce(validation["expected_records"], F.lit(0)) > 0
    same = validation["expected_records"] == actual
    mismatch = F.when(
        promised & ~same,
        F.format_string(
            "Record count mismatch: expected %d, got %d", validation["expected_records"], actual
        ),
    )
    none = F.array().cast("array<string>")
    extra = none if more_errors is None else F.coalesce(more_errors, none)
    errors = F.concat(validation["validation_errors"], extra, F.array_compact(F.array(mismatch)))
    return F.struct(
        F.when(promised, same).otherwise(validation["record_count_match"]).alias("record_count_match"),
        validation["file_size_match"].alias("file_size_match"),
        validation["checksum_match"].alias("checksum_match"),
        validation["expected_records"].alias("expected_records"),
        actual.cast("bigint").alias("actual_records"),
        errors.alias("validation_errors"),
    )


def with_reason(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """``reject_reason``: name of the first test a row fails, null for good rows."""
    cases = [F.when(F.coalesce(~test, F.lit(True)), F.lit(name)) for name, test in reasons.items()]
    return df.withColumn("reject_reason", F.coalesce(*cases))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their ``reject_reason``."""
    bad = F.col("reject_reason").isNotNull()
    return df.filter(~bad).drop("reject_reason"), df.filter(bad)
