"""The three file jobs: read, standardise, clean, stamp and write, with counts.

Each is one lazy plan and one execution. Row counts are observed while the result is written.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import audit, profiles, quality
from tidegate.options import ConvertOptions
from tidegate.sinks import files as sink
from tidegate.sources import readers


def standardise(df: DataFrame, target: str, job_id: str, source_system: str = audit.SOURCE_SYSTEM) -> DataFrame:
    """Stamp, then profile, then drop all-null rows and collapse white space."""
    stamped = audit.stamp_standard(df, job_id, source_system)
    shaped = profiles.apply_profile(stamped, target, profiles.STANDARD_STEPS)
    return quality.collapse_text(quality.drop_null_rows(shaped))


def convert(
    df: DataFrame,
    target: str,
    job_id: str,
    options: ConvertOptions = ConvertOptions(),
    framework_version: str = audit.FRAMEWORK_VERSION,
) -> DataFrame:
    """Stamp, number, clean, drop empty rows, then profile; the middle three by option."""
    out = audit.stamp_conversion(df, job_id, target, framework_version)
    if options.add_row_id:
        out = audit.add_row_id(out)
    if options.clean_strings:
        out = quality.squeeze_text(out)
    if options.validate_data:
        out = quality.drop_empty_rows(out)
    return profiles.apply_profile(out, target, profiles.CONVERT_STEPS)


def pass_through(df: DataFrame, job_id: str) -> DataFrame:
    """Stamp and drop all-null rows."""
    return quality.drop_null_rows(audit.stamp_basic(df, job_id))


@dataclass(frozen=True)
class JobStats:
    input_records: int
    output_records: int
    processing_time_seconds: float

    @property
    def data_quality_issues(self) -> int:
        return self.input_records - self.output_records

    @property
    def records_per_second(self) -> float:
        seconds = self.processing_time_seconds
        return self.output_records / seconds if seconds > 0 else 0.0

    def frame(self, spark: SparkSession) -> DataFrame:
        row = (
            self.input_records,
            self.output_records,
            self.processing_time_seconds,
            self.data_quality_issues,
            self.records_per_second,
        )
        names = (
            "input_records BIGINT, output_records BIGINT, processing_time_seconds DOUBLE, "
            "data_quality_issues BIGINT, records_per_second DOUBLE"
        )
        return spark.createDataFrame([row], names)


def run_counted(
    df: DataFrame, change: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]
) -> JobStats:
    """Write ``change(df)`` and count its rows before and after on the way.

    Observed counts are exact as long as they are taken in the stage that writes: Spark counts
    each finished task of that stage once, also when it had to run again. So ``change`` and
    ``write`` must not shuffle; :func:`run_gathered` is for those that do.
    """
    started = time.monotonic()
    if df.isEmpty():
        # Spark may drop the counters together with a plan that has no rows.
        write(change(df))
        return JobStats(0, 0, time.monotonic() - started)
    before, after = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    write(change(df.observe(before, rows)).observe(after, rows))
    return JobStats(before.get["rows"], after.get["rows"], time.monotonic() - started)


def run_gathered(
    df: DataFrame, change: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None], path: str
) -> JobStats:
    """As :func:`run_counted`, for writes that shuffle.

    A map task that runs again after its executor is lost would be observed twice, so the
    output is counted from the footers of the written files and the input by a scan of no columns.
    """
    started = time.monotonic()
    write(change(df))
    written = df.sparkSession.read.parquet(path).count()
    return JobStats(df.count(), written, time.monotonic() - started)


def run_standard(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    target: str,
    job_id: str,
    file_format: str = "CSV",
    output_format: str = "PARQUET",
    compression: str = "snappy",
    schema: str | None = None,
    options: dict[str, str] | None = None,
    max_records_per_file: int | None = None,
) -> JobStats:
    """Standard job from an input path to an output path."""
    sink.check_format(output_format)
    df = readers.read(spark, input_path, file_format, schema, options)
    return run_counted(
        df,
        lambda d: standardise(d, target, job_id),
        lambda d: sink.write(
            d, output_path, output_format, compression, max_records_per_file=max_records_per_file
        ),
    )


def run_convert(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    target: str = "CONVERTED_DATA",
    job_id: str = "csv-to-parquet",
    options: ConvertOptions = ConvertOptions(),
    schema: str | None = None,
) -> JobStats:
    """Conversion job: CSV to Parquet, optionally partitioned."""
    df = readers.read_csv(spark, input_path, options, schema)
    sink.check_columns(df, options.partition_by)

    def change(d: DataFrame) -> DataFrame:
        return convert(d, target, job_id, options)

    def write(d: DataFrame) -> None:
        sink.write(
            d,
            output_path,
            compression=options.compression,
            partition_by=options.partition_by,
            max_records_per_file=options.max_records_per_file,
        )

    if options.partition_by:
        return run_gathered(df, change, write, output_path)
    return run_counted(df, change, write)


def run_basic(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    job_id: str = "local-test",
    file_format: str = "CSV",
    output_format: str = "PARQUET",
) -> JobStats:
    """Basic job: data below ``<output>/data`` and a marker beside it."""
    sink.check_format(output_format)
    df = readers.read(spark, input_path, file_format)
    return run_counted(
        df,
        lambda d: pass_through(d, job_id),
        lambda d: sink.write_with_marker(d, output_path, output_format),
    )


#: Processing functions by name: (DataFrame, target, job id, parameters) to DataFrame.
Job = Callable[[DataFrame, str, str, dict[str, str]], DataFrame]

JOBS: dict[str, Job] = {
    "standard": lambda df, target, job_id, params: standardise(df, target, job_id),
    "convert": lambda df, target, job_id, params: convert(
        df, target, job_id, ConvertOptions.from_params(params)
    ),
    "basic": lambda df, target, job_id, params: pass_through(df, job_id),
}


def register_job(name: str, job: Job) -> None:
    """Make a processing function available to mappings under ``name``."""
    JOBS[name] = job


def job_named(name: str) -> Job:
    if name not in JOBS:
        raise ValueError(f"unknown job: {name} (known: {', '.join(sorted(JOBS))})")
    return JOBS[name]
