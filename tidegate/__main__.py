"""Entry point for spark-submit: ``python -m tidegate <job> --input-path ... --output-path ...``.

Prints the counts of the run as one JSON line. Fails when the input lacks required fields or
does not have the expected number of records.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidegate.operators.quality import missing_columns
from tidegate.options import ConvertOptions
from tidegate.plans import batch, jobs
from tidegate.session import build_session
from tidegate.sources import control, inventory, readers

# Switches of the conversion job, named as mappings name them.
PARAMETERS = (
    "csv-delimiter",
    "csv-quote",
    "csv-escape",
    "csv-header",
    "csv-multiline",
    "compression",
    "partition-by",
    "max-records-per-file",
    "clean-strings",
    "validate-data",
    "add-row-id",
)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidegate")
    kinds = top.add_subparsers(dest="job", required=True)
    for name in ("standard", "convert", "basic"):
        job = kinds.add_parser(name)
        job.add_argument("--input-path", required=True)
        job.add_argument("--output-path", required=True)
        job.add_argument("--job-id", default="local-test" if name == "basic" else None, required=name == "standard")
        job.add_argument("--schema", help="column list; saves the pass that infers types")
        job.add_argument("--expected-records", type=int)
        job.add_argument("--required-fields", default="")
        if name != "convert":
            job.add_argument("--file-format", "--input-format", default="CSV")
            job.add_argument("--output-format", default="PARQUET")
        if name == "standard":
            job.add_argument("--target-name", "--target-table", required=True)
            job.add_argument("--compression", default="SNAPPY")
            job.add_argument("--max-records-per-file", type=int)
        if name == "convert":
            job.add_argument("--target-name", default="CONVERTED_DATA")
            for parameter in PARAMETERS:
                job.add_argument(f"--{parameter}")
    course = kinds.add_parser("batch", help="route, check and process all files below a path")
    course.add_argument("--config", required=True)
    course.add_argument("--input-path", required=True)
    course.add_argument("--control-path")
    course.add_argument("--output-path", required=True)
    course.add_argument("--log-path", required=True)
    course.add_argument("--job-id", required=True)
    course.add_argument("--validate-only", action="store_true")
    course.add_argument("--skip-validation", action="store_true")
    course.add_argument("--stop-on-error", action="store_true")
    return top


def _check_fields(spark: SparkSession, args: argparse.Namespace, options: ConvertOptions) -> None:
    required = [f.strip() for f in args.required_fields.split(",") if f.strip()]
    if not required:
        return
    if args.job == "convert":
        df = readers.read_csv(spark, args.input_path, options, args.schema)
    else:
        df = readers.read(spark, args.input_path, args.file_format, args.schema)
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"required fields missing: {', '.join(missing)}")


def _run_file_job(spark: SparkSession, args: argparse.Namespace) -> dict:
    given = {p: getattr(args, p.replace("-", "_"), None) for p in PARAMETERS}
    options = ConvertOptions.from_params({p: str(v) for p, v in given.items() if v is not None})
    _check_fields(spark, args, options)
    if args.job == "standard":
        stats = jobs.run_standard(
            spark,
            args.input_path,
            args.output_path,
            args.target_name,
            args.job_id,
            args.file_format,
            args.output_format,
            "none" if args.compression.upper() == "NONE" else args.compression,
            args.schema,
            max_records_per_file=args.max_records_per_file,
        )
    elif args.job == "convert":
        job_id = args.job_id or "csv-to-parquet"
        stats = jobs.run_convert(
            spark, args.input_path, args.output_path, args.target_name, job_id, options, args.schema
        )
    else:
        stats = jobs.run_basic(
            spark, args.input_path, args.output_path, args.job_id, args.file_format, args.output_format
        )
    errors = []
    if args.expected_records and stats.input_records != args.expected_records:
        errors.append(f"Record count mismatch: expected {args.expected_records}, got {stats.input_records}")
    return {
        "input_records": stats.input_records,
        "output_records": stats.output_records,
        "data_quality_issues": stats.data_quality_issues,
        "processing_time_seconds": round(stats.processing_time_seconds, 3),
        "records_per_second": round(stats.records_per_second, 1),
        "errors": errors,
    }


def _run_batch(spark: SparkSession, args: argparse.Namespace) -> dict:
    config = control.load_config(spark, args.config)
    # Digests read every byte, so they are taken only of files whose mapping checks them.
    checked = [m.prefix for m in config.mappings if m.rules.validate_checksum]
    if args.control_path and checked:
        files = inventory.digests(spark, args.input_path, checked)
    else:
        files = inventory.list_files(spark, args.input_path)
    files = files.withColumnRenamed("path", "file_path")
    records = batch.run_batch(
        spark,
        files,
        control.read_control(spark, args.control_path) if args.control_path else None,
        config,
        args.output_path,
        args.log_path,
        args.job_id,
        batch.BatchOptions(args.validate_only, args.skip_validation, not args.stop_on_error),
    )
    states = {r.orchestration_state: r.files for r in batch.report(records).collect()}
    return {"files": states, "errors": []}


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(arguments)
    session = spark or build_session(f"tidegate-{args.job}-{args.job_id}")
    try:
        result = _run_batch(session, args) if args.job == "batch" else _run_file_job(session, args)
    finally:
        if spark is None:
            session.stop()
    print(json.dumps(result))
    return 1 if result["errors"] else 0


if __name__ == "__main__":
    sys.exit(main())
