"""Files through the whole course: route, check, process per target, and log each step.

What to do with each file is decided for all files in one DataFrame. Processing then runs one
Spark job per mapping, over all its accepted files. Failures become log rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.paths import location
from tidegate.operators import quality, routing, tracking, validation
from tidegate.operators.latest import latest_per_key
from tidegate.options import Config, ConvertOptions, Mapping
from tidegate.plans.jobs import job_named
from tidegate.sinks import files as sink
from tidegate.sources import hadoop, inventory, readers

PROCESS = "process"
VALIDATED = "validated"
REJECT = "reject"

DIGESTS = ("md5", "sha1", "sha256")

#: What makes a control record newer than another one for its file.
NEWEST = ("created_at", "batch_id", "record_count", "file_size", "file_hash")

#: Files that one read of a mapping's files takes, so that their paths never fill the driver.
FILES_PER_RUN = 10_000


@dataclass(frozen=True)
class BatchOptions:
    validate_only: bool = False
    skip_validation: bool = False
    continue_on_error: bool = True


def decide(
    files: DataFrame,
    control: DataFrame | None,
    config: Config,
    options: BatchOptions = BatchOptions(),
) -> DataFrame:
    """One row per file with its target, ``errors`` and ``action``.

    ``files`` has file_path and size, and for checksums an etag or the columns of
    ``inventory.digests``. A file without control record is not checked; a control record
    without file is rejected. Both stay in the result. Messages are delivered at least once, so
    of several control records for a file the newest counts, and a file listed twice is one.
    """
    rules = [
        F.col(f"mapping.{n}").alias(n)
        for n in ("validate_record_count", "validate_file_size", "validate_checksum")
    ]
    hashes = [c for c in ("etag", *DIGESTS) if c in files.columns]
    present = files.select("file_path", F.col("size").alias("actual_size"), *hashes)
    # Listings and senders may name one place by different schemes, and more than once.
    found = present.withColumn("_place", location(F.col("file_path"))).dropDuplicates(["_place"])
    if control is None:
        joined = found.drop("_place").withColumn("_controlled", F.lit(False))
    else:
        promised = control.withColumn("_place", location(F.col("file_path")))
        promised = latest_per_key(promised, ["_place"], *[c for c in NEWEST if c in control.columns])
        promised = promised.withColumn("_controlled", F.lit(True)).withColumnRenamed("file_path", "_promised")
        joined = found.join(promised, "_place", "full_outer").withColumn(
            "file_path", F.coalesce("file_path", "_promised")
        )
        if set(DIGESTS) <= set(hashes):
            joined = validation.with_digest(joined)
        elif "etag" not in hashes:
            joined = joined.withColumn("etag", F.lit(None).cast("string"))
    routed = routing.route(joined, config.mappings)
    too_large = routing.size_error(F.col("actual_size"), F.col("mapping.max_file_size"))
    if control is None or options.skip_validation:
        failed = F.array().cast("array<string>")
        checked = routed if control is not None else routed.withColumn("record_count", F.lit(None))
    else:
        checked = validation.check_files(routed.select("*", *rules))
        failed = F.when(F.col("_controlled"), F.col("validation.validation_errors")).otherwise(
            F.array().cast("array<string>")
        )
    missing = F.when(F.col("actual_size").isNull(), F.lit("object not found"))
    reasons = F.array_distinct(
        F.concat(F.array_compact(F.array("route_error", too_large, missing)), failed)
    )
    accepted = VALIDATED if options.validate_only else PROCESS
    return checked.select(
        "file_path",
        "actual_size",
        F.col("mapping.target_name").alias("target_name"),
        F.col("mapping.position").alias("position"),
        F.col("record_count").cast("bigint").alias("expected_records"),
        reasons.alias("errors"),
        F.when(F.size(reasons) == 0, F.lit(accepted)).otherwise(F.lit(REJECT)).alias("action"),
    )


def decision_log(decisions: DataFrame, job_id: str) -> DataFrame:
    """Log rows for decided files: started, checking, then checked or failed with its reasons."""
    rows = decisions.withColumn("job_id", F.lit(job_id))
    now = F.current_timestamp()
    good = F.size("errors") == 0

    def name(step: str):
        return F.concat_ws("|", F.lit(job_id), "file_path", F.lit(step))

    def after(ms: int):
        """Steps of one file are told apart by time."""
        return F.timestamp_add("MILLISECOND", F.lit(ms), now)

    return tracking.log_entries(
        rows,
        tracking.transition("INITIATED", name("1-initiated"), now),
        tracking.transition("VALIDATING", name("2-validating"), after(1)),
        F.when(good, tracking.transition("VALIDATED", name("3-validated"), after(2))),
        F.when(
            ~good,
            tracking.error(
                name("3-rejected"),
                after(2),
                "validation",
                "VALIDATION_FAILED",
                F.concat_ws("; ", "errors"),
                False,
            ),
        ),
    )


def output_path(output_root: str, mapping: Mapping, job_id: str, position: int, run: int) -> str:
    """Where a job puts what one run over files of one mapping made.

    Below the folder of the target, so that mappings and jobs that share a target add up, while
    a job that runs again replaces only what it wrote itself. The parts are columns for a reader.
    """
    return f"{position_path(output_root, mapping, job_id, position)}/ingest_run={run}"


def position_path(output_root: str, mapping: Mapping, job_id: str, position: int) -> str:
    """The folder of all runs of a job over files of one mapping."""
    name = quote(job_id, safe="")
    return f"{output_root.rstrip('/')}/processed/{mapping.target}/ingest_job={name}/ingest_position={position}"


def process_target(
    spark: SparkSession,
    mapping: Mapping,
    paths: list[str],
    output_root: str,
    job_id: str,
    position: int = 0,
    run: int = 0,
) -> str:
    """Run a mapping's job over its files and return where the result is.

    Files that lack a required column, or one to partition by, are refused before any work. A
    ``schema`` among the mapping's parameters saves the pass that infers one, and keeps the types
    of a target the same from batch to batch.
    """
    name = mapping.processing.file_format.upper()
    options = ConvertOptions.from_params(mapping.params)
    schema = mapping.params.get("schema")
    change = job_named(mapping.job)
    if name == "CSV":
        df = readers.read_csv(spark, paths, options, schema)
    else:
        df = readers.read(spark, paths, name, schema)
    missing = quality.missing_columns(df, mapping.rules.required_fields)
    if missing:
        raise ValueError(f"{mapping.target}: required fields missing: {', '.join(missing)}")
    out = output_path(output_root, mapping, job_id, position, run)
    compression = mapping.processing.compression_type.lower() or options.compression
    sink.write(
        change(df, mapping.target, job_id, mapping.params),
        out,
        mapping.processing.output_format,
        mapping.processing.output_options.get("compression", compression),
        partition_by=options.partition_by,
        max_records_per_file=options.max_records_per_file,
    )
    return out


def in_runs(chosen: DataFrame, size: int) -> Iterator[list[str]]:
    """Paths in a fixed order, ``size`` at a time; the driver holds no more than one partition."""
    paths: list[str] = []
    for row in chosen.select("file_path").orderBy("file_path").toLocalIterator():
        paths.append(row.file_path)
        if len(paths) == size:
            yield paths
            paths = []
    if paths:
        yield paths


def reconcile_files(
    spark: SparkSession, mapping: Mapping, chosen: DataFrame, paths: list[str]
) -> DataFrame:
    """Records that were promised and that are there, per file of a target.

    CSV records are counted as the job reads them, so quoted line breaks do not count.
    """
    name = mapping.processing.file_format.upper()
    if name in ("CSV", "TSV"):
        dialect = readers.csv_settings(ConvertOptions.from_params(mapping.params)) if name == "CSV" else {}
        counted = inventory.count_rows(spark, paths, name, options={**dialect, "inferSchema": "false"})
    else:
        counted = inventory.count_records(spark, paths, name)
    before = F.struct(
        F.lit(True).alias("record_count_match"),
        F.lit(True).alias("file_size_match"),
        F.lit(True).alias("checksum_match"),
        F.col("expected_records"),
        F.lit(0).cast("bigint").alias("actual_records"),
        F.col("errors").alias("validation_errors"),
    )
    same = location(F.col("file_path")) == location(F.col("path"))
    return (
        chosen.join(counted, same, "left")
        .withColumn("before", before)
        .withColumn("after", validation.reconcile(F.col("before"), F.coalesce("records", F.lit(0))))
        .select("file_path", "target_name", "after.*")
    )


def listing(spark: SparkSession, path: str, config: Config) -> DataFrame:
    """Files below a path with the target each belongs to."""
    found = inventory.list_files(spark, path).withColumnRenamed("path", "file_path")
    return routing.route(found, config.mappings).select(
        "file_path", "size", "mod_time", F.col("mapping.target_name").alias("target_name"), "route_error"
    )


def run_batch(
    spark: SparkSession,
    files: DataFrame,
    control: DataFrame | None,
    config: Config,
    output_root: str,
    log_path: str,
    job_id: str,
    options: BatchOptions = BatchOptions(),
) -> DataFrame:
    """Decide, process, count and log a batch of files; returns the records of this job alone.

    Below ``log_path`` are the ``log``, the decisions of the job and, for mappings that check
    record counts, the counted records per file.

    A mapping that fails, in processing or in counting, is tried up to ``config.max_retries``
    times more, unless its settings are wrong. Then its files fail, and the batch goes on with the
    next mapping or stops, by option. A new try, and a new run of a job over fewer files or none,
    replace all that it wrote for the mapping; of files that fail for good nothing stays readable.
    """
    decided_path = f"{log_path}/decided-{job_id}"
    decide(files, control, config, options).write.mode("overwrite").parquet(decided_path)
    decisions = spark.read.parquet(decided_path)
    entries = f"{log_path}/log"
    decision_log(decisions, job_id).write.mode("append").parquet(entries)
    for position, mapping in enumerate(config.mappings):
        chosen = decisions.filter((F.col("action") == PROCESS) & (F.col("position") == position))
        own = (
            position_path(output_root, mapping, job_id, position),
            f"{log_path}/counted-{job_id}/position={position}",
        )
        clear(spark, own)
        if chosen.isEmpty():
            continue
        failure = None
        for attempt in range(config.max_retries + 1):
            try:
                if attempt:
                    clear(spark, own)
                for run, paths in enumerate(in_runs(chosen, FILES_PER_RUN)):
                    process_target(spark, mapping, paths, output_root, job_id, position, run)
                    if mapping.rules.validate_record_count:
                        counted = reconcile_files(spark, mapping, _only(chosen, paths), paths)
                        counted.write.mode("overwrite").parquet(
                            f"{log_path}/counted-{job_id}/position={position}/run={run}"
                        )
                failure = None
                break
            except ValueError as caught:
                # A mistake in the configuration or the files stays one however often it is tried.
                failure = caught
                _log_failure(chosen, job_id, attempt, str(caught), False, entries)
                break
            except Exception as caught:  # noqa: BLE001
                failure = caught
                _log_failure(chosen, job_id, attempt, str(caught), True, entries)
        if failure is None:
            _log_success(chosen, job_id, entries)
            continue
        clear(spark, own)
        if not options.continue_on_error:
            raise failure
    own = tracking.read_log(spark, entries).filter(F.col("job_id") == job_id)
    return tracking.fold(own, config.max_retries)


def clear(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        hadoop.remove(spark, folder)


def _only(chosen: DataFrame, paths: list[str]) -> DataFrame:
    """The part of a mapping's files that one run takes; they follow each other in order."""
    return chosen.filter(F.col("file_path").between(paths[0], paths[-1]))


def _named(step: str, job_id: str):
    return F.concat_ws("|", F.lit(job_id), "file_path", F.lit(step))


def _log_failure(
    chosen: DataFrame, job_id: str, attempt: int, message: str, retryable: bool, entries: str
) -> None:
    rows = chosen.withColumn("job_id", F.lit(job_id))
    failed = tracking.error(
        _named(f"5-failed-{attempt}", job_id),
        F.current_timestamp(),
        "processing",
        "JOB_FAILED",
        F.lit(message),
        retryable,
    )
    tracking.log_entries(rows, failed).write.mode("append").parquet(entries)


def _log_success(chosen: DataFrame, job_id: str, entries: str) -> None:
    rows = chosen.withColumn("job_id", F.lit(job_id))
    now = F.current_timestamp()
    tracking.log_entries(
        rows,
        tracking.transition("PROCESSING", _named("4-processing", job_id), now),
        tracking.transition("PROCESSED", _named("6-processed", job_id), F.timestamp_add("MILLISECOND", F.lit(1), now)),
    ).write.mode("append").parquet(entries)


def report(records: DataFrame) -> DataFrame:
    """Files and retries per job and state."""
    return records.groupBy("job_id", "orchestration_state").agg(
        F.count(F.lit(1)).alias("files"), F.sum("retry_count").alias("retries")
    )
