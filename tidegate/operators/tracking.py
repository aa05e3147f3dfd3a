"""Processing history of files: an append-only log, and the records folded from it.

A log row is a state transition or an error of one (file_path, job_id). Nothing is updated in
place, so a job that dies and runs again cannot leave a record half changed. All folds are
aggregates that reduce within each task first; the history itself stays as rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.functions import paths, values
from tidegate.operators.latest import latest_per_key, time_micros, with_previous
from tidegate.operators.routing import route
from tidegate.options import Mapping

KEY = ("file_path", "job_id")
_WORD_EDGE = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
_REPEATED = re.compile(r"_+")

TRANSITION = "transition"
ERROR = "error"

# States whose time a record keeps, and the column it is kept in.
STATE_TIMES = {
    "INITIATED": "processing_initiated_at",
    "VALIDATED": "validated_at",
    "PROCESSING": "processing_started",
    "PROCESSED": "processing_completed",
    "LOADED": "loaded_at",
}


def initiate(
    files: DataFrame,
    mappings: Sequence[Mapping],
    job_id: str,
    at: Column,
    ttl_days: int,
    source_system: str = "tidegate",
) -> DataFrame:
    """First record of each file, from its path, mapping and (left joined) control columns.

    Non-empty ``file_name``, ``batch_id`` and ``source_system`` of the control record win over
    the defaults. Files without a mapping come out with a ``route_error``.
    """
    key = paths.key(F.col("file_path"))
    routed = route(files, mappings)
    return routed.select(
        "file_path",
        F.lit(job_id).alias("job_id"),
        values.text_or(F.col("file_name"), paths.file_name(key)).alias("file_name"),
        F.coalesce("file_size", F.lit(0).cast("bigint")).alias("file_size"),
        F.coalesce("file_hash", F.lit("")).alias("file_hash"),
        F.coalesce(paths.directory(key), F.lit("")).alias("s3_prefix"),
        F.col("mapping.target_name").alias("target_table"),
        F.col("mapping.job").alias("processing_script"),
        F.lit("INITIATED").alias("orchestration_state"),
        values.stage_text(F.lit("INITIATED")).alias("current_stage"),
        at.alias("processing_initiated_at"),
        F.lit(0).alias("retry_count"),
        values.text_or(
            F.col("batch_id"), values.batch_id(at, F.concat_ws("|", F.lit(job_id), "file_path"))
        ).alias("batch_id"),
        values.text_or(F.col("source_system"), F.lit(source_system)).alias("source_system"),
        values.expiry(at, ttl_days).alias("expires_at"),
        F.lit(1).alias("version"),
        "route_error",
    )


def _text(value: Column | str | bool | None, kind: str = "string") -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast(kind)


def _entry(kind: str, event_id: Column, at: Column, **fields: Column | str | bool | None) -> Column:
    return F.struct(
        _text(event_id).alias("event_id"),
        at.cast("timestamp").alias("occurred_at"),
        F.lit(kind).alias("kind"),
        _text(fields.get("to_state")).alias("to_state"),
        _text(fields.get("stage")).alias("stage"),
        _text(fields.get("error_type")).alias("error_type"),
        _text(fields.get("error_message")).alias("error_message"),
        _text(fields.get("retryable"), "boolean").alias("retryable"),
        _text(fields.get("job_run_id")).alias("job_run_id"),
        _text(fields.get("metadata"), "map<string,string>").alias("metadata"),
    )


def transition(
    to_state: Column | str,
    event_id: Column,
    at: Column,
    job_run_id: Column | None = None,
    metadata: Column | None = None,
) -> Column:
    """Log entry for a change of state.

    ``event_id`` has to be made from the data, so that a rerun writes the same id again.
    """
    return _entry(
        TRANSITION, event_id, at, to_state=to_state, job_run_id=job_run_id, metadata=metadata
    )


def error(
    event_id: Column,
    at: Column,
    stage: Column | str,
    error_type: Column | str,
    message: Column,
    retryable: Column | bool,
) -> Column:
    """Log entry for an error."""
    return _entry(
        ERROR,
        event_id,
        at,
        stage=stage,
        error_type=error_type,
        error_message=message,
        retryable=retryable,
    )


def log_entries(df: DataFrame, *entries: Column) -> DataFrame:
    """Log rows from entries made of each row of ``df``, which has the key columns; an entry
    that is null for a row is left out."""
    return df.select(*KEY, F.inline(F.array_compact(F.array(*entries))))


def once(log: DataFrame) -> DataFrame:
    """The log without rows that a rerun appended again; the earliest of each stays."""
    identity = [*KEY, "event_id", "kind"]
    rest = [c for c in log.columns if c not in identity]
    first = F.min_by(F.struct(*rest), "occurred_at").alias("_row")
    return log.groupBy(*identity).agg(first).select(*identity, "_row.*").select(*log.columns)


def fold(log: DataFrame, max_retries: int, order: Sequence[str] = ("occurred_at", "event_id")) -> DataFrame:
    """Current record per (file_path, job_id).

    The state is that of the latest transition, or FAILED when a later error was final. An
    error is final when it is not retryable, or when at least ``max_retries`` retryable errors
    came before it; of these the last one decides, so counting them is enough and no key needs
    its rows in order. Any state may follow any other.
    """
    is_error = F.col("kind") == ERROR
    is_retryable = is_error & F.col("retryable")
    state = F.when(is_error, F.lit("FAILED")).otherwise(F.col("to_state"))
    step = F.struct(*order, state.alias("state"))
    folded = log.groupBy(*KEY).agg(
        F.max(F.when(~F.coalesce(is_retryable, F.lit(False)), step)).alias("_set"),
        F.max(F.when(is_retryable, step)).alias("_retry"),
        F.count_if(is_retryable).alias("_retries"),
        F.count_if(is_error).alias("errors"),
        F.count_if(~is_error).alias("transitions"),
        F.count(F.lit(1)).alias("version"),
        F.max("job_run_id").alias("job_run_id"),
        *(
            F.max(F.when(~is_error & (F.col("to_state") == s), F.col("occurred_at"))).alias(c)
            for s, c in STATE_TIMES.items()
        ),
    )
    exhausted = F.col("_retries") > max_retries
    final = F.when(exhausted, F.greatest("_set", "_retry")).otherwise(F.col("_set"))
    return folded.select(
        *KEY,
        final["state"].alias("orchestration_state"),
        values.stage_text(final["state"]).alias("current_stage"),
        F.col("_retries").alias("retry_count"),
        "errors",
        "transitions",
        "version",
        "job_run_id",
        *STATE_TIMES.values(),
    )


def history(
    log: DataFrame,
    tie: Sequence[str] = ("event_id",),
    slices: int | None = None,
) -> DataFrame:
    """Transitions as rows with ``from_state`` and ``duration_ms``, the time since the one before.

    The first has an empty ``from_state`` and 0 ms.
    """
    steps = log.filter(F.col("kind") == TRANSITION)
    numbered = steps.withColumn("_at", time_micros(steps, "occurred_at"))
    paired = numbered.withColumn("_before", F.struct("to_state", "_at"))
    linked = with_previous(paired, KEY, "occurred_at", "_before", "_previous", tie, slices)
    gap = F.expr("(_at - _previous._at) div 1000")
    return linked.select(
        *KEY,
        "event_id",
        F.coalesce("_previous.to_state", F.lit("")).alias("from_state"),
        "to_state",
        "occurred_at",
        F.coalesce(gap, F.lit(0)).cast("bigint").alias("duration_ms"),
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A written log without repeats; the schema is given, so no file is opened to infer it."""
    schema = schemas.struct(schemas.TRACKING_LOG)
    return once(spark.read.schema(schema).parquet(path).select(*schema.names))


def assemble(
    initial: DataFrame,
    folded: DataFrame,
    validated: DataFrame | None = None,
    loads: DataFrame | None = None,
) -> DataFrame:
    """Full records: how each file began (:func:`initiate`), what became of it (:func:`fold`),
    and its ``validation_results`` and ``load_results`` where frames with the key and such a
    struct are given. Its history is not packed into the record; it stays as rows of the log."""
    began = initial.drop(*(c for c in folded.columns if c not in KEY))
    details = F.struct(
        F.lit(None).cast("string").alias("application_id"),
        F.col("job_run_id"),
        F.col("processing_started").alias("start_time"),
        F.col("processing_completed").alias("end_time"),
        F.col("orchestration_state").alias("status"),
        F.lit(None).cast("bigint").alias("processed_records"),
    )
    out = began.join(folded, list(KEY), "left").withColumn(
        "emr_job_details", details.cast(schemas.struct(schemas.JOB_DETAILS))
    )
    for name, kind, frame in (
        ("validation_results", schemas.VALIDATION, validated),
        ("load_results", schemas.LOAD_RESULTS, loads),
    ):
        if frame is None:
            out = out.withColumn(name, F.lit(None).cast(schemas.struct(kind)))
        else:
            out = out.join(frame.select(*KEY, F.col(name).cast(schemas.struct(kind))), list(KEY), "left")
    return out.drop("job_run_id")


def newest_versions(records: DataFrame) -> DataFrame:
    """Record with the highest version of each (file_path, job_id)."""
    return latest_per_key(records, KEY, "version")


def lookup(records: DataFrame, file_path: str, job_id: str) -> DataFrame:
    """One record by its key."""
    return records.filter((F.col("file_path") == file_path) & (F.col("job_id") == job_id)).limit(1)


def select_records(
    records: DataFrame,
    file_path: str | None = None,
    job_id: str | None = None,
    batch_id: str | None = None,
    state: str | None = None,
    newest_first: bool = False,
) -> DataFrame:
    """Records by any of file, job, batch and state, by the time they started."""
    wanted = {
        "file_path": file_path,
        "job_id": job_id,
        "batch_id": batch_id,
        "orchestration_state": state,
    }
    for name, value in wanted.items():
        if value is not None:
            records = records.filter(F.col(name) == value)
    start = F.col("processing_initiated_at")
    return records.orderBy(start.desc() if newest_first else start.asc(), *KEY)


def expired(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Records past their expiry second."""
    return records.filter(F.col("expires_at") < (F.unix_timestamp() if now is None else now))


def elapsed(records: DataFrame) -> DataFrame:
    """Whole seconds from the start of each record to the end of its processing."""
    spent = F.timestamp_diff("SECOND", F.col("processing_initiated_at"), F.col("processing_completed"))
    return records.withColumn("elapsed_seconds", spent)


def batch_summary(records: DataFrame, by: str = "batch_id") -> DataFrame:
    """Files per batch (or job) and state, with first start and last completion."""
    return records.groupBy(by, "orchestration_state").agg(
        F.count(F.lit(1)).alias("files"),
        F.min("processing_initiated_at").alias("first_started"),
        F.max("processing_completed").alias("last_completed"),
    )


def control_record(control: DataFrame, job_id: str, at: Column, ttl_days: int) -> DataFrame:
    """Control data as a pending processing entry of its file."""
    no_time = F.lit(None).cast("timestamp")
    return control.select(
        "file_path",
        F.lit("").alias("control_file_path"),
        F.lit(job_id).alias("job_id"),
        "file_name",
        "file_size",
        "file_hash",
        "record_count",
        "column_count",
        "created_at",
        no_time.alias("processed_at"),
        no_time.alias("validated_at"),
        F.lit("PENDING").alias("validation_status"),
        F.lit("PENDING").alias("processing_status"),
        F.lit("").alias("error_message"),
        values.expiry(at, ttl_days).alias("expires_at"),
    )


def snake_case(df: DataFrame) -> DataFrame:
    """Column names such as ``File_path`` or ``JobRunID`` in snake case."""
    return df.withColumnsRenamed({c: _snake(c) for c in df.columns})


def original_case(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The reverse of :func:`snake_case`, for the given original names."""
    return df.withColumnsRenamed({_snake(n): n for n in names})


def _snake(name: str) -> str:
    marked = _WORD_EDGE.sub("_", name)
    return _REPEATED.sub("_", marked).lower()


def job_outcomes(events: DataFrame, records: DataFrame) -> DataFrame:
    """End-of-run events joined to the record that holds their ``job_run_id``.

    ``events`` may be a stream. Only terminal states count; an event delivered more than once
    is kept, to be dropped by :func:`once`. An event of an unknown run has a null file_path.
    """
    terminal = [schemas.JOB_SUCCEEDED, *schemas.JOB_BROKEN]
    known = records.select(*KEY, "job_run_id").filter(F.col("job_run_id").isNotNull())
    return events.filter(F.col("state").isin(*terminal)).join(known, "job_run_id", "left")


def outcome_log(outcomes: DataFrame) -> DataFrame:
    """Log rows for joined end-of-run events.

    Success makes a file PROCESSED. Anything else makes it FAILED and adds a retryable error.
    """
    ok = F.col("state") == schemas.JOB_SUCCEEDED
    known = outcomes.filter(F.col("file_path").isNotNull())
    at = F.col("event_time")
    # Wording, stage and type of the error.
    message = F.concat(
        F.lit("EMR job failed with state: "),
        F.col("state"),
        F.coalesce(F.concat(F.lit(", details: "), F.col("state_details")), F.lit("")),
    )
    to_state = F.when(ok, F.lit("PROCESSED")).otherwise(F.lit("FAILED"))
    step = transition(to_state, F.col("event_id"), at, F.col("job_run_id"))
    failure = error(F.col("event_id"), at, "emr_processing", "JOB_FAILED", message, True)
    return log_entries(known, step, F.when(~ok, failure))


def unknown_runs(outcomes: DataFrame) -> DataFrame:
    """Events whose run no record knows."""
    return outcomes.filter(F.col("file_path").isNull())
