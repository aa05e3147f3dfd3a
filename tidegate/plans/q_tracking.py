"""Queries over routing, validation and the processing history of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions import paths, text, values
from tidegate.operators.latest import with_previous
from tidegate.operators import routing, tracking, validation
from tidegate.options import Mapping, Processing, Rules
from tidegate.plans import inputs
from tidegate.plans.registry import query, table
from tidegate.schemas import STAGE_TEXT
from tidegate.session import work_folder
from tidegate.sources import control as control_source
from tidegate.streaming.envelopes import as_envelopes

# --- routing ------------------------------------------------------------------------------

MAPPINGS = (
    Mapping("customers/", "CUSTOMERS", rules=Rules(True, True, True, ("customer_id", "name", "email"))),
    Mapping("customers/2024/", "CUSTOMERS_2024", processing=Processing(max_file_size=50)),
    Mapping("orders/", "ORDERS", rules=Rules(True, False, True), processing=Processing("PARQUET")),
    Mapping("orders/", "ORDERS_AGAIN"),
    Mapping("analytics/", "ANALYTICS_EVENTS", processing=Processing("JSON")),
)

MAPPING_SQL = (
    "(VALUES ('customers/', 'CUSTOMERS', 0), ('customers/2024/', 'CUSTOMERS_2024', 1), "
    "('orders/', 'ORDERS', 2), ('orders/', 'ORDERS_AGAIN', 3), ('analytics/', 'ANALYTICS_EVENTS', 4)) "
    "AS m(prefix, target, position)"
)

FILE_PATHS = (
    "event_id",
    "user_id",
    "CASE event_id % 8 WHEN 0 THEN concat('s3://in/customers/', event_type, '/', event_id, '.csv.gz') "
    "WHEN 1 THEN concat('s3://in/customers/2024/', event_id, '.JSON.gzip') "
    "WHEN 2 THEN concat('s3://in/orders/', user_id, '/', event_id, '.parquet') "
    "WHEN 3 THEN concat('in/analytics/', event_id, '.ndjson.bz2') "
    "WHEN 4 THEN concat('s3://in/unknown/', event_id, '.tsv.zip') "
    "WHEN 5 THEN concat('s3://', event_type) "
    "WHEN 6 THEN concat('s3://in/', event_id, '.jsonl') "
    "ELSE concat('s3://other/customers/', event_id, '.TSV') END AS file_path",
)

FILES_SQL = inputs.select("events", FILE_PATHS)

KEY_SQL = "regexp_replace(regexp_replace(file_path, '^s3://', ''), '^[^/]*/', '')"
HAS_KEY_SQL = "position('/' IN regexp_replace(file_path, '^s3://', '')) > 0"


@query(
    "path_parts",
    rf"""
    SELECT event_id, file_path,
           CASE WHEN {HAS_KEY_SQL} THEN split_part(regexp_replace(file_path, '^s3://', ''), '/', 1) END AS bucket,
           CASE WHEN {HAS_KEY_SQL} THEN {KEY_SQL} END AS key,
           CASE WHEN {HAS_KEY_SQL} THEN regexp_extract({KEY_SQL}, '^(.*/)?[^/]*$', 1) END AS directory,
           CASE WHEN {HAS_KEY_SQL} THEN regexp_extract({KEY_SQL}, '[^/]*$') END AS file_name,
           regexp_matches(lower(file_path), '\.(gz|gzip|bz2|zip)$') AS compressed,
           CASE regexp_extract(regexp_replace(lower(file_path), '\.(gz|gzip|bz2)$', ''), '\.[a-z]+$')
                WHEN '.tsv' THEN 'TSV' WHEN '.json' THEN 'JSON' WHEN '.jsonl' THEN 'JSONL'
                WHEN '.ndjson' THEN 'JSONL' WHEN '.parquet' THEN 'PARQUET' ELSE 'CSV' END AS format
    FROM {FILES_SQL}
    """,
)
def path_parts(spark, folder):
    path = F.col("file_path")
    key = paths.key(path)
    return inputs.columns(spark, folder, "events", FILE_PATHS).select(
        "event_id",
        "file_path",
        paths.bucket(path).alias("bucket"),
        key.alias("key"),
        paths.directory(key).alias("directory"),
        paths.file_name(key).alias("file_name"),
        paths.is_compressed(path).alias("compressed"),
        paths.file_format(path).alias("format"),
    )


@query(
    "route_files",
    f"""
    WITH f AS (SELECT event_id, file_path, {HAS_KEY_SQL} AS has_key, {KEY_SQL} AS key FROM {FILES_SQL}),
    hit AS (SELECT event_id, target, row_number() OVER (PARTITION BY event_id
                   ORDER BY length(prefix) DESC, position) AS rn
            FROM f JOIN {MAPPING_SQL} ON has_key AND starts_with(key, prefix))
    SELECT f.event_id, f.file_path, target AS target_name,
           CASE WHEN NOT has_key THEN concat('invalid S3 path format: ', file_path)
                WHEN target IS NULL THEN concat('no prefix mapping found for key: ', key) END AS route_error
    FROM f LEFT JOIN hit ON f.event_id = hit.event_id AND rn = 1
    """,
)
def route_files(spark, folder):
    files = inputs.columns(spark, folder, "events", FILE_PATHS)
    return routing.route(files, MAPPINGS).select(
        "event_id", "file_path", F.col("mapping.target_name").alias("target_name"), "route_error"
    )


REGION_FILES = (
    "c_custkey",
    "concat('s3://in/', CASE WHEN c_custkey % 9 = 4 THEN 'x' ELSE 'n' END, c_nationkey, '/', "
    "CASE WHEN c_custkey % 4 = 1 THEN 'ALL' ELSE c_mktsegment END, '/', c_custkey, '.csv') AS file_path",
)


@query(
    "route_files_by_table",
    f"""
    WITH m AS (
        SELECT concat('n', n_nationkey, '/') AS prefix, n_name AS target FROM nation
        UNION ALL SELECT DISTINCT concat('n', c_nationkey, '/', c_mktsegment, '/'),
               concat(c_mktsegment, '_', c_nationkey) FROM customer),
    f AS (SELECT * FROM {inputs.select('customer', REGION_FILES)}),
    hit AS (SELECT c_custkey, target, row_number() OVER (PARTITION BY c_custkey
                   ORDER BY length(prefix) DESC) AS rn
            FROM f JOIN m ON starts_with(substr(file_path, 9), prefix))
    SELECT f.c_custkey, target AS target_name,
           CASE WHEN target IS NULL
                THEN concat('no prefix mapping found for key: ', substr(file_path, 9)) END AS route_error
    FROM f LEFT JOIN hit ON f.c_custkey = hit.c_custkey AND rn = 1
    """,
)
def route_files_by_table(spark, folder):
    nations = table(spark, folder, "nation").selectExpr(
        "concat('n', n_nationkey, '/') AS s3_prefix", "n_name AS target_name", "0 AS position"
    )
    segments = (
        table(spark, folder, "customer")
        .selectExpr(
            "concat('n', c_nationkey, '/', c_mktsegment, '/') AS s3_prefix",
            "concat(c_mktsegment, '_', c_nationkey) AS target_name",
            "1 AS position",
        )
        .distinct()
    )
    files = inputs.columns(spark, folder, "customer", REGION_FILES)
    return routing.route_by_table(files, nations.unionByName(segments)).select(
        "c_custkey", F.col("mapping.target_name").alias("target_name"), "route_error"
    )


@query(
    "file_size_limit",
    """
    SELECT doc_id, CASE WHEN n_chars > 50 THEN
           concat('File size ', n_chars, ' exceeds maximum 50') END AS reject_reason FROM documents
    """,
)
def file_size_limit(spark, folder):
    sized = table(spark, folder, "documents").withColumn(
        "file_path", F.concat(F.lit("s3://in/customers/2024/"), F.col("doc_id"))
    )
    limit = F.col("mapping.max_file_size")
    return routing.route(sized, MAPPINGS).select(
        "doc_id", routing.size_error(F.col("n_chars"), limit).alias("reject_reason")
    )


# --- validation ---------------------------------------------------------------------------

CONTROL = (
    "concat('s3://in/', source, '/', doc_id, '.txt') AS file_path",
    "CASE WHEN doc_id % 41 = 1 THEN '' ELSE concat(doc_id, '.txt') END AS file_name",
    "CASE WHEN doc_id % 43 = 2 THEN 0 WHEN doc_id % 5 = 3 THEN n_chars + 1 ELSE n_chars END AS file_size",
    "CASE WHEN doc_id % 11 = 4 THEN '' WHEN doc_id % 7 = 5 THEN 'none' ELSE md5(text) END AS file_hash",
    "CASE WHEN doc_id % 47 = 6 THEN -1 ELSE doc_id END AS record_count",
    "CASE WHEN doc_id % 53 = 7 THEN 0 ELSE 1 END AS column_count",
    "CASE WHEN doc_id % 59 = 8 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at",
    "lang",
)

STORED = (
    "concat('s3://in/', source, '/', doc_id, CASE WHEN doc_id % 61 = 9 THEN '.part' ELSE '.txt' END) AS file_path",
    "n_chars AS size",
    "concat('\"', md5(text), '\"') AS etag",
)


@query(
    "validate_files",
    f"""
    WITH c AS (SELECT * FROM {inputs.select('documents', CONTROL)}),
    f AS (SELECT * FROM {inputs.select('documents', STORED)}),
    j AS (SELECT c.*, f.size, trim(f.etag, '"') AS etag, lang <> 'en' AS on_hash
          FROM c LEFT JOIN f ON c.file_path = f.file_path),
    e AS (SELECT *, CASE WHEN file_name = '' THEN 'file_name is required in control data'
                WHEN file_size <= 0 THEN 'file_size must be positive'
                WHEN record_count < 0 THEN 'record_count cannot be negative'
                WHEN column_count <= 0 THEN 'column_count must be positive'
                WHEN on_hash AND file_hash = '' THEN 'file_hash is required'
                WHEN created_at IS NULL THEN 'created_at is required'
                WHEN size IS NULL THEN 'object not found' END AS stopped,
           CASE WHEN file_size <> size THEN
                concat('File size mismatch: expected ', file_size, ' bytes, got ', size, ' bytes') END AS e1,
           CASE WHEN on_hash AND file_hash <> etag THEN
                concat('Checksum mismatch: expected ', file_hash, ', got ', etag) END AS e2 FROM j)
    SELECT file_path, stopped IS NULL AND e1 IS NULL AS file_size_match,
           stopped IS NULL AND e2 IS NULL AS checksum_match, stopped IS NULL AS record_count_match,
           record_count AS expected_records, concat_ws('; ', stopped,
               CASE WHEN stopped IS NULL THEN e1 END, CASE WHEN stopped IS NULL THEN e2 END) AS errors,
           stopped IS NULL AND e1 IS NULL AND e2 IS NULL AS is_valid
    FROM e
    """,
)
def validate_files(spark, folder):
    control = inputs.columns(spark, folder, "documents", CONTROL)
    files = inputs.columns(spark, folder, "documents", STORED)
    joined = validation.match_control(control, files.withColumn("mod_time", F.current_timestamp()))
    ruled = joined.withColumns(
        {
            "validate_file_size": F.lit(True),
            "validate_checksum": F.col("lang") != "en",
            "validate_record_count": F.lit(True),
        }
    )
    return validation.check_files(ruled).select(
        "file_path",
        "validation.file_size_match",
        "validation.checksum_match",
        "validation.record_count_match",
        "validation.expected_records",
        F.concat_ws("; ", "validation.validation_errors").alias("errors"),
        "is_valid",
    )


@query(
    "control_errors",
    f"""
    SELECT file_path, CASE WHEN file_name = '' THEN 'file_name is required in control data'
                WHEN file_size <= 0 THEN 'file_size must be positive'
                WHEN record_count < 0 THEN 'record_count cannot be negative'
                WHEN column_count <= 0 THEN 'column_count must be positive'
                WHEN file_hash = '' THEN 'file_hash is required'
                WHEN created_at IS NULL THEN 'created_at is required' END AS error
    FROM {inputs.select('documents', CONTROL)}
    """,
)
def control_errors(spark, folder):
    path = work_folder(spark, "control")
    inputs.columns(spark, folder, "documents", CONTROL).write.json(path)
    control = control_source.read_control(spark, path)
    return control.select("file_path", validation.control_error().alias("error"))


@query(
    "reconcile_counts",
    """
    WITH a AS (SELECT conv_id, count(*) AS actual FROM conversations GROUP BY conv_id),
    e AS (SELECT conv_id, actual, CASE WHEN conv_id % 7 = 0 THEN 0
                 WHEN conv_id % 5 = 1 THEN actual + 2 ELSE actual END AS expected FROM a)
    SELECT conv_id, expected AS expected_records, actual AS actual_records,
           expected = 0 OR expected = actual AS record_count_match,
           concat_ws('; ', CASE WHEN conv_id % 11 = 3 THEN 'late file' END,
               CASE WHEN expected > 0 AND expected <> actual THEN
                    concat('Record count mismatch: expected ', expected, ', got ', actual) END) AS errors
    FROM e
    """,
)
def reconcile_counts(spark, folder):
    counted = table(spark, folder, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("actual"))
    expected = F.expr(
        "CASE WHEN conv_id % 7 = 0 THEN 0 WHEN conv_id % 5 = 1 THEN actual + 2 ELSE actual END"
    )
    before = F.struct(
        F.lit(True).alias("record_count_match"),
        F.lit(True).alias("file_size_match"),
        F.lit(True).alias("checksum_match"),
        expected.cast("bigint").alias("expected_records"),
        F.lit(0).cast("bigint").alias("actual_records"),
        F.array().cast("array<string>").alias("validation_errors"),
    )
    late = F.when(F.col("conv_id") % 11 == 3, F.array(F.lit("late file")))
    checked = counted.withColumn("before", before).withColumn(
        "after", validation.reconcile(F.col("before"), F.col("actual"), late)
    )
    return checked.select(
        "conv_id",
        "after.expected_records",
        "after.actual_records",
        "after.record_count_match",
        F.concat_ws("; ", "after.validation_errors").alias("errors"),
    )


@query(
    "etag_text",
    "SELECT doc_id, md5(text) AS etag FROM documents",
)
def etag_text(spark, folder):
    quoted = F.concat(F.lit('"'), F.md5("text"), F.lit('"'))
    return table(spark, folder, "documents").select("doc_id", text.plain_etag(quoted).alias("etag"))


# --- history ------------------------------------------------------------------------------

# Events read as what happened to a file: a user is a file, a type of event is a step.
STEP_SQL = (
    "CASE event_type WHEN 'view' THEN 'VALIDATING' WHEN 'click' THEN 'VALIDATED' "
    "WHEN 'purchase' THEN 'PROCESSING' WHEN 'signup' THEN 'INITIATED' ELSE 'PROCESSED' END"
)

LOG = (
    "concat('s3://in/orders/', user_id, '.csv') AS file_path",
    "concat('job-', user_id % 5) AS job_id",
    "concat('run-', user_id) AS job_run_id",
    "event_id",
    "ts",
    "event_type",
    "props",
    f"CASE WHEN event_type = 'error' THEN 'error' ELSE 'transition' END AS kind",
    f"CASE WHEN event_type <> 'error' THEN {STEP_SQL} END AS to_state",
    "event_id % 50 <> 1 AS retryable",
)

LOG_SQL = inputs.select("events", LOG)


def log(spark, folder):
    """The events table as a tracking log. Times stay as they are; ids order them."""
    rows = inputs.columns(spark, folder, "events", LOG)
    return rows.withColumn("occurred_at", F.col("ts"))


MAX_RETRIES = 3


@query(
    "state_fold",
    f"""
    WITH l AS (SELECT * FROM {LOG_SQL}),
    r AS (SELECT *, count(*) FILTER (kind = 'error' AND retryable) OVER (
              PARTITION BY file_path, job_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM l),
    s AS (SELECT *, CASE WHEN kind = 'transition' THEN to_state
                 WHEN NOT retryable OR earlier >= {MAX_RETRIES} THEN 'FAILED' END AS state FROM r)
    SELECT file_path, job_id, arg_max(state, (ts, event_id)) FILTER (state IS NOT NULL) AS orchestration_state,
           count(*) FILTER (kind = 'error' AND retryable) AS retry_count,
           count(*) FILTER (kind = 'error') AS errors, count(*) FILTER (kind = 'transition') AS transitions,
           count(*) AS version,
           max(ts) FILTER (to_state = 'VALIDATED') AS validated_at,
           max(ts) FILTER (to_state = 'PROCESSING') AS processing_started,
           max(ts) FILTER (to_state = 'PROCESSED') AS processing_completed
    FROM s GROUP BY file_path, job_id
    """,
)
def state_fold(spark, folder):
    return tracking.fold(log(spark, folder), MAX_RETRIES).select(
        *tracking.KEY,
        "orchestration_state",
        "retry_count",
        "errors",
        "transitions",
        "version",
        "validated_at",
        "processing_started",
        "processing_completed",
    )


@query(
    "state_durations",
    f"""
    WITH l AS (SELECT * FROM {LOG_SQL} WHERE kind = 'transition'),
    p AS (SELECT *, lag(to_state) OVER w AS from_state, lag(ts) OVER w AS before FROM l
          WINDOW w AS (PARTITION BY file_path, job_id ORDER BY ts, event_id))
    SELECT file_path, job_id, event_id, coalesce(from_state, '') AS from_state, to_state,
           CAST(coalesce(datediff('microsecond', before, ts) // 1000, 0) AS BIGINT) AS duration_ms FROM p
    """,
)
def state_durations(spark, folder):
    return tracking.history(log(spark, folder)).drop("occurred_at")


STAGE_SQL = " ".join(f"WHEN '{state}' THEN '{label}'" for state, label in STAGE_TEXT.items())


@query(
    "stage_descriptions",
    f"""
    SELECT event_id, CASE state {STAGE_SQL} ELSE concat('State: ', state) END AS stage
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'odd' ELSE {STEP_SQL} END AS state FROM events)
    """,
)
def stage_descriptions(spark, folder):
    state = F.expr(f"CASE WHEN event_type = 'error' THEN 'odd' ELSE {STEP_SQL} END")
    return table(spark, folder, "events").select("event_id", values.stage_text(state).alias("stage"))


@query(
    "status_by_state",
    f"""
    WITH l AS (SELECT * FROM {LOG_SQL} WHERE kind = 'transition'),
    s AS (SELECT file_path, job_id, arg_max(to_state, (ts, event_id)) AS orchestration_state,
                 max(ts) FILTER (to_state = 'VALIDATED') AS validated_at FROM l GROUP BY ALL)
    SELECT * FROM s WHERE orchestration_state = 'PROCESSED'
    """,
)
def status_by_state(spark, folder):
    steps = log(spark, folder).filter("kind = 'transition'")
    records = tracking.fold(steps, MAX_RETRIES)
    return tracking.select_records(records, state="PROCESSED").select(
        *tracking.KEY, "orchestration_state", "validated_at"
    )


@query(
    "status_of_job",
    f"""
    SELECT file_path, job_id, count(*) AS version FROM {LOG_SQL} WHERE job_id = 'job-2' GROUP BY ALL
    """,
)
def status_of_job(spark, folder):
    records = tracking.fold(log(spark, folder), MAX_RETRIES)
    return tracking.select_records(records, job_id="job-2", newest_first=True).select(*tracking.KEY, "version")


@query(
    "previous_values",
    """
    WITH e AS (SELECT event_id, user_id, event_id % 2 = 0 AS hot, ts,
                      CASE WHEN event_id % 3 > 0 THEN value END AS value FROM events)
    SELECT event_id, lag(value) OVER (PARTITION BY CASE WHEN hot THEN -1 ELSE user_id END
                                      ORDER BY ts, event_id) AS previous FROM e
    """,
)
def previous_values(spark, folder):
    """The value before, which may be null, per user; half of all events are one user's."""
    events = table(spark, folder, "events").select(
        "event_id",
        F.expr("CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END").alias("user"),
        "ts",
        F.expr("CASE WHEN event_id % 3 > 0 THEN value END").alias("value"),
    )
    found = with_previous(events, ["user"], "ts", "value", "previous", ["event_id"], slices=8)
    return found.select("event_id", "previous")


@query(
    "previous_by_text",
    """
    SELECT event_id, lag(event_id) OVER (PARTITION BY CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END
                                         ORDER BY event_type, props NULLS FIRST, event_id) AS previous FROM events
    """,
)
def previous_by_text(spark, folder):
    """Half of all events are one user's, in the order of a text with five values."""
    events = table(spark, folder, "events").select(
        "event_id", F.expr("CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END").alias("user"), "event_type", "props"
    )
    found = with_previous(events, ["user"], "event_type", "event_id", "previous", ["props", "event_id"], slices=16)
    return found.select("event_id", "previous")


@query(
    "batch_summary",
    f"""
    WITH l AS (SELECT * FROM {LOG_SQL} WHERE kind = 'transition'),
    s AS (SELECT file_path, job_id, arg_max(to_state, (ts, event_id)) AS orchestration_state,
                 max(ts) FILTER (to_state = 'INITIATED') AS started,
                 max(ts) FILTER (to_state = 'PROCESSED') AS completed FROM l GROUP BY ALL)
    SELECT job_id, orchestration_state, count(*) AS files, min(started) AS first_started,
           max(completed) AS last_completed FROM s GROUP BY job_id, orchestration_state
    """,
)
def batch_summary(spark, folder):
    records = tracking.fold(log(spark, folder).filter("kind = 'transition'"), MAX_RETRIES)
    return tracking.batch_summary(records, by="job_id")


@query(
    "elapsed_times",
    f"""
    WITH s AS (SELECT file_path, job_id, max(ts) FILTER (to_state = 'VALIDATING') AS started,
                 max(ts) FILTER (to_state = 'PROCESSED') AS completed FROM {LOG_SQL} GROUP BY ALL)
    SELECT file_path, job_id, CAST(CASE WHEN completed >= started
               THEN datediff('microsecond', started, completed) // 1000000
               ELSE -(datediff('microsecond', completed, started) // 1000000) END AS BIGINT) AS elapsed_seconds FROM s
    """,
)
def elapsed_times(spark, folder):
    spans = (
        log(spark, folder)
        .groupBy(*tracking.KEY)
        .agg(
            F.max(F.when(F.col("to_state") == "VALIDATING", F.col("ts"))).alias("processing_initiated_at"),
            F.max(F.when(F.col("to_state") == "PROCESSED", F.col("ts"))).alias("processing_completed"),
        )
    )
    return tracking.elapsed(spans).select(*tracking.KEY, "elapsed_seconds")


@query(
    "newest_records",
    f"""
    SELECT file_path, job_id, event_id AS version, event_type, props FROM {LOG_SQL}
    QUALIFY row_number() OVER (PARTITION BY file_path, job_id ORDER BY event_id DESC) = 1
    """,
)
def newest_records(spark, folder):
    records = log(spark, folder).selectExpr(
        "file_path", "job_id", "event_id AS version", "event_type", "props"
    )
    return tracking.newest_versions(records)


@query(
    "stored_records",
    "SELECT concat('s3://in/', o_orderkey) AS file_path, 'job-1' AS job_id, 2 AS version, "
    "concat(o_orderpriority, '!') AS orchestration_state FROM orders",
)
def stored_records(spark, folder):
    path = work_folder(spark, "records")
    first = table(spark, folder, "orders").selectExpr(
        "concat('s3://in/', o_orderkey) AS file_path",
        "'job-1' AS job_id",
        "1 AS version",
        "o_orderpriority AS orchestration_state",
    )
    first.write.parquet(path)
    second = first.withColumn("version", F.lit(2)).withColumn(
        "orchestration_state", F.concat("orchestration_state", F.lit("!"))
    )
    second.write.mode("append").parquet(path)
    return tracking.newest_versions(spark.read.parquet(path))


@query(
    "expired_records",
    """
    SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) + 30 * 86400 AS expires_at FROM orders
    WHERE CAST(epoch(o_orderdate) AS BIGINT) + 30 * 86400 < 883612800
    """,
)
def expired_records(spark, folder):
    records = table(spark, folder, "orders").select(
        "o_orderkey", _epoch(F.col("o_orderdate"), 30).alias("expires_at")
    )
    return tracking.expired(records, F.lit(883_612_800))


def _epoch(at, days):
    """Expiry of a time without zone, read as UTC whatever the session zone is."""
    zoned = F.convert_timezone(F.lit("UTC"), F.current_timezone(), at)
    return values.expiry(zoned.cast("timestamp"), days)


CONTROLLED = (
    "concat('s3://in/orders/', o_orderstatus, '/', o_orderkey, '.csv') AS file_path",
    "CASE WHEN o_orderkey % 3 = 0 THEN concat('n', o_orderkey) WHEN o_orderkey % 3 = 1 THEN '' END AS file_name",
    "CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS file_size",
    "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS file_hash",
    "CASE WHEN o_orderkey % 2 = 0 THEN concat('batch_', o_orderstatus) END AS batch_id",
    "CASE WHEN o_orderkey % 4 = 0 THEN 'erp' ELSE '' END AS source_system",
    "o_orderdate",
)


@query(
    "initiated_records",
    f"""
    SELECT file_path, 'job-9' AS job_id,
           coalesce(nullif(file_name, ''), split_part(file_path, '/', 6)) AS file_name,
           coalesce(file_size, 0) AS file_size, coalesce(file_hash, '') AS file_hash,
           concat('orders/', split_part(file_path, '/', 5), '/') AS s3_prefix, 'ORDERS' AS target_table,
           'INITIATED' AS orchestration_state, 'File Processing Initiated' AS current_stage,
           CAST(0 AS INTEGER) AS retry_count, CAST(1 AS INTEGER) AS version,
           coalesce(nullif(batch_id, ''), concat('batch_', strftime(o_orderdate, '%Y%m%d'), '_',
               substr(sha256(concat('job-9|', file_path)), 1, 8))) AS batch_id,
           coalesce(nullif(source_system, ''), 'tidegate') AS source_system
    FROM {inputs.select('orders', CONTROLLED)}
    """,
)
def initiated_records(spark, folder):
    files = inputs.columns(spark, folder, "orders", CONTROLLED)
    records = tracking.initiate(files, MAPPINGS, "job-9", F.col("o_orderdate"), 30)
    return records.drop("processing_initiated_at", "expires_at", "processing_script", "route_error")


@query(
    "pending_control_records",
    f"""
    SELECT file_path, '' AS control_file_path, 'job-9' AS job_id, file_name, file_size, file_hash,
           record_count, column_count, 'PENDING' AS validation_status, 'PENDING' AS processing_status,
           '' AS error_message
    FROM {inputs.select('documents', CONTROL)}
    """,
)
def pending_control_records(spark, folder):
    control = inputs.columns(spark, folder, "documents", CONTROL)
    pending = tracking.control_record(control, "job-9", F.current_timestamp(), 30)
    return pending.drop("created_at", "processed_at", "validated_at", "expires_at")


@query(
    "snake_case_names",
    "SELECT l_orderkey AS job_run_id, l_partkey AS file_path, l_suppkey AS emr_job_details FROM lineitem",
)
def snake_case_names(spark, folder):
    return tracking.snake_case(
        table(spark, folder, "lineitem").selectExpr(
            "l_orderkey AS JobRunID", "l_partkey AS File_path", "l_suppkey AS EmrJobDetails"
        )
    )


@query(
    "job_labels",
    """
    SELECT o_orderkey, concat('job-', substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS job_id,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS started FROM orders
    """,
)
def job_labels(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        values.job_id(F.col("o_orderkey").cast("string")).alias("job_id"),
        F.left(values.rfc3339(F.col("o_orderdate")), F.lit(19)).alias("started"),
    )


# --- job events ---------------------------------------------------------------------------

OUTCOMES = (
    "concat('e', event_id) AS event_id",
    "ts AS event_time",
    "CASE WHEN event_id % 10 = 3 THEN concat('lost-', user_id) ELSE concat('run-', user_id) END AS job_run_id",
    "CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'click' THEN 'SUCCESS' "
    "WHEN 'error' THEN 'FAILED' ELSE 'CANCELLED' END AS state",
    "CASE WHEN event_id % 2 = 0 THEN props END AS state_details",
)


def run_records(spark, folder):
    """One record per customer; runs of other names are unknown."""
    return table(spark, folder, "customer").selectExpr(
        "concat('s3://in/', c_name) AS file_path",
        "concat('job-', c_custkey) AS job_id",
        "concat('run-', c_custkey) AS job_run_id",
    )


OUTCOME_LOG_SQL = f"""
    WITH e AS (SELECT * FROM {inputs.select('events', OUTCOMES)} WHERE state <> 'RUNNING'),
    r AS (SELECT concat('s3://in/', c_name) AS file_path, concat('job-', c_custkey) AS job_id,
                 concat('run-', c_custkey) AS job_run_id FROM customer),
    j AS (SELECT * FROM e JOIN r USING (job_run_id))
    SELECT file_path, job_id, event_id, 'transition' AS kind,
           CASE state WHEN 'SUCCESS' THEN 'PROCESSED' ELSE 'FAILED' END AS to_state,
           CAST(NULL AS VARCHAR) AS error_message, CAST(NULL AS BOOLEAN) AS retryable, job_run_id FROM j
    UNION ALL
    SELECT file_path, job_id, event_id, 'error', NULL,
           concat('EMR job failed with state: ', state,
                  CASE WHEN state_details IS NOT NULL THEN concat(', details: ', state_details) ELSE '' END),
           true, NULL FROM j WHERE state <> 'SUCCESS'
"""


@query("apply_job_events", OUTCOME_LOG_SQL)
def apply_job_events(spark, folder):
    events = inputs.columns(spark, folder, "events", OUTCOMES)
    outcomes = tracking.job_outcomes(events, run_records(spark, folder))
    # Every event came twice; the log keeps one.
    written = tracking.outcome_log(outcomes)
    return tracking.once(written.unionByName(written)).select(
        *tracking.KEY, "event_id", "kind", "to_state", "error_message", "retryable", "job_run_id"
    )


@query(
    "unknown_job_events",
    f"""
    SELECT event_id, job_run_id, state FROM {inputs.select('events', OUTCOMES)}
    WHERE state <> 'RUNNING' AND job_run_id NOT IN
          (SELECT concat('run-', c_custkey) FROM customer)
    """,
)
def unknown_job_events(spark, folder):
    events = inputs.columns(spark, folder, "events", OUTCOMES)
    outcomes = tracking.job_outcomes(events, run_records(spark, folder))
    return tracking.unknown_runs(outcomes).select("event_id", "job_run_id", "state")


@query(
    "job_event_scan",
    f"SELECT event_id, job_run_id, state, state_details, event_time FROM {inputs.select('events', OUTCOMES)}",
)
def job_event_scan(spark, folder):
    path = work_folder(spark, "envelopes")
    as_envelopes(inputs.columns(spark, folder, "events", OUTCOMES)).write.json(path)
    return control_source.read_job_events(spark, path).select(
        "event_id", "job_run_id", "state", "state_details", F.col("event_time").cast("timestamp_ntz")
    )


@query(
    "run_lookup",
    "SELECT concat('s3://in/', c_name) AS file_path, concat('run-', c_custkey) AS job_run_id, "
    "count(*) AS events FROM customer JOIN events ON user_id = c_custkey WHERE event_id % 10 <> 3 GROUP BY ALL",
)
def run_lookup(spark, folder):
    events = inputs.columns(spark, folder, "events", OUTCOMES)
    return (
        run_records(spark, folder)
        .join(events, "job_run_id")
        .groupBy("file_path", "job_run_id")
        .agg(F.count(F.lit(1)).alias("events"))
    )
