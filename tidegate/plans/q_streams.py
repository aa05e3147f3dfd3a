"""Queries that run a stream over the given tables and read what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidegate.functions import paths
from tidegate.operators import tables, tracking
from tidegate.options import Config, Mapping, Rules
from tidegate.plans import inputs
from tidegate.plans.batch import BatchOptions, decide, decision_log, report, run_batch
from tidegate.plans.q_tracking import CONTROL, OUTCOME_LOG_SQL, OUTCOMES, STORED, run_records
from tidegate.plans.registry import query, table
from tidegate.session import work_folder
from tidegate.sinks import files as sink
from tidegate.sources import control as control_source
from tidegate.sources import inventory
from tidegate.streaming import arrivals, lifecycles, streams
from tidegate.streaming.envelopes import as_envelopes


def stream_table(spark, folder, name):
    """A given table as a stream. A pattern may stand for one file as well as for a folder."""
    return spark.readStream.schema(table(spark, folder, name).schema).parquet(f"{folder}/{name}.parque[t]")


def finish(running):
    """Wait for a stream that takes all there is and stops; failures are raised."""
    running.awaitTermination()


@query(
    "stream_hourly_events",
    "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL",
)
def stream_hourly_events(spark, folder):
    path = work_folder(spark, "hours")
    finish(streams.put_hourly_counts(stream_table(spark, folder, "events"), path, work_folder(spark, "at")))
    newest = streams.newest_windows(spark, path)
    return newest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_append", "SELECT * FROM events")
def stream_append(spark, folder):
    path = work_folder(spark, "appended")
    finish(streams.append_to_path(stream_table(spark, folder, "events"), path, work_folder(spark, "at")))
    return spark.read.parquet(path)


@query("stream_append_table", "SELECT o_orderkey, o_totalprice FROM orders")
def stream_append_table(spark, folder):
    name = f"orders_{uuid.uuid4().hex}"
    orders = stream_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    finish(streams.append_to_table(orders, name, work_folder(spark, "table"), work_folder(spark, "at")))
    return spark.table(name)


@query(
    "stream_decoded_messages",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def stream_decoded_messages(spark, folder):
    message = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    messages = stream_table(spark, folder, "events").select(F.encode(message, "UTF-8").alias("value"))
    rows = streams.decoded(messages, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    path = work_folder(spark, "messages")
    finish(streams.put_batches(rows, path, work_folder(spark, "at")))
    return spark.read.parquet(path).drop("batch_id")


@query("stream_job_events", OUTCOME_LOG_SQL)
def stream_job_events(spark, folder):
    source = work_folder(spark, "envelopes")
    as_envelopes(inputs.columns(spark, folder, "events", OUTCOMES)).write.json(source)
    log, unknown = work_folder(spark, "log"), work_folder(spark, "unknown")
    finish(
        streams.apply_job_events(
            control_source.stream_job_events(spark, source),
            run_records(spark, folder),
            log,
            unknown,
            work_folder(spark, "at"),
        )
    )
    return tracking.read_log(spark, log).select(
        *tracking.KEY, "event_id", "kind", "to_state", "error_message", "retryable", "job_run_id"
    )


@query(
    "stream_changes",
    """
    WITH n AS (SELECT user_id, value, event_type FROM events
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
    SELECT coalesce(c_custkey, user_id) AS id, CASE WHEN user_id IS NULL THEN c_acctbal ELSE value END AS balance,
           CASE WHEN user_id IS NULL THEN c_mktsegment ELSE event_type END AS label
    FROM customer FULL JOIN n ON c_custkey = user_id
    """,
)
def stream_changes(spark, folder):
    changes = stream_table(spark, folder, "events").selectExpr(
        "user_id AS id", "value AS balance", "event_type AS label", "event_id AS version"
    )
    path = work_folder(spark, "changes")
    finish(streams.collect_changes(changes, path, work_folder(spark, "at")))
    base = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_acctbal AS balance", "c_mktsegment AS label"
    )
    return tables.current_rows(base, spark.read.parquet(path), ["id"], "version")


SOURCES = Config(
    (
        Mapping("src1", "ONES", rules=Rules(True, True, True)),
        Mapping("", "OTHER", rules=Rules(validate_file_size=True)),
    )
)

ARRIVALS_SQL = f"""
    WITH c AS (SELECT * FROM {inputs.select('documents', CONTROL)}),
    f AS (SELECT * FROM {inputs.select('documents', STORED)}),
    j AS (SELECT c.*, f.size, trim(f.etag, '"') AS etag,
                 starts_with(c.file_path, 's3://in/src1') AS ones
          FROM c LEFT JOIN f ON c.file_path = f.file_path),
    e AS (SELECT *, CASE WHEN size IS NULL THEN 'object not found' END AS gone,
          CASE WHEN file_name = '' THEN 'file_name is required in control data'
               WHEN file_size <= 0 THEN 'file_size must be positive'
               WHEN record_count < 0 THEN 'record_count cannot be negative'
               WHEN column_count <= 0 THEN 'column_count must be positive'
               WHEN ones AND file_hash = '' THEN 'file_hash is required'
               WHEN created_at IS NULL THEN 'created_at is required' END AS bad FROM j),
    r AS (SELECT *, CASE WHEN bad IS NULL AND gone IS NULL AND file_size <> size THEN
               concat('File size mismatch: expected ', file_size, ' bytes, got ', size, ' bytes') END AS e1,
          CASE WHEN bad IS NULL AND gone IS NULL AND ones AND file_hash <> etag THEN
               concat('Checksum mismatch: expected ', file_hash, ', got ', etag) END AS e2 FROM e)
    SELECT file_path, CASE WHEN ones THEN 'ONES' ELSE 'OTHER' END AS target_name,
           concat_ws('; ', gone, bad, e1, e2) AS errors,
           CASE WHEN concat_ws('; ', gone, bad, e1, e2) = '' THEN 'validated' ELSE 'reject' END AS action
    FROM r
"""


def _shown(decisions):
    return decisions.select("file_path", "target_name", F.concat_ws("; ", "errors").alias("errors"), "action")


@query("stream_arrivals", ARRIVALS_SQL)
def stream_arrivals(spark, folder):
    source = work_folder(spark, "control")
    inputs.columns(spark, folder, "documents", CONTROL).write.json(source)
    log = work_folder(spark, "decided")
    finish(
        arrivals.on_arrival(
            arrivals.stream_control(spark, source),
            lambda: inputs.columns(spark, folder, "documents", STORED),
            SOURCES,
            work_folder(spark, "out"),
            log,
            work_folder(spark, "at"),
            BatchOptions(validate_only=True),
        )
    )
    return _shown(spark.read.parquet(log))


#: Rows of a file of announcements; a batch takes as many files as the table needs.
ANNOUNCED_ROWS = 200_000


@query("stream_announced_once", f"SELECT *, 1 AS times FROM ({ARRIVALS_SQL})")
def stream_announced_once(spark, folder):
    """Every file is announced in three batches; the state store lets the first through."""
    source = work_folder(spark, "announced")
    control = inputs.columns(spark, folder, "documents", CONTROL)
    files = inputs.pieces(control, ANNOUNCED_ROWS)
    for _ in range(3):
        inputs.spread(control, files).write.mode("append").json(source)
    log = work_folder(spark, "decided")
    finish(
        arrivals.on_arrival(
            arrivals.stream_announcements(spark, source, "1 hour", files_per_batch=files),
            lambda: inputs.columns(spark, folder, "documents", STORED),
            SOURCES,
            work_folder(spark, "out"),
            log,
            work_folder(spark, "at"),
            BatchOptions(validate_only=True),
            seen_path=work_folder(spark, "seen"),
        )
    )
    shown = _shown(spark.read.parquet(log))
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).cast("int").alias("times"))


@query(
    "batch_decisions",
    f"""
    SELECT * FROM ({ARRIVALS_SQL})
    UNION ALL SELECT file_path, CASE WHEN starts_with(file_path, 's3://in/src1') THEN 'ONES' ELSE 'OTHER' END, '',
           'validated'
    FROM {inputs.select('documents', STORED)} WHERE file_path LIKE '%.part'
    """,
)
def batch_decisions(spark, folder):
    control = inputs.columns(spark, folder, "documents", CONTROL)
    files = inputs.columns(spark, folder, "documents", STORED)
    return _shown(decide(files, control, SOURCES, BatchOptions(validate_only=True)))


@query(
    "batch_summary_report",
    f"""
    SELECT 'job-7' AS job_id,
           CASE action WHEN 'reject' THEN 'FAILED' ELSE 'VALIDATED' END AS orchestration_state,
           count(*) AS files, CAST(0 AS BIGINT) AS retries FROM ({ARRIVALS_SQL}) GROUP BY ALL
    """,
)
def batch_summary_report(spark, folder):
    control = inputs.columns(spark, folder, "documents", CONTROL)
    files = inputs.columns(spark, folder, "documents", STORED).join(control, "file_path", "left_semi")
    decisions = decide(files, control, SOURCES, BatchOptions(validate_only=True))
    return report(tracking.fold(decision_log(decisions, "job-7"), 3))


@query(
    "batch_course",
    f"""
    SELECT 'CUSTOMERS' AS target_name, count(*) AS counted_records,
           count(*) FILTER (customer_id IS NOT NULL AND email IS NOT NULL) AS written_records
    FROM {inputs.select('customer', inputs.CUSTOMERS)}
    UNION ALL SELECT 'ORDERS', count(*), count(*) FROM {inputs.select('orders', inputs.ORDERS)}
    """,
)
def batch_course(spark, folder):
    landed = work_folder(spark, "landed")
    for name, domain, expressions in (
        ("customer", "customers", inputs.CUSTOMERS),
        ("orders", "orders", inputs.ORDERS),
        ("part", "elsewhere", inputs.PRODUCTS),
    ):
        sink.write(inputs.columns(spark, folder, name, expressions), f"{landed}/{domain}", "CSV", "gzip")
    files = inventory.list_files(spark, landed).select(
        F.col("path").alias("file_path"), "size", F.lit(None).cast("string").alias("etag")
    )
    prefix = f"{_key(spark, files, landed.rsplit('/', 1)[1])}/"
    checked = Rules(validate_record_count=True)
    config = Config(
        (
            Mapping(f"{prefix}customers/", "CUSTOMERS", rules=checked),
            Mapping(f"{prefix}orders/", "ORDERS", "convert", rules=checked),
        )
    )
    out, log = work_folder(spark, "out"), work_folder(spark, "log")
    run_batch(spark, files, None, config, out, log, "job-5")
    counted = (
        spark.read.parquet(f"{log}/counted-job-5")
        .groupBy("target_name")
        .agg(F.sum("actual_records").alias("counted_records"))
    )
    target = F.regexp_extract(inventory.FILE_PATH, "/processed/([^/]*)/", 1)
    written = (
        spark.read.option("recursiveFileLookup", "true")
        .schema("_job_id STRING")
        .parquet(f"{out}/processed")
        .groupBy(target.alias("target_name"))
        .agg(F.count(F.lit(1)).alias("written_records"))
    )
    return counted.join(written, "target_name")


SHARED_SQL = f"""
    SELECT customer_id, email, CAST(part AS INTEGER) AS part FROM (
        SELECT *, customer_id % 2 AS part FROM {inputs.select('customer', inputs.CUSTOMERS)}
    ) WHERE customer_id IS NOT NULL AND email IS NOT NULL
"""


def _shared_target(spark, folder, runs):
    """Customers of even and odd numbers below two prefixes that feed one target; each of ``runs``
    names the jobs, and the prefixes that it finds files below."""
    landed = work_folder(spark, "landed")
    customers = inputs.columns(spark, folder, "customer", inputs.CUSTOMERS)
    for part, name in enumerate(("even", "odd")):
        rows = customers.filter(F.col("customer_id") % 2 == part)
        sink.write(rows, f"{landed}/{name}", "CSV", "gzip")
    out, log = work_folder(spark, "out"), work_folder(spark, "log")
    for job, names in runs:
        listed = [inventory.list_files(spark, f"{landed}/{n}") for n in names]
        files = listed[0] if len(listed) == 1 else listed[0].union(listed[1])
        files = files.select(F.col("path").alias("file_path"), "size", F.lit(None).cast("string").alias("etag"))
        key = f"{_key(spark, files, landed.rsplit('/', 1)[1])}/"
        config = Config(tuple(Mapping(f"{key}{n}/", "CUSTOMERS") for n in ("even", "odd")))
        run_batch(spark, files, None, config, out, log, job)
    written = spark.read.parquet(f"{out}/processed/CUSTOMERS")
    return written.select(
        F.col("CUSTOMER_ID").cast("bigint").alias("customer_id"),
        F.col("EMAIL_ADDRESS").alias("email"),
        F.col("ingest_position").cast("int").alias("part"),
    )


@query("batch_shared_target", SHARED_SQL)
def batch_shared_target(spark, folder):
    return _shared_target(spark, folder, [("job-1", ("even", "odd"))])


@query("batch_two_runs", SHARED_SQL)
def batch_two_runs(spark, folder):
    return _shared_target(
        spark, folder, [("job-1", ("even",)), ("job-2", ("odd",)), ("job-2", ("odd",))]
    )


@query("batch_rerun_fewer_files", f"SELECT * FROM ({SHARED_SQL}) WHERE part = 0")
def batch_rerun_fewer_files(spark, folder):
    """A job that runs again without the files of one prefix; what it made of them goes."""
    return _shared_target(spark, folder, [("job-1", ("even", "odd")), ("job-1", ("even",))])


@query(
    "batch_repeated_control",
    f"""
    SELECT file_path, target_name, errors, action FROM ({ARRIVALS_SQL})
    UNION ALL SELECT file_path, CASE WHEN starts_with(file_path, 's3://in/src1') THEN 'ONES' ELSE 'OTHER' END, '',
           'validated'
    FROM {inputs.select('documents', STORED)} WHERE file_path LIKE '%.part'
    """,
)
def batch_repeated_control(spark, folder):
    """As batch_decisions, with each control record delivered three times and each file listed twice."""
    control = inputs.columns(spark, folder, "documents", CONTROL)
    files = inputs.columns(spark, folder, "documents", STORED)
    decided = decide(
        files.union(files), control.union(control).union(control), SOURCES, BatchOptions(validate_only=True)
    )
    return _shown(decided)


@query(
    "stream_hourly_late_events",
    "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL",
)
def stream_hourly_late_events(spark, folder):
    """Events in files of falling time, one file a batch: older ones come later and still count."""
    events, landed = table(spark, folder, "events"), work_folder(spark, "falling")
    bounds = events.agg(F.percentile_approx("event_id", [0.75, 0.5, 0.25])).first()[0]
    high = None
    for low in [*sorted(bounds, reverse=True), None]:
        part = events.filter(F.lit(True) if low is None else F.col("event_id") > low)
        part = part if high is None else part.filter(F.col("event_id") <= high)
        part.coalesce(1).write.mode("append").parquet(landed)
        high = low
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    path = work_folder(spark, "hours")
    finish(streams.put_hourly_counts(stream, path, work_folder(spark, "at")))
    newest = streams.newest_windows(spark, path)
    return newest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _key(spark, files, folder_name):
    """Key of a folder, as it is written in the paths of a listing."""
    any_file = files.select(paths.key(F.col("file_path"))).first()[0]
    return any_file.split(folder_name)[0] + folder_name


LIVES = lifecycles.Lives(retries=3, wait_seconds=7200, live_seconds=3 * 86_400, late="6 hours")
LIFE_EVENTS = (
    "concat('s3://in/', user_id) AS file_path",
    "concat('job-', user_id % 7) AS job_id",
    "concat('e', event_id) AS event_id",
    "ts AS occurred_at",
    "CASE WHEN event_type IN ('view', 'purchase') THEN 'transition' ELSE 'error' END AS kind",
    "CASE event_type WHEN 'view' THEN 'PROCESSING' WHEN 'purchase' THEN 'PROCESSED' END AS to_state",
    "CASE WHEN event_type IN ('click', 'signup') THEN true "
    "WHEN event_type = 'error' THEN event_id % 2 = 0 END AS retryable",
)
LIVES_SQL = f"""
    WITH RECURSIVE l AS (
        SELECT *, CASE WHEN kind = 'error' AND retryable THEN 'again' WHEN kind = 'error' THEN 'fatal'
                       WHEN to_state = 'PROCESSED' THEN 'done' END AS effect
        FROM {inputs.select('events', LIFE_EVENTS)}),
    lives AS (
        SELECT file_path, job_id, min(occurred_at) AS began FROM l GROUP BY ALL
        UNION ALL
        SELECT v.file_path, v.job_id, min(l.occurred_at) FROM lives v
        JOIN l ON l.file_path = v.file_path AND l.job_id = v.job_id AND l.occurred_at >= v.began + INTERVAL 3 DAY
        GROUP BY v.file_path, v.job_id),
    o AS (
        SELECT l.*, v.began, count(*) FILTER (effect = 'again') OVER w AS n, lead(occurred_at) OVER w AS following
        FROM l JOIN lives v ON l.file_path = v.file_path AND l.job_id = v.job_id
             AND l.occurred_at >= v.began AND l.occurred_at < v.began + INTERVAL 3 DAY
        WHERE effect IS NOT NULL
        WINDOW w AS (PARTITION BY l.file_path, l.job_id, v.began ORDER BY occurred_at, event_id)),
    c AS (SELECT *, effect <> 'again' OR n > 3 AS closes,
                 occurred_at + INTERVAL 2 HOUR * CAST(2 ** (n - 1) AS INT) AS due FROM o),
    k AS (SELECT * FROM c QUALIFY coalesce(count(*) FILTER (closes) OVER (
              PARTITION BY file_path, job_id, began ORDER BY occurred_at, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0),
    d AS (
        SELECT file_path, job_id, CASE effect WHEN 'done' THEN 'DONE' ELSE 'GIVE_UP' END AS decision,
               occurred_at AS decided_at, n AS attempt FROM k WHERE closes
        UNION ALL
        SELECT file_path, job_id, 'RETRY', due, n FROM k
        WHERE NOT closes AND due < began + INTERVAL 3 DAY AND (following IS NULL OR following > due)
        UNION ALL
        SELECT v.file_path, v.job_id, 'EXPIRE', v.began + INTERVAL 3 DAY, count(k.n) FROM lives v
        LEFT JOIN k ON k.file_path = v.file_path AND k.job_id = v.job_id AND k.began = v.began
        GROUP BY v.file_path, v.job_id, v.began HAVING NOT coalesce(bool_or(k.closes), false))
    SELECT file_path, job_id, decision, decided_at, CAST(attempt AS INT) AS attempt FROM d
    WHERE decided_at < (SELECT max(occurred_at) FROM l) - INTERVAL 6 HOUR - INTERVAL 1 SECOND
"""


@query("stream_file_lives", LIVES_SQL)
def stream_file_lives(spark, folder):
    """Events come in four files, each a batch, with keyed state and timers between them."""
    rows = inputs.columns(spark, folder, "events", LIFE_EVENTS)
    source = work_folder(spark, "life-events")
    first, last = table(spark, folder, "events").agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / 4
    for n in range(4):
        after = F.lit(True) if n == 0 else F.col("occurred_at") >= first + n * step
        before = F.lit(True) if n == 3 else F.col("occurred_at") < first + (n + 1) * step
        rows.where(after & before).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    path = work_folder(spark, "lives")
    finish(lifecycles.put_decisions(stream, path, work_folder(spark, "at"), LIVES))
    decided = spark.read.parquet(path).drop("batch_id")
    at = F.col("decided_at").cast("timestamp_ntz")
    # What is due after the last watermark is not decided when the stream stops.
    end = F.lit(last) - F.expr("INTERVAL 6 HOURS") - F.expr("INTERVAL 1 SECOND")
    return decided.withColumn("decided_at", at).where(F.col("decided_at") < end.cast("timestamp_ntz"))
