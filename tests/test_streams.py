"""Streams and whole batches over real files."""

import datetime as dt
import hashlib
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidegate.operators import tables, tracking
from tidegate.options import Config, Mapping, Processing, Rules, parse_config
from tidegate.plans import batch, jobs
from tidegate.sources import control as control_source
from tidegate.sources import inventory
from tidegate.streaming import arrivals, streams

EVENTS = "event_id BIGINT, ts TIMESTAMP, event_type STRING"


def put_json(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in rows)


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def event(i, minute, kind="click"):
    return {"event_id": i, "ts": f"2024-01-01T00:{minute:02}:00Z", "event_type": kind}


def test_hourly_counts_go_on_from_the_checkpoint(spark, tmp_path):
    source, out, at = (str(tmp_path / n) for n in ("in", "out", "at"))
    put_json(source, "1.json", [event(1, 0), event(2, 59), event(3, 5, "view")])
    stream = spark.readStream.schema(EVENTS).json(source)
    streams.put_hourly_counts(stream, out, at).awaitTermination()
    put_json(source, "2.json", [event(4, 30)])
    streams.put_hourly_counts(stream, out, at).awaitTermination()
    got = {r.event_type: r.events for r in streams.newest_windows(spark, out).collect()}
    assert got == {"click": 3, "view": 1}


def test_append_reads_each_file_once(spark, tmp_path):
    source, out, at = (str(tmp_path / n) for n in ("in", "out", "at"))
    stream = spark.readStream.schema(EVENTS)
    for n in (1, 2):
        put_json(source, f"{n}.json", [event(n, 0)])
        streams.append_to_path(stream.json(source), out, at).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_registered_source_and_broken_messages(spark, tmp_path):
    assert streams.stream_registered(spark, "rate", rowsPerSecond="1").isStreaming
    df = spark.createDataFrame([(b'{"a": 1}',), (b"broken",)], "value BINARY")
    assert [r.a for r in streams.decoded(df, "a INT").collect()] == [1, None]


def envelope(i, run, state):
    return {"id": f"e{i}", "time": "2024-01-01T00:00:00Z", "detail": {"jobRunId": run, "state": state}}


def test_job_events_are_applied_once(spark, tmp_path):
    source, log, unknown, at = (str(tmp_path / n) for n in ("in", "log", "unknown", "at"))
    records = spark.createDataFrame([("f1", "j1", "r1"), ("f2", "j2", "r2")], "file_path STRING, job_id STRING, job_run_id STRING")
    put_json(source, "1.json", [envelope(1, "r1", "RUNNING"), envelope(2, "r1", "SUCCESS")])
    events = control_source.stream_job_events(spark, source)
    streams.apply_job_events(events, records, log, unknown, at).awaitTermination()
    put_json(source, "2.json", [envelope(2, "r1", "SUCCESS"), envelope(3, "r2", "CANCELLED"), envelope(4, "r3", "FAILED")])
    streams.apply_job_events(events, records, log, unknown, at).awaitTermination()
    kept = tracking.once(spark.read.parquet(log))
    got = sorted((r.file_path, r.kind, r.to_state) for r in kept.collect())
    assert got == [("f1", "transition", "PROCESSED"), ("f2", "error", None), ("f2", "transition", "FAILED")]
    assert [r.event_id for r in spark.read.parquet(unknown).collect()] == ["e4"]


def test_changes_follow_a_stream(spark, tmp_path):
    source, path, at = (str(tmp_path / n) for n in ("in", "changes", "at"))
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    put_json(source, "1.json", [{"k": 2, "v": "x", "n": 1}])
    changes = spark.readStream.schema("k INT, v STRING, n INT").json(source)
    streams.collect_changes(changes, path, at).awaitTermination()
    put_json(source, "2.json", [{"k": 2, "v": "y", "n": 2}, {"k": 3, "v": "z", "n": 3}])
    streams.collect_changes(changes, path, at).awaitTermination()
    now = tables.current_rows(base, spark.read.parquet(path), ["k"], "n")
    assert sorted(tuple(r) for r in now.collect()) == [(1, "a"), (2, "y"), (3, "z")]


# --- files from arrival to table ------------------------------------------------------------

CUSTOMERS = "customer_id,name,email,phone\n1,Ann  Field,Ann@Example.com,555-0101\n2,Bo,,1\n3,Cy,cy@x,2\n"
ORDERS = "order_id,customer_id,order_date,amount\n1,1,2024-01-01,5.5\n2,1,2024-01-02,-1\n"


@pytest.fixture
def landing(spark, tmp_path):
    """Files under mapped and unmapped prefixes, their control records and a configuration."""
    contents = {
        "customers/a.csv": CUSTOMERS,
        "customers/b.csv": CUSTOMERS,
        "orders/o.csv": ORDERS,
        "other/x.csv": "a\n1\n",
    }
    root = tmp_path / "in"
    rows = []
    for name, body in contents.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
        rows.append(
            {
                "file_path": f"file://{path}",
                "file_name": path.name,
                "file_size": len(body) + (name == "customers/b.csv"),
                "file_hash": (hashlib.md5 if name < "d" else hashlib.sha256)(body.encode()).hexdigest(),
                "record_count": body.count("\n") - 1 + (name == "orders/o.csv"),
                "column_count": 4,
                "created_at": "2024-01-01T00:00:00Z",
            }
        )
    put_json(str(tmp_path / "control"), "1.json", rows)
    prefix = str(root).lstrip("/")  # what follows "file:/" in the paths of a listing
    config = parse_config(
        json.dumps(
            {
                "max_retries": 2,
                "prefix_mappings": [
                    {
                        "s3_prefix": f"{prefix}/customers/",
                        "target_name": "CUSTOMERS",
                        "validation_rules": {
                            "validate_file_size": True,
                            "validate_checksum": True,
                            "validate_record_count": True,
                        },
                    },
                    {
                        "s3_prefix": f"{prefix}/orders/",
                        "target_name": "ORDERS",
                        "entry_point": "convert",
                        "script_params": {"partition-by": "order_date"},
                        "validation_rules": {"validate_record_count": True, "validate_checksum": True},
                    },
                ],
            }
        )
    )
    return str(root), str(tmp_path / "control"), config


def listed(spark, root):
    """Files with their digests."""
    return inventory.digests(spark, root).withColumnRenamed("path", "file_path")


def run(spark, landing, tmp_path, options=batch.BatchOptions()):
    root, control, config = landing
    records = batch.run_batch(
        spark,
        listed(spark, root),
        control_source.read_control(spark, control),
        config,
        str(tmp_path / "out"),
        str(tmp_path / "log"),
        "job-1",
        options,
    )
    return {r.file_path.split("/in/")[1]: r for r in records.collect()}, records


def test_batch_processes_good_files_and_rejects_the_rest(spark, landing, tmp_path):
    records, _ = run(spark, landing, tmp_path)
    assert {n: r.orchestration_state for n, r in records.items()} == {
        "customers/a.csv": "PROCESSED",
        "customers/b.csv": "FAILED",
        "orders/o.csv": "PROCESSED",
        "other/x.csv": "FAILED",
    }
    written = spark.read.parquet(str(tmp_path / "out" / "processed" / "CUSTOMERS"))
    assert sorted(r.CUSTOMER_NAME for r in written.collect()) == ["Ann Field", "Cy"]
    orders = spark.read.parquet(str(tmp_path / "out" / "processed" / "ORDERS"))
    assert orders.count() == 2 and "order_date" in orders.columns
    log = spark.read.parquet(str(tmp_path / "log" / "log"))
    messages = {r.file_path.split("/in/")[1]: r.error_message for r in log.filter("kind = 'error'").collect()}
    assert messages["customers/b.csv"].startswith("File size mismatch: expected")
    assert messages["other/x.csv"].startswith("no prefix mapping found for key: ")
    counted = spark.read.parquet(str(tmp_path / "log" / "counted-job-1"))
    counts = {r.file_path.split("/in/")[1]: r for r in counted.collect()}
    assert set(counts) == {"customers/a.csv", "orders/o.csv"}
    assert counts["customers/a.csv"].record_count_match and counts["customers/a.csv"].actual_records == 3
    assert counts["orders/o.csv"].validation_errors == ["Record count mismatch: expected 3, got 2"]


def test_prefixes_and_batches_add_up_in_a_target(spark, tmp_path):
    for name in ("a", "b", "c"):
        put(tmp_path, f"in/{name}/x.csv", f"station_id,label\n1,{name}\n2,{name}\n")
    prefix = str(tmp_path / "in").lstrip("/")
    config = Config(tuple(Mapping(f"{prefix}/{n}/", "STATIONS") for n in ("a", "b", "c")))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")

    def go(job, *names):
        files = [inventory.list_files(spark, str(tmp_path / "in" / n)) for n in names]
        rows = files[0] if len(files) == 1 else files[0].union(files[1])
        rows = rows.withColumnRenamed("path", "file_path")
        records = batch.run_batch(spark, rows, None, config, out, log, job).collect()
        assert {r.job_id for r in records} == {job}
        return len(records)

    def labels():
        return sorted(r.label for r in spark.read.parquet(f"{out}/processed/STATIONS").collect())

    assert go("one", "a", "b") == 2 and labels() == ["a", "a", "b", "b"]
    assert go("two: c/d", "c") == 1 and labels() == ["a", "a", "b", "b", "c", "c"]
    assert go("two: c/d", "c") == 1 and labels() == ["a", "a", "b", "b", "c", "c"]


def test_repeated_control_records_and_listings_are_one(spark, landing, tmp_path):
    root, control, config = landing
    records = control_source.read_control(spark, control)
    files = listed(spark, root)
    batch.run_batch(
        spark, files.union(files), records.union(records), config, str(tmp_path / "out"), str(tmp_path / "log"), "j"
    )
    assert spark.read.parquet(str(tmp_path / "out" / "processed" / "CUSTOMERS")).count() == 2
    counted = {r.file_path.split("/in/")[1]: r for r in spark.read.parquet(str(tmp_path / "log" / "counted-j")).collect()}
    assert counted["customers/a.csv"].actual_records == 3


def test_many_files_are_taken_in_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "FILES_PER_RUN", 2)
    for i in range(5):
        put(tmp_path, f"in/{i}.csv", f"station_id,label\n{i},x\n")
    prefix = str(tmp_path / "in").lstrip("/")
    rules = Rules(validate_record_count=True)
    config = Config((Mapping(f"{prefix}/", "S", rules=rules, params={"schema": "station_id BIGINT, label STRING"}),))
    files = inventory.list_files(spark, str(tmp_path / "in")).withColumnRenamed("path", "file_path")
    records = batch.run_batch(spark, files, None, config, str(tmp_path / "out"), str(tmp_path / "log"), "j")
    assert {r.orchestration_state for r in records.collect()} == {"PROCESSED"}
    written = spark.read.parquet(str(tmp_path / "out" / "processed" / "S"))
    assert sorted((r.station_id, r.ingest_run) for r in written.collect()) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]
    assert dict(written.dtypes)["station_id"] == "bigint"
    counted = spark.read.parquet(str(tmp_path / "log" / "counted-j"))
    assert sorted(r.actual_records for r in counted.collect()) == [1] * 5


@pytest.mark.parametrize("per_run", [1, 10])
def test_a_job_again_with_fewer_files(spark, tmp_path, monkeypatch, per_run):
    """However many runs a job takes, what it made of files that are gone goes as well."""
    monkeypatch.setattr(batch, "FILES_PER_RUN", per_run)
    for i in range(3):
        put(tmp_path, f"in/{i}.csv", f"station_id,label\n{i},x\n")
    prefix = str(tmp_path / "in").lstrip("/")
    rules = Rules(validate_record_count=True)
    config = Config((Mapping(f"{prefix}/", "S", rules=rules, params={"schema": "station_id BIGINT, label STRING"}),))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    files = inventory.list_files(spark, str(tmp_path / "in")).withColumnRenamed("path", "file_path")
    for kept in ((0, 1, 2), (0, 2), (1,)):
        some = files.where(F.regexp_extract("file_path", "([0-9])[.]csv", 1).cast("int").isin(*kept))
        batch.run_batch(spark, some, None, config, out, log, "j")
        written = spark.read.parquet(f"{out}/processed/S")
        assert sorted(r.station_id for r in written.collect()) == list(kept)
        counted = spark.read.parquet(f"{log}/counted-j")
        assert counted.count() == len(kept)
    batch.run_batch(spark, files.where("1 = 0"), None, config, out, log, "j")
    assert not os.path.exists(f"{out}/processed/S/ingest_job=j/ingest_position=0")


def test_nothing_is_readable_of_files_that_failed(spark, tmp_path, monkeypatch):
    """Runs that went well go too when a later one fails for good."""
    monkeypatch.setattr(batch, "FILES_PER_RUN", 1)
    for i in range(3):
        put(tmp_path, f"in/{i}.csv", f"station_id,label\n{i},x\n")
    before = batch.process_target

    def broken(spark, mapping, paths, output_root, job_id, position=0, run=0):
        if run == 2:
            raise RuntimeError("no luck")
        return before(spark, mapping, paths, output_root, job_id, position, run)

    monkeypatch.setattr(batch, "process_target", broken)
    prefix = str(tmp_path / "in").lstrip("/")
    config = Config((Mapping(f"{prefix}/", "S", params={"schema": "station_id BIGINT, label STRING"}),), max_retries=1)
    files = inventory.list_files(spark, str(tmp_path / "in")).withColumnRenamed("path", "file_path")
    out = str(tmp_path / "out")
    records = batch.run_batch(spark, files, None, config, out, str(tmp_path / "log"), "j").collect()
    assert {r.orchestration_state for r in records} == {"FAILED"}
    assert not os.path.exists(f"{out}/processed/S/ingest_job=j/ingest_position=0")


def test_failure_while_counting_is_logged(spark, landing, tmp_path, monkeypatch):
    def broken(*args):
        raise RuntimeError("cannot count")

    monkeypatch.setattr(batch, "reconcile_files", broken)
    records, _ = run(spark, landing, tmp_path)
    assert records["customers/a.csv"].orchestration_state == "FAILED"


def test_compression_of_a_mapping(spark, tmp_path):
    put(tmp_path, "c.csv", "station_id,label\n1,x\n")
    for given, name in (("GZIP", "gz"), ("", "snappy")):
        mapping = Mapping("x/", "S", processing=Processing(compression_type=given))
        out = batch.process_target(spark, mapping, [str(tmp_path / "c.csv")], str(tmp_path / "out"), f"j{name}")
        assert any(name in f for f in os.listdir(out) if f.endswith(".parquet"))


def test_batch_without_checks_takes_all_mapped_files(spark, landing, tmp_path):
    records, _ = run(spark, landing, tmp_path, batch.BatchOptions(skip_validation=True))
    assert records["customers/b.csv"].orchestration_state == "PROCESSED"
    assert records["other/x.csv"].orchestration_state == "FAILED"


def test_batch_run_twice_changes_nothing(spark, landing, tmp_path):
    first, _ = run(spark, landing, tmp_path)
    second, _ = run(spark, landing, tmp_path)
    assert first == second


@pytest.mark.parametrize("go_on", [True, False])
def test_failing_job_is_retried_and_then_fails(spark, landing, tmp_path, monkeypatch, go_on):
    def broken(df, target, job_id, params):
        raise RuntimeError("no luck")

    monkeypatch.setitem(jobs.JOBS, "standard", broken)
    options = batch.BatchOptions(continue_on_error=go_on)
    if not go_on:
        with pytest.raises(RuntimeError, match="no luck"):
            run(spark, landing, tmp_path, options)
        return
    records, frame = run(spark, landing, tmp_path, options)
    failed = records["customers/a.csv"]
    assert (failed.orchestration_state, failed.retry_count) == ("FAILED", 3)
    assert records["orders/o.csv"].orchestration_state == "PROCESSED"
    summary = batch.report(frame).collect()
    assert {(r.orchestration_state, r.files, r.retries) for r in summary} == {("FAILED", 3, 3), ("PROCESSED", 1, 0)}


def test_wrong_settings_are_not_retried(spark, landing, tmp_path):
    root, control, config = landing
    first, second = config.mappings
    wrong = replace(first, processing=replace(first.processing, output_format="ICEBERG"))
    records, _ = run(spark, (root, control, replace(config, mappings=(wrong, second))), tmp_path)
    failed = records["customers/a.csv"]
    assert (failed.orchestration_state, failed.retry_count, failed.errors) == ("FAILED", 0, 1)
    assert records["orders/o.csv"].orchestration_state == "PROCESSED"


def test_missing_required_field_is_refused(spark, tmp_path):
    mapping = Mapping("x/", "CUSTOMERS", rules=Rules(required_fields=("customer_id", "signup_year")))
    path = tmp_path / "c.csv"
    path.write_text(CUSTOMERS)
    with pytest.raises(ValueError, match="CUSTOMERS: required fields missing: signup_year"):
        batch.process_target(spark, mapping, [str(path)], str(tmp_path / "out"), "j")


def test_late_events_count_unless_a_limit_is_given(spark, tmp_path):
    schema = "ts TIMESTAMP, event_type STRING"
    for i, hour in enumerate((9, 5, 1)):
        rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, hour), "a")] * 2, schema)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def counts(late, name):
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        path = str(tmp_path / name)
        query = streams.put_hourly_counts(events, path, str(tmp_path / f"{name}-at"), late)
        query.awaitTermination()
        return sum(r.events for r in streams.newest_windows(spark, path).collect()), streams.late_rows(query)

    assert counts(None, "all") == (6, 0)
    kept, dropped = counts("10 minutes", "some")
    assert kept < 6 and dropped > 0


def test_arrivals_are_processed_as_they_come(spark, landing, tmp_path):
    root, control, config = landing
    arrivals.on_arrival(
        arrivals.stream_control(spark, control),
        lambda: listed(spark, root),
        config,
        str(tmp_path / "out"),
        str(tmp_path / "log"),
        str(tmp_path / "at"),
    ).awaitTermination()
    log = tracking.once(spark.read.parquet(str(tmp_path / "log" / "log")))
    states = {r.file_path.split("/in/")[1]: r.orchestration_state for r in tracking.fold(log, 3).collect()}
    assert states["customers/a.csv"] == states["orders/o.csv"] == "PROCESSED"
    assert states["customers/b.csv"] == states["other/x.csv"] == "FAILED"
    assert spark.read.parquet(str(tmp_path / "out" / "batch=0" / "processed" / "CUSTOMERS")).count() == 2


def test_listing_shows_targets(spark, landing):
    root, _, config = landing
    rows = batch.listing(spark, root, config).collect()
    assert {os.path.basename(r.file_path) for r in rows} == {"a.csv", "b.csv", "o.csv", "x.csv"}
    assert all(r.size > 0 for r in rows)


def test_arrivals_are_decided_as_they_come(spark, landing, tmp_path):
    root, control, config = landing
    log = str(tmp_path / "decided")
    arrivals.on_arrival(
        arrivals.stream_control(spark, control),
        lambda: listed(spark, root),
        config,
        str(tmp_path / "out"),
        log,
        str(tmp_path / "at"),
        batch.BatchOptions(validate_only=True),
    ).awaitTermination()
    got = {r.file_path.split("/in/")[1]: r.action for r in spark.read.parquet(log).collect()}
    assert got == {
        "customers/a.csv": "validated",
        "customers/b.csv": "reject",
        "orders/o.csv": "validated",
        "other/x.csv": "reject",
    }


def test_work_folder_follows_the_session(spark):
    from tidegate.session import work_folder

    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert first.startswith(configured)


def test_durations_survive_daylight_saving(spark):
    """Slices are cut by the time itself, not by its reading in the session zone."""
    rows = [("f", "j", str(i), dt.datetime(2024, 3, 31, 0, 0) + dt.timedelta(minutes=10 * i), "transition", f"S{i}") for i in range(30)]
    log = spark.createDataFrame(rows, "file_path STRING, job_id STRING, event_id STRING, occurred_at TIMESTAMP_NTZ, kind STRING, to_state STRING")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    try:
        got = tracking.history(log, slices=7).orderBy(F.col("event_id").cast("int")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.from_state for r in got] == ["", *(f"S{i}" for i in range(29))]
    assert [r.duration_ms for r in got] == [0, *[600_000] * 29]
