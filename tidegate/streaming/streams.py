"""Streams of files, events and changes into append-only folders.

Batches are written by number, each replacing its own folder, so a batch that runs again after
a failure leaves the same rows once. Triggers default to "all that is there, then stop", which
turns a stream into an incremental batch job; pass ``every`` for a continuous one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators import statistics, tracking
from tidegate.operators.latest import latest_per_key

Change = Callable[[DataFrame], DataFrame]


def _trigger(every: str | None) -> dict[str, str | bool]:
    return {"processingTime": every} if every else {"availableNow": True}


def stream_registered(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Stream from any source the session knows by name, such as a message broker."""
    return spark.readStream.format(source).options(**options).load()


def decoded(stream: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Columns of a stream whose ``value`` is JSON text or its bytes; broken values give nulls."""
    return stream.select(F.from_json(F.col(value).cast("string"), schema).alias("_row")).select("_row.*")


def append_to_path(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a folder of Parquet files."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start(path)
    )


def append_to_table(
    stream: DataFrame, table: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a catalog table kept at ``path``."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**_trigger(every))
        .toTable(table)
    )


def put_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    change: Change | None = None,
    output_mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Write each batch, changed by a batch function, to ``<path>/batch_id=<n>``."""

    def put(batch: DataFrame, number: int) -> None:
        rows = change(batch) if change else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .foreachBatch(put)
        .start()
    )


def hourly_counts(events: DataFrame, late: str | None = None, hours: int = 1) -> DataFrame:
    """Events per window of whole hours and type.

    Nothing is dropped unless ``late`` is given: then Spark forgets windows that are older than
    the newest event by that much, and leaves out events that come later still (their number is
    ``numRowsDroppedByWatermark`` in the progress of the query). Without it every window stays in
    the state. The time is one with zone.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return statistics.hourly(timed.withWatermark("ts", late) if late else timed, hours=hours)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query has left out because they came too late."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def put_hourly_counts(
    events: DataFrame, path: str, checkpoint: str, late: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Write updated windows of each batch; :func:`newest_windows` reads the final counts.

    Appending instead would keep back the last windows until later events come.
    """
    return put_batches(hourly_counts(events, late), path, checkpoint, output_mode="update", every=every)


def newest_windows(spark: SparkSession, path: str) -> DataFrame:
    updates = spark.read.parquet(path)
    return latest_per_key(updates, ["window_start", "event_type"], "batch_id").drop("batch_id")


def apply_job_events(
    events: DataFrame,
    records: DataFrame,
    log_path: str,
    unknown_path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Log the outcome of finished runs, and set events of unknown runs aside.

    An event may be delivered again, in any batch; readers of the log drop repeats with
    ``tracking.once``, so that no batch has to shuffle for it. Events are matched with the
    records as they are when a batch runs. Both writes of a batch replace what an earlier try
    of it wrote. The matched batch is kept for its two writes, so it is read and joined once;
    a lost piece of it is computed again.
    """

    def put(batch: DataFrame, number: int) -> None:
        outcomes = tracking.job_outcomes(batch, records).persist()
        try:
            log = tracking.outcome_log(outcomes)
            log.write.mode("overwrite").parquet(f"{log_path}/batch_id={number}")
            unknown = tracking.unknown_runs(outcomes)
            unknown.write.mode("overwrite").parquet(f"{unknown_path}/batch_id={number}")
        finally:
            outcomes.unpersist()

    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .foreachBatch(put)
        .start()
    )


def collect_changes(
    changes: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append keyed changes to a change table; ``tables.current_rows`` lays them over a base."""
    return put_batches(changes, path, checkpoint, every=every)
