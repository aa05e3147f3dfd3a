"""Files announced by control records: decided, and if wanted processed, as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate import schemas
from tidegate.functions.paths import location
from tidegate.options import Config
from tidegate.plans.batch import BatchOptions, decide, run_batch
from tidegate.sources import hadoop, listing


def stream_control(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Control records as files of them arrive below ``path``."""
    return (
        spark.readStream.schema(schemas.struct(f"file_path STRING, {schemas.CONTROL}"))
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def stream_announcements(
    spark: SparkSession, path: str, within: str, files_per_batch: int = 1000
) -> DataFrame:
    """Control records of files that were not announced before, as far back as ``within``.

    Senders deliver at least once. The state store remembers a place for that long after it was
    announced first, by the times at which control files were stored. Files are taken in that order,
    so no announcement is late. The first announcement counts, also if a later one differs; pass
    ``seen_path`` to :func:`on_arrival` for repeats that come later than that.
    """
    stored = F.col("_metadata.file_modification_time")
    rows = stream_control(spark, path, files_per_batch).select(
        "*", stored.alias("announced_at"), location(F.col("file_path")).alias("_place")
    )
    once = rows.withWatermark("announced_at", within).dropDuplicatesWithinWatermark(["_place"])
    return once.drop("announced_at", "_place")


def first_seen(batch: DataFrame, number: int, seen_path: str) -> DataFrame:
    """Rows of a batch for files that no earlier batch handled; repeats go to ``<seen_path>/repeats``.

    Only the places of earlier batches are read, never a listing. A batch that runs again looks at
    the same earlier ones and replaces what it wrote.
    """
    spark = batch.sparkSession
    places = f"{seen_path}/places"
    place = location(F.col("file_path"))
    if number and hadoop.matches(spark, f"{places}/batch_id=*"):
        earlier = spark.read.schema("_place STRING, batch_id BIGINT").parquet(places)
        earlier = earlier.where(F.col("batch_id") < number).select("_place")
        rows = batch.withColumn("_place", place)
        repeats = rows.join(earlier, "_place", "left_semi").drop("_place")
        repeats.write.mode("overwrite").parquet(f"{seen_path}/repeats/batch_id={number}")
        batch = rows.join(earlier, "_place", "left_anti").drop("_place")
    new = batch.select(place.alias("_place")).where("_place IS NOT NULL").distinct()
    new.write.mode("overwrite").parquet(f"{places}/batch_id={number}")
    return batch


def on_arrival(
    control: DataFrame,
    files: Callable[[], DataFrame] | None,
    config: Config,
    output_root: str,
    log_path: str,
    checkpoint: str,
    options: BatchOptions = BatchOptions(),
    every: str | None = None,
    seen_path: str | None = None,
) -> StreamingQuery:
    """Handle each batch of control records.

    ``files`` gives the inventory at that time, of which only announced files are looked at; without
    it each announced file is looked up by its path, and nothing is listed. With ``seen_path`` a file
    that an earlier batch handled is set aside there (:func:`first_seen`). With ``validate_only`` the decisions are all there is, else accepted files are processed. Both
    the decisions and the job id of a batch come from its number, so a batch that runs again
    writes the same again.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read several times; a stateful stream should not be
        try:
            new = first_seen(batch, number, seen_path) if seen_path else batch
            if files is None:
                announced = listing.lookup(new.select("file_path").distinct())
            else:
                places = new.select(location(F.col("file_path")).alias("_place"))
                listed = files()
                announced = listed.join(places, location(listed["file_path"]) == places["_place"], "left_semi")
            if options.validate_only:
                decisions = decide(announced, new, config, options)
                decisions.write.mode("overwrite").parquet(f"{log_path}/batch_id={number}")
            else:
                run_batch(
                    batch.sparkSession, announced, new, config, f"{output_root}/batch={number}", log_path,
                    f"arrival-{number}", options,
                )
        finally:
            batch.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        control.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(handle)
        .start()
    )
