"""Loads that readers see as a whole or not at all.

A try to load writes below a folder of its own. When all is written and counted, one small file
names that try as the load's; putting that file in place is the only step that readers can see.
Readers take the tries that are named so, and no others. A load that is published stays as it is:
the same load id again gives its results without writing anything. The states that the files of a
load pass, LOADING, LOADED and COMPLETED, are rows of the log, with ids made from the load.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import tracking
from tidegate.operators.tables import LoadResult
from tidegate.sources import hadoop

_MARKER = "load_id string, attempt string, loaded bigint, rejected bigint, load_duration_ms bigint"


def _tries(path: str) -> str:
    return f"{path.rstrip('/')}/tries"


def _markers(path: str) -> str:
    return f"{path.rstrip('/')}/published"


def published(spark: SparkSession, path: str) -> DataFrame:
    """``load_id, attempt, loaded, rejected, load_duration_ms`` of the loads that readers see."""
    if not hadoop.matches(spark, _markers(path)):
        return spark.createDataFrame([], _MARKER)
    return spark.read.schema(_MARKER).json(_markers(path))


def read_loaded(spark: SparkSession, path: str, status: str = "loaded") -> DataFrame | None:
    """Rows of published loads with that ``load_status``, and their ``load_id``; none before any.

    Folders of other tries are pruned by a join with the published ones, a row a load.
    """
    seen = published(spark, path)
    if seen.isEmpty():
        return None
    kinds = "load_id STRING, attempt STRING, load_status STRING"
    rows = spark.read.option("mergeSchema", "true").parquet(_tries(path))
    rows = rows.withColumns({c.split()[0]: F.col(c.split()[0]).cast("string") for c in kinds.split(", ")})
    named = F.broadcast(seen.select("load_id", "attempt"))
    mine = rows.where(F.col("load_status") == status).join(named, ["load_id", "attempt"], "left_semi")
    return mine.drop("attempt", "load_status")


def load(
    df: DataFrame,
    target_name: str,
    path: str,
    load_id: str,
    files: DataFrame | None = None,
    log_path: str | None = None,
) -> LoadResult:
    """Load rows with a null ``reject_reason``, keep the others as rejected, and publish both.

    ``files`` (``file_path, job_id``) are those the rows come from; their states go to the log
    below ``log_path``. Whatever a try that broke off has left is removed by the next that is
    published. Counts come from the written files.
    """
    spark = df.sparkSession
    known = published(spark, path).where(F.col("load_id") == load_id).first()
    if known is None:
        started = time.monotonic()
        _log(files, log_path, load_id, "LOADING", 0)
        attempt = uuid.uuid4().hex
        own = f"{_tries(path)}/load_id={quote(load_id, safe='')}"
        status = F.when(F.col("reject_reason").isNull(), F.lit("loaded")).otherwise(F.lit("rejected"))
        place = f"{own}/attempt={attempt}"
        df.withColumn("load_status", status).write.partitionBy("load_status").parquet(place)
        counted = spark.read.schema(f"{_any_column(df)}, load_status STRING").parquet(place)
        counts = {r.load_status: r["count"] for r in counted.groupBy("load_status").count().collect()}
        milliseconds = round(1000 * (time.monotonic() - started))
        marker = {
            "load_id": load_id, "attempt": attempt, "loaded": counts.get("loaded", 0),
            "rejected": counts.get("rejected", 0), "load_duration_ms": milliseconds,
        }
        hadoop.put_marker(spark, f"{_markers(path)}/{quote(load_id, safe='')}.json", json.dumps(marker))
        known = published(spark, path).where(F.col("load_id") == load_id).first()
        for other in hadoop.children(spark, own):
            if not other.endswith(f"attempt={known.attempt}"):
                hadoop.remove(spark, other)
    _log(files, log_path, load_id, "LOADED", 1)
    _log(files, log_path, load_id, "COMPLETED", 2)
    place = f"{_tries(path)}/load_id={quote(load_id, safe='')}/attempt={known.attempt}"
    return LoadResult(
        target_name,
        f"{place}/load_status=loaded",
        f"{place}/load_status=rejected",
        known.loaded,
        known.rejected,
        known.load_duration_ms,
        load_id,
    )


def _any_column(df: DataFrame) -> str:
    first = df.schema.fields[0]
    return f"`{first.name}` {first.dataType.simpleString()}"


def _log(files: DataFrame | None, log_path: str | None, load_id: str, state: str, step: int) -> None:
    """A load that runs again writes rows with the same ids, which count once."""
    if files is None or log_path is None:
        return
    name = F.concat_ws("|", F.lit(load_id), "file_path", F.lit(f"{7 + step}-{state.lower()}"))
    at = F.timestamp_add("MILLISECOND", F.lit(step), F.current_timestamp())
    rows = files.select("file_path", "job_id").distinct()
    tracking.log_entries(rows, tracking.transition(state, name, at)).write.mode("append").parquet(log_path)
